"""Removal of repeated byte strings by suffix arrays built with induced sorting.

A byte is removed if a string of ``match`` bytes that covers it also starts in a document with a
smaller id. Such strings (windows) are found shard by shard. A window's shard is that of its
anchor, the string of ``match`` * 2 / 5 bytes in it whose hash is the smallest (the leftmost of
equals), so equal windows always meet; neighbouring windows with one anchor travel together
as a segment. In a shard the suffix array of all its segments is built by induced sorting
(``induced_sort``), common prefixes of neighbours in the array are computed in text order
through the permutation, and windows that have ``match`` bytes in common form a run, whose smallest id
decides.

Only what can repeat travels. Anchors of all texts are sorted by hash, and those of a single text
go no further; texts are joined with the anchors that are left, and segments of these are folded
in the map tasks (a copy is a row of its segment's count) before they go to a shard. What
the shard finds for a segment is joined back to its occurrences, and their spans to the texts,
which lie in buckets for it. Identical texts are one text.

An anchor of very many texts (found on a sample, for the routing alone) would bring all of them
into one shard: it is not sorted with the others, and its segments are cut further by the distance
of the window from the anchor, EDGE distances in a piece, so that all windows of a piece share
``match`` - EDGE + 1 bytes, by which it is dealt.

Defined cases: null text counts as empty; matches never cross documents; texts shorter than
``match`` lose nothing; a null id comes after all others, and null ids are no smaller than each
other; of rows with equal text those without the smallest id lose all their bytes, and rows that
repeat an id and a text are treated alike; rows that repeat an id with other texts are documents of
their own, neither before the other; texts of any length are taken whole, in overlapping blocks;
columns other than the id and the text are not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from firmdyn.llm.common import free_shuffles, join_groups, written
from firmdyn.llm.induced_sort import permuted_prefixes, suffix_array
from firmdyn.session import run_folder, stash, stash_observed

#: Bytes of text that are hashed at once (positions must fit PLACE_BITS) and of a suffix array, about,
#: so small that they stay in the processor's caches.
BLOCK_BYTES, PLACE_BITS, SHARD_BYTES = 1 << 17, 21, 1 << 19
#: An anchor is hot in one of so many of the sampled texts, and in so many at least; texts of the
#: sample; distances in a piece.
HOT_TEXTS, HOT_LEAST, SAMPLE_TEXTS, EDGE = 200, 20, 20_000, 8
#: Label of null ids.
LAST = 1 << 62

#: Odd factors of the digests.
_FACTORS = (0x9FB21C651E98DF25, 0x2127599BF4325C37)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


# anchors

def _gram_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each position on."""
    factor = int(_MIX[0])
    out, done, power, size = None, 0, raw.astype(np.uint64), 1
    while True:  # widths of powers of two, joined by the binary digits of the width
        if width & size:
            if out is None:
                out = power
            else:
                n = len(raw) - done - size + 1
                out = out[:n] * np.uint64(pow(factor, size, 1 << 64)) + power[done:done + n]
            done += size
        if 2 * size > width:
            break
        n = len(raw) - 2 * size + 1
        power = power[:n] * np.uint64(pow(factor, size, 1 << 64)) + power[size:size + n]
        size *= 2
    out = (out ^ (out >> np.uint64(30))) * _MIX[1]
    out = (out ^ (out >> np.uint64(27))) * _MIX[2]
    return out ^ (out >> np.uint64(31))


def segments(raw: np.ndarray, at: np.ndarray, match: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in a block of texts that begin at ``at`` (and end at its
    last entry): text, first window, number of windows, place and hash of the anchor."""
    if len(raw) < match:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return _segments(_gram_hashes(raw, anchor_bytes(match)), at, match)


def _segments(hashes: np.ndarray, at: np.ndarray, match: int) -> tuple[np.ndarray, ...]:
    """``segments`` from the hashes of anchors at all places."""
    width = anchor_bytes(match)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    size, windows = 1, match - width + 1
    while size < windows:
        step = min(size, windows - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    n = int(at[-1]) - match + 1
    place = (least[:n] & low).astype(np.int64)
    crossing = np.zeros(int(at[-1]) + 2, np.int32)
    np.add.at(crossing, np.maximum(at[1:] - match + 1, at[:-1]), 1)
    np.add.at(crossing, at[1:], -1)
    whole = np.cumsum(crossing)[:n] == 0
    begins = whole.copy()
    begins[1:] &= ~whole[:-1] | (place[1:] != place[:-1])
    ends = np.append(np.flatnonzero(begins | ~whole), n)
    first = np.flatnonzero(begins)
    count = ends[np.searchsorted(ends, first, "right")] - first
    text = np.searchsorted(at, first, "right") - 1
    return text, first, count, place[first], (hashes[place[first]] >> np.uint64(2)).astype(np.int64)


def anchor_bytes(match: int) -> int:
    return max(1, 2 * match // 5)


def _blocks(texts: pa.Array, match: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in blocks: the bytes, where each part begins (and the last ends), the row of each part
    and its place in the text. A long text comes in parts that overlap by ``match`` - 1 bytes."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + BLOCK_BYTES, "right")) - 1)
        if ends[b] - ends[a] <= BLOCK_BYTES:
            yield raw[ends[a]:ends[b]], ends[a:b + 1] - ends[a], np.arange(a, b), np.zeros(b - a, np.int64)
        else:
            for start in range(int(ends[a]), int(ends[b]) - match + 1, BLOCK_BYTES - match + 1):
                part = raw[start:min(start + BLOCK_BYTES, ends[b])]
                yield part, np.array([0, len(part)]), np.array([a]), np.array([start - ends[a]])
        a = b


def _is_hot(hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(hot, hashes), max(len(hot) - 1, 0))
    return hot[at] == hashes if len(hot) else np.zeros(len(hashes), bool)


def _anchors(match: int, hot: np.ndarray):
    """(h, k): the distinct anchors of each text; a text with hot ones has a negative h instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("k").to_numpy()
            for raw, at, rows, _ in _blocks(batch.column("text"), match):
                text, _, _, _, h = segments(raw, at, match)
                by = np.lexsort((h, text))
                text, h = text[by], h[by]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                text, h = text[new], h[new]
                skip = _is_hot(h, hot)
                some = np.unique(text[skip])
                k = key[rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([h[~skip], ~(k[some] & (LAST - 1))])),
                     pa.array(np.concatenate([k[text[~skip]], k[some]]))], ["h", "k"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by h, without those whose h is of a single text; negative ones pass. Of the last
    run of a batch it is enough to remember one row, until another text joins it."""
    open_h, open_k, known = None, None, False
    for batch in batches:
        h, k = batch.column("h").to_numpy(), batch.column("k").to_numpy()
        if not len(h):
            continue
        if open_h is not None and not known:
            h, k = np.append(open_h, h), np.append(open_k, k)
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        again = (np.minimum.reduceat(k, first) != np.maximum.reduceat(k, first)) | (h[first] < 0)
        again[0] |= known and h[0] == open_h
        open_h, open_k, known = h[-1], k[-1], bool(again[-1])
        keep = np.repeat(again, np.diff(first, append=len(h)))
        yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(k[keep])], ["h", "k"])


# segments and shards

def _powers(factor: int, n: int) -> np.ndarray:
    """factor^0 to factor^(n - 1), modulo 2^64."""
    out = np.ones(n, np.uint64)
    size = 1
    while size < n:
        step = min(size, n - size)
        out[size:size + step] = out[:step] * np.uint64(pow(factor, size, 1 << 64))
        size += step
    return out


@lru_cache(maxsize=4)
def _block_powers(factor: int) -> np.ndarray:
    return _powers(factor, BLOCK_BYTES)


def _digests(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of the hashes from ``first`` up to ``last`` (not included), wherever they
    lie: sums of hashes times powers of two factors."""
    out = []
    for factor in _FACTORS:
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _block_powers(factor)[:len(hashes)])))
        back = _block_powers(pow(factor, -1, 1 << 64))
        out.append(((sums[last] - sums[first]) * back[first]).view(np.int64))
    return out


def _own_segments(batch: pa.RecordBatch, match: int, hot: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Per block: bytes, row, first byte in the block and in the text, windows, shard key and two
    digests of the segments whose anchor is one of their row's or hot; hot ones in pieces."""
    flags, width = batch.column("anchors"), anchor_bytes(match)
    salt = _powers(_FACTORS[0], batch.num_rows).view(np.int64)  # tells rows apart
    own = flags.flatten().to_numpy() ^ salt[pc.list_parent_indices(flags).to_numpy()]
    own.sort()
    for raw, at, rows, base in _blocks(batch.column("text"), match):
        if len(raw) < match:
            continue
        hashes = _gram_hashes(raw, width)
        text, first, count, place, h = _segments(hashes, at, match)
        is_hot = _is_hot(h, hot)
        keep = _is_hot(h ^ salt[rows[text]], own) & ~is_hot
        parts = [(text[keep], first[keep], count[keep], h[keep])]
        if is_hot.any():
            parts.append(_pieces(raw, text[is_hot], first[is_hot], count[is_hot], place[is_hot], match))
        text, first, count, key = (np.concatenate(x) for x in zip(*parts))
        digests = _digests(hashes, first, first + count + match - width)
        yield raw, rows[text], first, first - at[text] + base[text], count, key, *digests


def _pieces(raw: np.ndarray, text: np.ndarray, first: np.ndarray, count: np.ndarray, place: np.ndarray,
            match: int) -> tuple[np.ndarray, ...]:
    """Segments cut by the distance from a window to its anchor; a piece's key is a hash of the bytes
    that all windows of these distances share."""
    out, data = [], raw.tobytes()
    for t, a, n, p in zip(text.tolist(), first.tolist(), count.tolist(), place.tolist()):
        while n:
            step = (p - a) // EDGE
            size = min(n, p - a - step * EDGE + 1)
            shared = data[p - step * EDGE:p - step * EDGE - EDGE + 1 + match]
            out.append((t, a, size, xxhash.xxh3_64_intdigest(shared, seed=step + 1) >> 2))
            a, n = a + size, n - size
    return tuple(np.array(x, np.int64) for x in zip(*out)) if out else tuple(np.empty(0, np.int64) for _ in range(4))


def _folded(parts: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Of rows with key, s1, s2, label and n: one row of each (key, s1, s2), by key, with the
    smallest label and the sum of n; and their columns."""
    by = np.lexsort((parts["s2"], parts["s1"], parts["key"]))
    new = np.zeros(len(by), bool)
    new[:1] = True
    for c in ("key", "s1", "s2"):
        new[1:] |= parts[c][by][1:] != parts[c][by][:-1]
    starts = np.flatnonzero(new)
    rows = by[starts]
    out = {c: parts[c][rows] for c in ("key", "s1", "s2")}
    out["label"] = np.minimum.reduceat(parts["label"][by], starts) if len(by) else parts["label"]
    out["n"] = np.add.reduceat(parts["n"][by], starts) if len(by) else parts["n"]
    return rows, out


def _to_shards(match: int, hot: np.ndarray):
    """(key, s1, s2, label, n, segment): distinct segments of a batch, with their smallest label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, parts, where = batch.column("label").to_numpy(), [], []
            for raw, row, first, _, count, key, s1, s2 in _own_segments(batch, match, hot):
                parts.append((key, s1, s2, label[row], np.ones(len(row), np.int64)))
                where.append((raw, first, first + count + match - 1))
            if not parts:
                continue
            rows, out = _folded(dict(zip(("key", "s1", "s2", "label", "n"), map(np.concatenate, zip(*parts)))))
            block = np.repeat(np.arange(len(where)), [len(x[1]) for x in where])[rows]
            begin, end = (np.concatenate([x[i] for x in where])[rows] for i in (1, 2))
            data = [x[0].tobytes() for x in where]
            out["segment"] = pa.array([data[i][a:b] for i, a, b in zip(block.tolist(), begin.tolist(), end.tolist())],
                                      pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    return run


def _occurrences(match: int, hot: np.ndarray):
    """(s1, s2, key, k, label, at, n_windows) of every segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, label = batch.column("k").to_numpy(), batch.column("label").to_numpy()
            for _, row, _, at, count, key, s1, s2 in _own_segments(batch, match, hot):
                yield pa.RecordBatch.from_pydict({
                    "skey": _joined_key(key, s1), "s2": s2, "k": k[row], "label": label[row], "at": at.astype(np.int64),
                    "n_windows": count.astype(np.int32)})

    return run


def _joined_key(key: np.ndarray, s1: np.ndarray) -> np.ndarray:
    return key * np.uint64(_FACTORS[1]).view(np.int64) ^ s1


def smaller_elsewhere(strings: pa.Array, labels: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of the strings that also start in a string with a smaller label: string,
    first window, number of windows."""
    sizes = pc.binary_length(strings).to_numpy().astype(np.int64)
    ended = pc.binary_join_element_wise(strings, b"\0", b"")
    raw = np.frombuffer(ended.buffers()[2], np.uint8, int(sizes.sum()) + len(sizes))[:-1]
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    symbols = raw.astype(np.uint16) + 2  # 0 ends the array's text, 1 a string
    symbols[begin[1:] - 1] = 1
    sa = suffix_array(np.append(symbols, np.uint16(0)), 258)
    windows = np.maximum(sizes - match + 1, 0)
    owner = np.repeat(np.arange(len(strings)), windows)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = begin[owner] + nth
    common = np.full(len(symbols) + 1, -1, np.int32)  # by position; -1: no window starts there
    common[at] = permuted_prefixes(raw, sa, at, match)
    index = np.empty(len(symbols) + 1, np.int64)
    index[at] = np.arange(len(at))
    rank = np.flatnonzero(common[sa] >= 0)
    if not len(rank):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    # a suffix between two that share a window has that window too
    ordered = sa[rank]
    starts = np.flatnonzero((common[ordered] < match) | (np.diff(rank, prepend=-1) > 1))
    if not len(starts) or starts[0]:
        starts = np.append(0, starts)
    own = labels[owner[index[ordered]]]
    least = np.repeat(np.minimum.reduceat(own, starts), np.diff(starts, append=len(ordered)))
    lower = np.zeros(len(owner) + 1, bool)
    lower[index[ordered]] = least < own
    lower = lower[:-1]
    begins = lower.copy()
    begins[1:] &= ~lower[:-1] | (owner[1:] != owner[:-1])
    first = np.flatnonzero(begins)
    breaks = np.append(np.flatnonzero(begins | ~lower), len(lower))
    return owner[first], nth[first], breaks[np.searchsorted(breaks, first, "right")] - first


def _shards(match: int):
    """Of rows that come by key: (skey, s2, least, n, lower), the smallest label of every segment that
    occurs again or has lower windows, its number of rows, and those windows (first, number)."""
    def judged(table: pa.Table) -> pa.RecordBatch:
        rows, found = _folded({c: table[c].to_numpy() for c in ("key", "s1", "s2", "label", "n")})
        strings = table["segment"].combine_chunks().take(pa.array(rows))
        labels, n = found["label"], found["n"]
        string, first, count = smaller_elsewhere(strings, labels, match)
        bounds = np.searchsorted(string, np.arange(len(strings) + 1))
        keep = np.flatnonzero((n > 1) | (np.diff(bounds) > 0))
        runs = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(count, pa.int32())], ["first", "n"])
        lower = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs)
        return pa.RecordBatch.from_pydict({
            "skey": _joined_key(found["key"], found["s1"])[keep], "s2": found["s2"][keep], "least": labels[keep],
            "n": n[keep], "lower": lower.take(pa.array(keep))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            keys = batch.column("key").to_numpy()
            sizes = np.append(0, np.cumsum(pc.binary_length(batch.column("segment")).to_numpy()))
            at = 0
            while at < len(keys):
                end = int(np.searchsorted(sizes, sizes[at] + SHARD_BYTES - size, "right")) - 1
                if end >= len(keys):
                    break
                # up to a change of the key
                end = max(end, at)
                last = keys[end - 1] if end else (held[-1].column("key")[-1].as_py() if held else keys[0])
                end += int(np.argmax(np.append(keys[end:] != last, True)))
                if end >= len(keys):
                    break
                held.append(batch.slice(at, end - at))
                yield judged(pa.Table.from_batches(held))
                held, size, at = [], 0, end
            if at < len(keys):
                held.append(batch.slice(at))
                size += int(sizes[-1] - sizes[at])
        if held:
            yield judged(pa.Table.from_batches(held))

    return run


# what is left of a text

def without(raw: bytes, spans: np.ndarray) -> tuple[int, int, str]:
    """Bytes removed, maximal runs of them, and the SHA-256 of the others."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    first = np.flatnonzero(new)
    begin, end = spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]
    digest, at = hashlib.sha256(), 0
    for a, b in zip(begin.tolist(), end.tolist()):
        digest.update(raw[at:a])
        at = b
    digest.update(raw[at:])
    return int((end - begin).sum()), len(first), digest.hexdigest()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, flat, sha in zip(batch.column("text"), batch.column("spans"), batch.column("sha")):
            if text.is_valid and flat.is_valid and len(flat):
                out.append(without(text.as_buffer().to_pybytes(), flat.values.to_numpy().reshape(-1, 2)))
            else:
                out.append((0, 0, sha.as_py()))
        removed, n, sha = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(n, pa.int64()),
             pa.array(sha, pa.string())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _numbered(firsts: DataFrame, kind) -> DataFrame | None:
    """(id, sha, k, label) of every text's smallest id, or None if the ids can serve as keys: whole
    numbers, none null, each with one text. Numbers and labels follow the ids' order."""
    again = firsts.groupBy("id").count().where("count > 1 OR id IS NULL OR id >= " + str(LAST)) if isinstance(
        kind, (ByteType, ShortType, IntegerType, LongType)) else None
    if again is not None and not again.limit(1).count():
        return None
    # partition numbers are the high bits, so the numbers rise with the range-partitioned ids
    rows = stash(firsts.select("id", "sha").repartitionByRange("id", "sha").sortWithinPartitions("id", "sha")
                 .withColumn("k", F.monotonically_increasing_id()))
    labels = rows.groupBy("id").agg(F.min("k").alias("label")).where(F.col("id").isNotNull())
    return written(rows.join(labels, "id", "left").select(
        F.col("id").alias("_id"), F.col("sha").alias("_sha"), "k", F.coalesce("label", F.lit(LAST)).alias("label")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, match: int = 50) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans and kept_sha256."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    id_type, text = kind.simpleString(), F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("sha", F.sha2("text", 256))
    prints, seen = stash_observed(rows.select("id", "sha", F.octet_length("text").cast("long").alias("n_bytes")))

    # identical texts are one text, of the smallest id
    firsts = stash(prints.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    copies = stash(join_groups(prints, firsts, "sha", "n", seen["rows"]).where(~F.col("id").eqNullSafe(F.col("first"))))
    long = F.col("n_bytes") >= match
    copied = copies.select(
        "id", "n_bytes", F.when(long, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"),
        F.when(long, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(long, F.sha2(F.lit(b""), 256)).otherwise(F.col("sha")).alias("kept_sha256"))
    gone = written(copies.select(F.col("id").alias("_id"), F.col("sha").alias("_sha")).distinct())
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha"))
    texts = rows.join(gone, same, "left_anti")
    numbers = _numbered(firsts.select(F.col("first").alias("id"), "sha"), kind)
    if numbers is None:
        texts = texts.select(F.col("id").cast("long").alias("k"), F.col("id").cast("long").alias("label"), "id", "sha", "text")
    else:
        texts = texts.join(numbers, same).select("k", "label", "id", "sha", "text")

    # anchors of several texts
    keyed = texts.select("k", "text")
    one_in = max(1, seen["rows"] // SAMPLE_TEXTS)
    sample = keyed.where(F.pmod(F.xxhash64(F.lit("sample"), "k"), F.lit(one_in)) == 0)
    often = max(HOT_LEAST, seen["rows"] // one_in // HOT_TEXTS)
    hot = np.array(sorted(r.h for r in sample.mapInArrow(_anchors(match, np.empty(0, np.int64)), "h long, k long")
                          .groupBy("h").count().where(F.col("count") >= often).collect()), np.int64)
    repeated = (keyed.mapInArrow(_anchors(match, hot), "h long, k long").repartition("h")
                .sortWithinPartitions("h").mapInArrow(_repeated, "h long, k long"))
    flags = repeated.groupBy("k").agg(F.collect_set(F.when(F.col("h") >= 0, F.col("h"))).alias("anchors"))

    # the texts by key, in buckets, so that their spans can come to them
    flagged = texts.join(flags.hint("merge"), "k", "left").select(
        "k", "label", "id", "sha", F.octet_length("text").cast("long").alias("n_bytes"),
        F.when(F.col("anchors").isNotNull(), F.col("text")).alias("text"), "anchors")
    name = f"firmdyn_{uuid.uuid4().hex}"
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    flagged.write.bucketBy(n_buckets, "k").option("path", f"{run_folder(spark)}/{name}").option(
        "compression", "zstd").saveAsTable(name)
    free_shuffles(spark)
    flagged = spark.table(name)
    marked = flagged.where("text IS NOT NULL")

    shards = marked.select("label", "anchors", "text").mapInArrow(
        _to_shards(match, hot), "key long, s1 long, s2 long, label long, n long, segment binary")
    found, seen = stash_observed(shards.repartition("key").sortWithinPartitions("key").mapInArrow(
        _shards(match), "skey long, s2 long, least long, n long, lower array<struct<first:int,n:int>>"), total=F.sum("n"))
    free_shuffles(spark)
    places = marked.select("k", "label", "anchors", "text").mapInArrow(
        _occurrences(match, hot), "skey long, s2 long, k long, label long, at long, n_windows int")
    hits = join_groups(places, found, ["skey", "s2"], "n", seen["total"] or 0)
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_windows").alias("n")))
    runs = F.explode(F.when(F.col("label") > F.col("least"), whole).otherwise(F.col("lower")))
    begin, windows = F.col("at") + F.col("run.first"), F.col("run.n")
    spans = hits.select("k", "at", runs.alias("run")).select("k", F.array(begin, begin + windows + (match - 1)).alias("span"))
    spans = spans.groupBy("k").agg(F.flatten(F.collect_list("span")).alias("spans"))
    kept = flagged.join(spans.hint("merge"), "k", "left").select("id", "n_bytes", "text", "sha", "spans").mapInArrow(
        _cut, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return kept.unionByName(copied).withColumnRenamed("id", id_col)
