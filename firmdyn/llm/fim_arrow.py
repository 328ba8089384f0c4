"""Fill-in-middle transformation as a pipeline of pyarrow.compute steps.

Each batch of texts is split into a list array of its units (code points), the lists are flattened
with their parent indices, a unit's ordinal in its text is its index less the start of its list,
units are filtered by role (prefix, middle or suffix, by the text's two cuts), the lists of every
role are rebuilt, and ``binary_join`` makes them pieces again; markers and pieces are joined
element by element.

Two cuts, the form and the order of the pieces follow from a hash of the seed and the id alone, so a
retried task repeats them. A unit takes some fifty bytes while it is cut, so units are made for at
most SLICE_BYTES of text at a time; a longer text goes through in parts whose ordinals run on.

Forms: ``psm`` is the prefix, suffix and middle behind their markers, ``spm`` the suffix, prefix and
middle behind theirs, ``plain`` the text as it is (a share of the documents, empty texts, and texts
that hold a marker, which could not be told apart again).

Defined cases: null text counts as empty; a null id hashes like an empty one; rows that repeat an
id are cut alike if their texts are as long; equal cuts leave an empty middle; texts of any length
are cut whole; bytes that are no UTF-8 belong to the unit before them; columns other than the id
and the text are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Markers of the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Bytes of text whose units are in memory at once.
SLICE_BYTES = 1 << 19

_DRAWS = ("h1", "h2", "h3", "h4")


def _raw(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins in them (and the last ends)."""
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def split_units(texts: pa.LargeStringArray) -> pa.ListArray:
    """The code points of every text, as lists."""
    raw, at = _raw(texts)
    first = pc.not_equal(pc.bit_wise_and(pa.array(raw), pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8()))
    begins = np.append(np.union1d(pc.indices_nonzero(first).to_numpy(), at[:-1][at[:-1] < at[1:]]), len(raw))
    begins = begins.astype(np.int32)
    units = pa.StringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(raw))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(begins, at).astype(np.int32)), units)


def _cut_units(units: pa.ListArray, first: pa.Array, low: pa.Array, high: pa.Array) -> list[pa.StringArray]:
    """Prefixes, middles and suffixes of lists whose first unit has the ordinal ``first``: units
    before ``low``, from there to ``high``, and from there on."""
    flat, parent = units.flatten(), pc.list_parent_indices(units)
    shift = pc.subtract(first, units.offsets.slice(0, len(units)).cast(pa.int64()))
    ordinal = pc.add(pa.array(np.arange(len(flat))), shift.take(parent))
    before, after = pc.less(ordinal, low.take(parent)), pc.greater_equal(ordinal, high.take(parent))
    pieces = []
    for role in (before, pc.invert(pc.or_(before, after)), after):
        ends = pc.cumulative_sum(role.cast(pa.int32()))
        starts = pa.concat_arrays([pa.array([0], pa.int32()), ends]).take(units.offsets)
        pieces.append(pc.binary_join(pa.ListArray.from_arrays(starts, flat.filter(role)), ""))
    return pieces


def _parts(texts: pa.LargeStringArray, most: int) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The texts in parts of at most ``most`` bytes (four at least), cut between code points, and
    where the parts of each text begin."""
    raw, at = _raw(texts)
    cuts, starts = [0], []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        starts.append(len(cuts) - 1)
        while b - a > most:
            end = a + most
            while end > a + most - 3 and raw[end] & 0xC0 == 0x80:
                end -= 1
            cuts.append(end)
            a = end
        cuts.append(b)
    offsets = pa.py_buffer(np.array(cuts, np.int64))
    return (pa.LargeStringArray.from_buffers(len(cuts) - 1, offsets, pa.py_buffer(raw)),
            np.array([*starts, len(cuts) - 1], np.int32))


def _slices(parts: pa.LargeStringArray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of parts of at most ``most`` bytes together."""
    _, at = _raw(parts)
    a = 0
    while a < len(parts):
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
        yield a, b
        a = b


def cut_texts(texts: pa.LargeStringArray, h1: pa.Array, h2: pa.Array,
              most: int = SLICE_BYTES) -> tuple[pa.Array, pa.Array, pa.Array, list[pa.Array]]:
    """Units of each text, units before its lower and its upper cut, and prefixes, middles and
    suffixes. The cuts are ``h1`` and ``h2`` modulo the number of places for them."""
    parts, starts = _parts(texts, max(4, most))
    owner = pa.array(np.repeat(np.arange(len(texts)), np.diff(starts)))
    runs = list(_slices(parts, most))
    sizes = pa.concat_arrays([pc.list_value_length(split_units(parts.slice(a, b - a))) for a, b in runs] or
                             [pa.array([], pa.int32())]).to_numpy().astype(np.int64)
    ends = np.append(0, np.cumsum(sizes))
    n = pa.array(ends[starts[1:]] - ends[starts[:-1]])
    first = pa.array(ends[:-1] - ends[starts[:-1]][owner.to_numpy()])
    places = pc.add(n, 1)
    x, y = (pc.subtract(h, pc.multiply(pc.divide(h, places), places)) for h in (h1, h2))
    low, high = pc.min_element_wise(x, y), pc.max_element_wise(x, y)
    cut = [_cut_units(split_units(parts.slice(a, b - a)), first.slice(a, b - a),
                      low.take(owner.slice(a, b - a)), high.take(owner.slice(a, b - a))) for a, b in runs]
    whole = []
    for role in range(3):
        pieces = pa.concat_arrays([c[role] for c in cut] or [pa.array([], pa.string())])
        whole.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(starts), pieces), ""))
    return n, low, high, whole


def _rearrange(plain_percent: int, spm_percent: int, markers: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            for a, b in _slices(texts, 8 * SLICE_BYTES):
                yield rearranged(batch.slice(a, b - a), texts.slice(a, b - a))

    def rearranged(batch: pa.RecordBatch, texts: pa.LargeStringArray) -> pa.RecordBatch:
        h1, h2, h3, h4 = (batch.column(h) for h in _DRAWS)
        n, low, high, (prefix, middle, suffix) = cut_texts(texts, h1, h2)
        plain = pc.or_(pc.equal(n, 0), pc.greater_equal(h3, 100 - plain_percent))
        for m in markers:
            plain = pc.or_(plain, pc.match_substring(texts, m))
        spm = pc.less(h4, spm_percent)
        p, s, m = markers
        output = pc.if_else(plain, texts.cast(pa.string()), pc.if_else(
            spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, ""),
            pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")))
        none = pa.scalar(None, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), n, pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
             pc.if_else(plain, none, low), pc.if_else(plain, none, pc.subtract(high, low)),
             output],
            ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def _draw(digest: Column, nth: int) -> Column:
    """The nth group of eight hexadecimal digits, as an unsigned number."""
    return F.conv(F.substring(digest, 8 * nth + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: str = "1",
                   plain_percent: int = 10, spm_percent: int = 20,
                   markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """One row per input row: id, n (units), form, prefix_chars, middle_chars (null if plain) and
    output. ``plain_percent`` of the documents stay plain, ``spm_percent`` of the others are spm."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
                    .cast("binary"), 256)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), digest.alias("digest")).select(
        "id", "text", _draw(F.col("digest"), 0).alias("h1"), _draw(F.col("digest"), 1).alias("h2"),
        (_draw(F.col("digest"), 2) % 100).alias("h3"), (_draw(F.col("digest"), 3) % 100).alias("h4"))
    id_type = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(
        _rearrange(plain_percent, spm_percent, tuple(markers)),
        f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("id", id_col)


def restored_text(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that was rearranged. A text that holds a marker is plain, so the first occurrence
    of a marker is the marker itself."""
    p, s, m = markers

    def between(a: str, b: str | None) -> Column:
        begin = F.locate(a, output) + len(a)
        end = F.locate(b, output) if b else F.char_length(output) + 1
        return F.substring(output, begin, end - begin)

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
