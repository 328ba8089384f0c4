"""Exact deduplication by two-pass Bloom filtering.

Pass one hashes every normalised text and fills a Bloom filter that remembers which slots
were hit at least twice. Pass two probes it: a row with a slot that was hit once is certainly
unique and passes straight through; only the possibly repeated hashes are shuffled, grouped by
their SHA-256 and resolved exactly, so false positives cost work but never change a result.

The filter is built by the tasks (each sends its distinct slots, a few bytes per row, to the
chunk that owns them) and is broadcast as a bitmap. ``slice_bits`` bounds every broadcast
(2**28 bits, 32 MB): a corpus that needs more bits is split by hash into slices, each with a
filter of its own, and the fingerprint table is laid out by slice so each is read once.

Defined cases: null text counts as empty; a group whose ids are all null keeps one row, with
null ``keep_id``; of rows that repeat both id and text one is kept; columns other than the id
and the text are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmdyn.llm.common import SPACE, join_groups, written
from firmdyn.session import stash, stash_observed

PROBES = 2
CHUNK_BITS = 1 << 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def text_sha256(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _slots_by_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per chunk of the filter: the slots this task's rows hit, and those they hit twice."""
    parts = [b.to_numpy().ravel() for b in batches]
    if not parts:
        return
    slots, n = np.unique(np.concatenate(parts), return_counts=True)
    chunk = slots // CHUNK_BITS
    starts = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]) if len(slots) else []
    ends = np.r_[starts[1:], len(slots)] if len(slots) else []
    offset = (slots % CHUNK_BITS).astype("<u2")
    for at in range(0, len(starts), 4096):
        rng = list(zip(starts[at:at + 4096], ends[at:at + 4096]))
        yield pd.DataFrame({"chunk": [int(chunk[a]) for a, _ in rng],
                            "hit": [offset[a:b].tobytes() for a, b in rng],
                            "twice": [offset[a:b][n[a:b] > 1].tobytes() for a, b in rng]})


def _merge_chunk(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
    """The chunk's bitmap of slots hit at least twice, as 64-bit words."""
    count = np.zeros(CHUNK_BITS, dtype=np.int64)
    for col in ("hit", "twice"):
        for b in parts[col]:
            count[np.frombuffer(b, "<u2")] += 1
    words = np.packbits(count > 1, bitorder="little").view("<i8")
    return pd.DataFrame({"chunk": [key[0]], "words": [words]})


def _repeat_filter(prints: DataFrame, probes: list[Column]) -> DataFrame:
    """(chunk, words): the bitmap of slots that at least two rows hit."""
    hits = prints.select(*[p.alias(f"s{i}") for i, p in enumerate(probes)]).mapInPandas(
        _slots_by_task, "chunk long, hit binary, twice binary")
    return hits.groupBy("chunk").applyInPandas(_merge_chunk, "chunk long, words array<long>")


def _is_set(probe: Column, words: Column) -> Column:
    bit = F.pmod(probe, F.lit(CHUNK_BITS)).cast("int")
    word = F.get(words, F.shiftright(bit, 6))
    return F.coalesce(F.call_function("shiftright", word, F.pmod(bit, F.lit(64)))
                      .bitwiseAND(F.lit(1)) == 1, F.lit(False))


def bloom_exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                      bits_per_row: int = 16, slice_bits: int = 1 << 28) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    prints, seen = stash_observed(docs.select(F.col(id_col).alias("id"),
                                              text_sha256(F.col(text_col)).alias("sha")))
    need = max(CHUNK_BITS, seen["rows"] * bits_per_row)
    n_slices = -(-need // slice_bits)
    slots = -(-need // n_slices)
    if n_slices > 1:
        prints = stash(prints.withColumn(
            "slice", F.pmod(F.xxhash64(F.lit("slice"), "sha"), F.lit(n_slices))), "slice")
    else:
        prints = prints.withColumn("slice", F.lit(0).cast("long"))

    probes = [F.pmod(F.xxhash64(F.lit(i), "sha"), F.lit(slots)) for i in range(PROBES)]
    passed, repeated = [], []
    for s in range(n_slices):
        own = prints.where(F.col("slice") == s)
        bitmap = stash(_repeat_filter(own, probes))
        probed = own
        for i, p in enumerate(probes):
            chunk = bitmap.select(F.col("chunk").alias(f"c{i}"), F.col("words").alias(f"w{i}"))
            probed = (probed.withColumn(f"p{i}", p)
                            .withColumn(f"c{i}", F.floor(F.col(f"p{i}") / CHUNK_BITS))
                            .join(F.broadcast(chunk), f"c{i}", "left"))
        again = reduce(Column.__and__, [_is_set(F.col(f"p{i}"), F.col(f"w{i}"))
                                        for i in range(PROBES)])
        probed = probed.select("id", "sha", again.alias("again"))
        passed.append(probed.where(~F.col("again")))
        repeated.append(probed.where("again"))

    unique = reduce(DataFrame.unionByName, passed).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    # copies are folded in the map tasks, by (text, id) and then by text
    per_id, seen = stash_observed(reduce(DataFrame.unionByName, repeated)
                                  .groupBy("sha", "id").agg(F.count(F.lit(1)).alias("n")))
    groups = stash(per_id.groupBy("sha").agg(F.min("id").alias("keep_id"),
                                             F.sum("n").alias("group_size"),
                                             F.count(F.lit(1)).alias("_ids")))
    resolved = join_groups(per_id, groups, "sha", "_ids", seen["rows"]).select(
        "id", "keep_id", "group_size", "sha",
        F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth"))
    resolved = resolved.select(
        "id", "keep_id", "group_size",
        ((F.col("nth") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"), "sha")
    return unique.unionByName(resolved).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept",
        F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``bloom_exact_dedup`` keeps, all columns."""
    verdict = stash(bloom_exact_dedup(docs, id_col, text_col))
    many = verdict.groupBy(id_col).count().where("count > 1").select(id_col)
    lost = verdict.where(~F.col("kept")).select(id_col).unionByName(many)
    lost, many = written(lost.distinct()), written(many)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("key")
    rows = docs.select(key, F.struct("*").alias("row"))
    single = rows.join(lost.select(key), "key", "left_anti")
    # ids that occur in several rows: choose by text, and one row of each text
    repeated = (rows.join(many.select(key), "key", "left_semi")
                .withColumn("sha", text_sha256(F.col("row")[text_col]))
                .join(verdict.where("kept").select(key, F.col("text_sha256").alias("sha")), ["key", "sha"], "left_semi")
                .dropDuplicates(["key", "sha"]))
    return single.select("row").unionByName(repeated.select("row")).select("row.*")
