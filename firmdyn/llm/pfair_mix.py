"""Mixing sources to target weights by Pfair scheduling.

Every source's documents are cut into blocks of at most ``block_rows``, whose sizes differ by one
at most. With weight w in slots, the k-th block (from 0) of a source is released at slot
floor(k / w) and due at ceil((k + 1) / w); in each slot the released block with the earliest
deadline runs. That meets every deadline, so after any number of slots a source is less than one
block away from its weight. The target weights are those of documents: a source whose blocks are
smaller (it has fewer than ``block_rows`` documents, say) gets the more slots for it.

The weights hold as given over the whole run, however long (as whole multiples of 2^-SHARE_BITS
of the largest one). The order of the blocks is found block by block in one task, which holds
only the state of the sources and writes the slots as a table; documents are joined to it.
A source's documents are numbered by a range-partitioned sort with per-partition offsets, so the
largest source is spread over all tasks. With ``period``, weights are those of slots, rounded to
multiples of 1 / period, and the schedule repeats after ``period`` slots (at most MAX_PERIOD).

``size="cover"`` runs until every document has been used; smaller sources start over (epochs).
``size="once"`` ends when a source has no fresh block left and repeats nothing.

Defined cases: every row is a document, so rows that repeat an id and a source, or have no id, are
numbered (``copy``) and have positions of their own; a null source is a source of its own; of
equal deadlines the source first in order (null first) runs first; a document's text is not read
by ``pfair_mix`` and moved whole, of any length, by ``mixed_rows``; no rows give no rows; a source
without a given weight, or too many sources, raise.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import count, islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmdyn.llm.common import written
from firmdyn.session import stash, stash_observed

#: Bounds of a given period and of the sources, and precision of a weight.
MAX_PERIOD, MAX_SOURCES, SHARE_BITS = 100_000, 10_000, 80
#: Slots that are written at once, and slots that are broadcast at most.
BATCH_SLOTS, BROADCAST_SLOTS = 1 << 16, 1 << 17
#: Copies of one id and source that one task numbers at once.
COPIES_AT_ONCE = 1 << 16


def whole_weights(weights: list[float], period: int) -> list[int]:
    """Positive weights as whole numbers that add up to ``period``, each at least 1 (largest
    remainder)."""
    total = sum(map(_exact, weights))
    exact = [_exact(w) * period / total for w in weights]
    out = [max(1, int(x)) for x in exact]
    favoured = [(float(exact[i] - x), i) for i, x in enumerate(out) if x > 1]
    heapq.heapify(favoured)
    for _ in range(period - sum(out), 0):  # weights below 1 take from the most favoured
        _, i = heapq.heappop(favoured)
        out[i] -= 1
        if out[i] > 1:
            heapq.heappush(favoured, (float(exact[i] - out[i]), i))
    by_rest = sorted(range(len(weights)), key=lambda i: (out[i] - exact[i], i))
    for i in by_rest[:period - sum(out)]:
        out[i] += 1
    return out


def _exact(weight: float) -> Fraction:
    """A weight as it is written: 0.9 is nine tenths."""
    return Fraction(str(float(weight)))


def exact_shares(weights: list[float], documents: list[int], blocks: list[int]) -> list[int]:
    """Shares of the slots, for target weights of documents: a source needs the more slots the
    smaller its blocks are."""
    slots = [_exact(w) * b / n for w, n, b in zip(weights, documents, blocks)]
    top = max(slots)
    return [max(1, round(x / top * 2**SHARE_BITS)) for x in slots]


def turns(shares: list[int]) -> Iterator[tuple[int, int]]:
    """Which source runs in each slot, and the number of its block, without end."""
    total = sum(shares)
    later = [(0, i, 0) for i in range(len(shares))]  # (release, source, block)
    heapq.heapify(later)
    ready: list[tuple[int, int, int]] = []  # (deadline, source, block)
    for slot in count():
        while later and later[0][0] <= slot:
            _, i, k = heapq.heappop(later)
            heapq.heappush(ready, (-(-(k + 1) * total // shares[i]), i, k))
        _, i, k = heapq.heappop(ready)
        yield i, k
        heapq.heappush(later, ((k + 1) * total // shares[i], i, k + 1))


def schedule(shares: list[int]) -> list[int]:
    """Which source runs in each slot of one period, for whole shares that add up to it."""
    return [i for i, _ in islice(turns(shares), sum(shares))]


def run_of(shares: list[int], blocks: list[int], size: str) -> Iterator[tuple[int, int]]:
    """The turns of the whole schedule of sources with ``blocks`` blocks each."""
    unused = len(blocks)
    for i, k in turns(shares):
        if size == "once" and k >= blocks[i]:
            return
        yield i, k
        unused -= k == blocks[i] - 1
        if size == "cover" and not unused:
            return


def _slots(shares: list[int], blocks: list[int], size: str):
    def run(_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, at = run_of(shares, blocks, size), 0
        while part := list(islice(found, BATCH_SLOTS)):
            out = pd.DataFrame(part, columns=["nth", "k"])
            yield out.assign(slot=range(at, at + len(part)))
            at += len(part)

    return run


def _numbered(thin: DataFrame) -> DataFrame:
    """(id, source, copy): a row per copy of each (id, source, copies), whose copies are counted
    out by several tasks if they are many."""
    parts = thin.where("copies > 1").select("id", "source", "copies", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_AT_ONCE).cast("long"))).alias("from"))
    upto = F.least(F.col("copies"), F.col("from") + COPIES_AT_ONCE) - 1
    counted = parts.repartition("id", "source", "from").select(
        "id", "source", F.explode(F.sequence("from", upto)).alias("copy"))
    return thin.where("copies = 1").select("id", "source", F.lit(0).cast("long").alias("copy")).unionByName(counted)


def _offsets(placed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, before): how many rows of the keys lie in the parts before this one."""
    per_part = placed.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(*keys, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def pfair_mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
              id_col: str = "doc_id", source_col: str = "source", *, temperature: float = 0.7,
              block_rows: int = 100, period: int | None = None, size: str = "cover") -> DataFrame:
    """One row per use of a document: id, source, copy (0 unless rows repeat the id and the
    source), block, epoch, slot, position. ``position`` orders the mix. ``weights`` maps sources to target weights (0 leaves a source out); by
    default they follow the sources' document counts to the power ``temperature``."""
    if size not in ("cover", "once"):
        raise ValueError(f"size is 'cover' or 'once', not {size!r}")
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    thin = (docs.groupBy(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"))
            .agg(F.count(F.lit(1)).alias("copies")))
    placed = stash(_numbered(thin).withColumn("key", F.xxhash64(F.lit("mix"), "id", "copy"))
                   .repartitionByRange("source", "key", "id", "copy")
                   .withColumn("part", F.spark_partition_id()))
    per_part = _offsets(placed, ["source"])

    counts = placed.groupBy("source").count().orderBy("source").limit(MAX_SOURCES + 1).collect()
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        weights = {r["source"]: r["count"] ** temperature for r in counts}
    if missing := [r["source"] for r in counts if r["source"] not in weights]:
        raise ValueError(f"sources without a weight: {missing[:10]}")
    used = [(r["source"], r["count"]) for r in counts if weights[r["source"]] > 0]
    schema = f"id {id_type}, source string, copy long, block long, epoch long, slot long, position long"
    if not used:
        return spark.createDataFrame([], schema).withColumnsRenamed({"id": id_col, "source": source_col})
    given, documents = [weights[s] for s, _ in used], [n for _, n in used]
    blocks = [-(-n // block_rows) for n in documents]
    if period is None:
        shares = exact_shares(given, documents, blocks)
    else:
        shares = whole_weights(given, min(MAX_PERIOD, max(period, 10 * len(used))))
    slots, seen = stash_observed(spark.range(0, 1, 1, 1).mapInPandas(
        _slots(shares, blocks, size), "nth int, k long, slot long"))
    runs = slots.groupBy("nth").agg(F.count(F.lit(1)).alias("runs"))
    # by Arrow: a list would be an RDD, whose rows pass through a Python daemon and workers of their own
    listed = pa.table({"source": pa.array([s for s, _ in used], pa.string()), "nth": pa.array(range(len(used)), pa.int32()),
                       "documents": pa.array(documents, pa.int64()), "blocks": pa.array(blocks, pa.int64())})
    sources = spark.createDataFrame(listed).join(runs, "nth")

    inside = Window.partitionBy("source", "part").orderBy("key", "id", "copy")
    ranked = placed.withColumn("rank", F.row_number().over(inside) - 1)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    ranked = ranked.join(per_part, same(ranked, per_part) & (ranked["part"] == per_part["part"])).select(
        ranked["id"], ranked["source"], "copy", (F.col("before") + F.col("rank")).alias("rank"))
    timed = (ranked.join(F.broadcast(sources), same(ranked, sources))
             .select("id", ranked["source"], "copy", "nth", "documents", "blocks", "runs", "rank")
             .withColumn("block", F.expr("rank * blocks div documents"))
             .withColumn("row", F.expr("rank - (block * documents + blocks - 1) div blocks")))
    used_at = (timed.where(F.col("block") < F.col("runs"))
               .withColumn("k", F.explode(F.sequence("block", F.col("runs") - 1, "blocks")))
               .join(F.broadcast(slots) if seen["rows"] <= BROADCAST_SLOTS else slots.hint("merge"), ["nth", "k"]))
    return used_at.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "copy", "block",
        F.expr("k div blocks").alias("epoch"), "slot",
        (F.col("slot") * block_rows + F.col("row")).alias("position"))


def mixed_rows(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
               id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often and in the order in which the mix uses them."""
    mix = pfair_mix(docs, weights, id_col, source_col, **options).select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), "copy", "position")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
                       F.struct("*").alias("row"))
    again = written(rows.groupBy("_id", "_source").count().where("count > 1").select(
        F.col("_id").alias("_again_id"), F.col("_source").alias("_again_source"), F.lit(True).alias("_again")))
    marked = rows.join(again, F.col("_id").eqNullSafe(F.col("_again_id"))
                       & F.col("_source").eqNullSafe(F.col("_again_source")), "left")
    single = marked.where(F.col("_again").isNull()).select("_id", "_source", F.lit(0).cast("long").alias("_copy"), "row")
    numbered = single
    if again.limit(1).count():
        # rows of one id and source are numbered in the order in which they were written
        placed = stash(stash(marked.where("_again").select("_id", "_source", "row").withColumn(
            "nth", F.monotonically_increasing_id())).repartitionByRange("_id", "_source", "nth")
            .withColumn("part", F.spark_partition_id()))
        before = _offsets(placed, ["_id", "_source"]).withColumnsRenamed({"_id": "_b_id", "_source": "_b_source", "part": "_b_part"})
        inside = Window.partitionBy("_id", "_source", "part").orderBy("nth")
        numbered = placed.withColumn("rank", F.row_number().over(inside) - 1).join(
            before, F.col("_id").eqNullSafe(F.col("_b_id")) & F.col("_source").eqNullSafe(F.col("_b_source"))
            & (F.col("part") == F.col("_b_part"))).select(
                "_id", "_source", (F.col("before") + F.col("rank")).cast("long").alias("_copy"), "row").unionByName(single)
    same = (F.col("_id").eqNullSafe(F.col("id")) & F.col("_source").eqNullSafe(F.col("source"))
            & (F.col("_copy") == F.col("copy")))
    return (numbered.join(mix, same).select("row", "position").repartitionByRange("position")
            .sortWithinPartitions("position").select("row.*"))
