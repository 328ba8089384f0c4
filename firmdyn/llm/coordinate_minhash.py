"""Near duplicates by a signature-coordinate inverted join.

Every distinct shingle set gets a MinHash signature of ``COORDINATES`` values. A set is posted
under its (coordinate, value) pairs. Two sets with ``matches`` equal coordinates or more must meet
in the rarest ``COORDINATES - matches + 1`` pairs of each (prefix), and values that a single set
holds fill that prefix first, so a set with fewer than ``matches`` shared values is skipped
altogether and long posting lists are reached only by sets made almost wholly of common values.
Pairs that meet are counted over all coordinates; those at the threshold are confirmed on
the full shingle sets.

No long posting list is expanded into its pairs. Two rounds compare every member with one leader
of its list and join the components that are linked. Members of different components that are
left in a list are then compared directly if the list is short, and otherwise by what sets them
apart from the list's pivot (``_through_pivots``), which loses no link either.

A pair exactly at the similarity is missed with probability 2.4e-6 by 40 of 64 coordinates at
0.85, and 4.2e-6 by 36 of 64 at 0.8 (binomial tails); more similar pairs far more rarely.

Defined cases: null and word-less texts have no set, are linked with nothing and stay; equal sets
are one node, numbered for itself, so sets that share an id are nodes of their own; a null id is
linked with nothing and stays, with null ``component_id``; of a component the set with the
smallest id stays (of several of that id the one with the smallest key), in one row if rows
repeat it; a text of any length is taken whole, one text at a time; columns other than the id
and the text are not read; no rows give no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmdyn.llm.common import SMALL_BYTES, free_shuffles, join_groups, written
from firmdyn.session import checked_broadcast, stash, stash_observed

COORDINATES = 64
_rng = random.Random(20240607)
#: Odd multipliers and offsets of the signature's hash functions.
_A = np.array([_rng.getrandbits(64) | 1 for _ in range(COORDINATES)], dtype=np.uint64)
_B = np.array([_rng.getrandbits(64) for _ in range(COORDINATES)], dtype=np.uint64)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
CACHE_WORDS = 1 << 16
#: Posting lists up to this size are compared member by member, longer ones through a pivot.
SHORT_LIST = 256


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to CACHE_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: WordHashes, width: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the word shingles of a whole text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - width + 1)
    out = np.full(n, min(len(h), width), np.uint64)
    for j in range(min(width, len(h))):
        out = _scramble(out * _MIX[0] + h[j:j + n])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, ~np.uint64(0))
    for at in range(0, len(shingles), 1024):
        part = shingles[at:at + 1024, None] * _A + _B
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            sizes, keys, signs = [], [], []
            for text in batch.column("text"):  # one text at a time in memory
                s = shingle_set(text.as_py(), words, width)
                sizes.append(len(s))
                keys.append(_set_key(s))
                signs.append(signature(s).view(np.int32) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.string()),
                 pa.array(signs, pa.list_(pa.int32()))], ["id", "n", "set_key", "sign"])

    return run


def _set_key(shingles: np.ndarray) -> str | None:
    return xxhash.xxh3_128_hexdigest(shingles.tobytes()) if len(shingles) else None


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), words, width) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(map(_set_key, sets), pa.string()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "set_key", "set"])

    return run


def _keyed_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            keys = [_set_key(shingle_set(t.as_py(), words, width)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(keys, pa.string())],
                                             ["row", "id", "set_key"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label): ``labels`` with the components that ``edges`` (a, b; nodes) join merged
    under their smallest label. Label graph, minimum of the neighbours, pointer jumping."""
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("u"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("v"))
    arcs = edges.join(la, "a").join(lb, "b").where("u <> v").select("u", "v")
    arcs, many = checked_broadcast(arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
                                   .distinct(), SMALL_BYTES)
    if not many:
        return labels
    roots = written(arcs.groupBy("u").agg(F.least("u", F.min("v")).alias("root")))
    while True:
        lower = (arcs.join(roots.select(F.col("u").alias("v"), F.col("root").alias("near")), "v")
                 .groupBy("u").agg(F.min("near").alias("near")))
        step = lower.join(roots, "u").select("u", "root", F.least("root", "near").alias("low"))
        jump = roots.select(F.col("u").alias("low"), F.col("root").alias("far"))
        step = step.join(jump, "low", "left").withColumn("least", F.least("low", F.coalesce("far", "low")))
        seen: dict = {}
        roots, _ = checked_broadcast(step.select("u", F.col("least").alias("root"), (
            F.col("least") < F.col("root")).alias("moved")), SMALL_BYTES, seen, moved=F.count(F.when(F.col("moved"), 1)))
        roots = roots.drop("moved")
        if not seen["moved"]:
            break
    return written(labels.join(roots.withColumnRenamed("u", "label"), "label", "left").select(
        "node", F.coalesce("root", "label").alias("label")))


def _equal(a: Column, b: Column) -> Column:
    """In how many coordinates two signatures agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))


def _prefixes(sets: DataFrame, matches: int) -> tuple[DataFrame, DataFrame]:
    """(token, node): each set under the shared ones of its rarest coordinates; and (node,
    weight): how many sets hold its values, which is largest in the middle of a group."""
    token = F.call_function("shiftleft", F.col("pos").cast("long"), F.lit(32)) + (
        F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    posted = sets.select("node", F.posexplode("sign")).select("node", token.alias("token"))
    shared = stash(posted.groupBy("token").agg(F.count(F.lit(1)).alias("many")).where("many > 1"))
    mine = Window.partitionBy("node")
    ranked = (posted.join(shared, "token")
              .withColumn("m", F.count(F.lit(1)).over(mine))
              .withColumn("rank", F.row_number().over(mine.orderBy("many", "token"))))
    # the COORDINATES - m values that no other set holds come first in the prefix
    prefix = ranked.where(F.col("rank") <= F.col("m") - (matches - 1))
    weights = ranked.groupBy("node").agg(F.sum("many").alias("weight"))
    postings = stash(prefix.select("token", "node"))
    return postings, written(weights.join(postings.select("node").distinct(), "node", "left_semi"))


def _differences(percent: int):
    """What a set is posted under relative to its pivot. A ``far`` set has more shingles outside
    the pivot than a linked set can lack: as many as cannot all be lacked, by hash. Any other:
    all those and the pivot's that it lacks. ``apart``: it is not linked to the pivot;
    ``n_first``: of any so many of its shingles a linked set shares one. ``differ``: all that the
    set or the pivot lacks, unless that is more than the set itself."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                rows = []
                for p, x in zip(part["set_p"], part["set_x"]):
                    p, x = np.frombuffer(p, np.uint64), np.frombuffer(x, np.uint64)
                    own = np.setdiff1d(x, p, assume_unique=True)
                    both = len(x) - len(own)
                    spare = (100 - percent) * len(x) // 100  # what a linked set may lack
                    d = np.setxor1d(p, x, assume_unique=True).view(np.int64)
                    if len(own) > spare:
                        rows.append((True, True, spare + 1, own[:spare + 1].view(np.int64), d if len(d) <= len(x) else None))
                    else:
                        rows.append((False, 100 * both < percent * (both + len(d)),
                                     len(d) - percent * len(d) // (100 + percent), d, d))
                yield part[["pivot", "node", "label"]].assign(
                    **{c: list(v) for c, v in zip(("far", "apart", "n_first", "post", "differ"), zip(*rows))})

    return run


def _through_pivots(around: DataFrame, full: DataFrame, sets: DataFrame, alike, percent: int) -> DataFrame:
    """Pairs (a, b) of different components among the members of each pivot (pivot, node, label)
    that may be linked, found without comparing all of them.

    A set linked to y lacks (100 - percent) % of y at most. If y has more than that outside the
    pivot p (far), a linked set holds one of the first so many of them. For the others let D(x)
    be the shingles that x or p lacks: x and y differ in |D(x)| + |D(y)| - 2 |D(x) & D(y)|.
    Members linked to p are of one component, so of any other pair one, say x, is apart from p;
    then x and y can only be linked if they share more than percent / (100 + percent) of D(y),
    as nothing nearer to p than that helps x, so one of the rarest |D(y)| - that many. Each
    y meets others under its rarest shingles, x under all it is posted under, or if the bound
    holds for both under its rarest too. Where they meet, D(x) and D(y) give the exact
    similarity; only sets that share little with the pivot are left to signatures and full sets."""
    sp, sx = (full.select(F.col("node").alias(n), F.col("set").alias(f"set_{s}"))
              for n, s in (("pivot", "p"), ("node", "x")))
    found = around.join(sp, "pivot").join(sx, "node").mapInPandas(
        _differences(percent), "pivot long, node long, label long, far boolean, "
                               "apart boolean, n_first int, post array<long>, differ array<long>")
    found = stash(found)
    posted = stash(found.select("pivot", "node", "far", "n_first", F.size("post").alias("n"),
                                F.explode("post").alias("shingle")))
    shared = written(posted.groupBy("pivot", "shingle").agg(F.count(F.lit(1)).alias("many")).where("many > 1"))
    mine = Window.partitionBy("pivot", "node")
    ranked = (posted.join(shared, ["pivot", "shingle"])
              .withColumn("m", F.count(F.lit(1)).over(mine))
              .withColumn("rank", F.row_number().over(mine.orderBy("many", "shingle"))))
    # shingles that no other member is posted under are the rarest
    ranked = ranked.select("pivot", "shingle", "node", (
        F.col("far") | (F.col("rank") <= F.col("m") - (F.col("n") - F.col("n_first")))).alias("first"))
    entry = stash(ranked.join(found.drop("n_first", "post"), ["pivot", "node"]).join(
        sets.select("node", "n", "sign"), "node"))
    x, y = (entry.select("pivot", "shingle", *[F.col(c).alias(f"{c}_{s}") for c in (
        "node", "label", "far", "apart", "first", "differ", "n", "sign")]) for s in "xy")
    y = y.where("first_y")
    once = F.expr("first_x AND node_x < node_y")
    meet = F.when(F.col("far_y"), ~F.col("far_x") | once).otherwise(
        ~F.col("far_x") & F.col("apart_x") & (~F.col("apart_y") | once))
    # twice the common shingles, exactly, from what sets both apart from the pivot
    twice = (F.col("n_x") + F.col("n_y") - F.size("differ_x") - F.size("differ_y")
             + 2 * F.size(F.array_intersect("differ_x", "differ_y")))
    similar = F.when(F.col("differ_x").isNull() | F.col("differ_y").isNull(), alike("x", "y")).otherwise(
        (100 + percent) * twice >= 2 * percent * (F.col("n_x") + F.col("n_y")))
    return (x.join(y, (x["pivot"] == y["pivot"]) & (x["shingle"] == y["shingle"])
                   & (F.col("label_x") != F.col("label_y")) & meet & similar)
            .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    width: int = 5, percent: int = 80, matches: int = 36) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept. Documents are linked whose
    sets of ``width``-word shingles have 100 * intersection >= ``percent`` * union.
    ``matches`` is the number of equal coordinates from which a pair is confirmed."""
    return _judged(docs, id_col, text_col, width, percent, matches).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def _judged(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, matches: int) -> DataFrame:
    """(id, set_key, n, component, kept), a row per input row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    signed = stash(rows.mapInArrow(
        _sign(width), f"id {id_type}, n long, set_key string, sign array<int>"))
    usable = signed.where(F.col("id").isNotNull() & F.col("set_key").isNotNull())
    counted = stash(usable.groupBy("id", "set_key").agg(F.first("n").alias("n"),
                                                        F.count(F.lit(1)).alias("copies")))
    # copies fold in the map tasks; one node stands for a set, and the written table fixes its number
    sets = stash(usable.groupBy("set_key").agg(F.min("id").alias("id"), F.first("n").alias("n"),
                                               F.first("sign").alias("sign"))
                 .withColumn("node", F.monotonically_increasing_id()))
    postings, weights = _prefixes(sets, matches)
    labels = written(postings.select("node").distinct().withColumn("label", F.col("node")))
    nodes = written(sets.join(labels.select("node"), "node", "left_semi").select("node", "id", "set_key"))
    own = rows.join(written(nodes.select("id").distinct()), "id", "left_semi").mapInArrow(
        _sets(width), f"id {id_type}, set_key string, set binary").join(nodes, ["id", "set_key"]).select("node", "set")
    if counted.where("copies > 1").limit(1).count():  # a set is taken from one of its rows
        own = own.dropDuplicates(["node"])
    full = stash(own)

    side = {x: sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"),
                           F.col("sign").alias(f"sign_{x}")) for x in "ab"}

    def alike(a: str, b: str) -> Column:
        return ((100 * F.least(f"n_{a}", f"n_{b}") >= percent * F.greatest(f"n_{a}", f"n_{b}"))
                & (_equal(F.col(f"sign_{a}"), F.col(f"sign_{b}")) >= matches))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar."""
        sa, sb = (full.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab")
        pairs = written(pairs)
        sb = sb.join(pairs, "b", "left_semi")
        return written(pairs.join(sa, "a").join(sb, "b").mapInArrow(_confirm(percent), "a long, b long"))

    def alike_only(pairs: DataFrame) -> DataFrame:
        return written(pairs).join(side["a"], "a").join(side["b"], "b").where(alike("a", "b")).select("a", "b")

    def led(members: DataFrame, leader: Column) -> DataFrame:
        """Each member against its list's leader, where their components differ."""
        lead = members.groupBy("token").agg(leader.alias("lead"))
        pairs = (members.join(lead, "token").where(F.col("label") != F.col("lead.label"))
                 .select(F.least("node", "lead.node").alias("a"),
                         F.greatest("node", "lead.node").alias("b")).distinct())
        return alike_only(pairs)

    def members() -> DataFrame:
        return postings.join(labels, "node").join(weights, "node")

    # the middle of the list leads, then a node that differs from list to list
    middle = F.max(F.struct("weight", "node", "label"))
    free_shuffles(docs.sparkSession)  # and, here and below, the finished joins' broadcasts in the executors
    labels = components(confirmed(led(members(), middle)), labels)
    free_shuffles(docs.sparkSession)
    other = F.min(F.struct(F.xxhash64("node", "token").alias("h"), "node", "label"))
    labels = components(confirmed(led(members(), other)), labels)
    free_shuffles(docs.sparkSession)

    # what is left are members of one list in different components
    now = stash(members())
    mixed = now.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("weight", "node")).alias("lead"),
                                     F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    now = stash(now.drop("weight").join(mixed.select("token", "size", F.col("lead.node").alias("pivot")), "token"))
    short = now.where(F.col("size") <= SHORT_LIST)
    around = written(now.where((F.col("size") > SHORT_LIST) & (F.col("node") != F.col("pivot"))).select(
        "pivot", "node", "label").distinct())
    across = _through_pivots(around, full, sets, alike, percent)
    pivots = around.groupBy("node").agg(F.collect_set("pivot").alias("pivots"))  # of its lists
    # every member against every other, each pair in its first common list; not two of one pivot
    lists = short.groupBy("node").agg(F.collect_set("token").alias("lists"))  # as many as coordinates at most
    entry = stash(short.select("token", "node", "label").join(lists, "node").join(
        sets.select("node", "n", "sign"), "node").join(pivots, "node", "left").withColumn(
            "pivots", F.coalesce("pivots", F.array().cast("array<long>"))))
    x, y = (entry.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("label", "lists", "n", "sign", "pivots")],
                         F.col("node").alias(s)) for s in "ab")
    first_common = F.array_min(F.array_intersect("lists_a", "lists_b")) == x["token"]
    pairs = x.join(y, (x["token"] == y["token"]) & (F.col("label_a") != F.col("label_b"))
                   & (F.col("a") < F.col("b")) & ~F.arrays_overlap("pivots_a", "pivots_b")
                   & alike("a", "b") & first_common).select("a", "b").distinct()
    labels = components(confirmed(pairs.unionByName(across).distinct()), labels)
    free_shuffles(docs.sparkSession)

    # a component is named by the smallest id in it, whose set stays
    first = F.min(F.struct("id", "set_key"))
    heads = written(labels.join(sets.select("node", "id", "set_key"), "node").groupBy("label").agg(first.alias("head")))
    named = (sets.join(labels, "node", "left").join(heads, "label", "left")
             .select("set_key", F.coalesce(F.col("head"), F.struct("id", "set_key")).alias("head")))
    members_of = counted.groupBy("set_key").agg(F.count(F.lit(1)).alias("ids"))
    groups, seen = stash_observed(named.join(members_of, "set_key").select(
        "set_key", "head", "ids"), total=F.sum("ids"))
    found = join_groups(counted, groups, "set_key", "ids", seen["total"] or 0).select(
        "id", "set_key", "n", "head", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("nth"))
    stays = (F.col("nth") == 1) & (F.col("id") == F.col("head.id")) & (F.col("set_key") == F.col("head.set_key"))
    alone = signed.where(F.col("id").isNull() | F.col("set_key").isNull()).select(
        "id", "set_key", "n", F.col("id").alias("component"), F.lit(True).alias("kept"))
    return found.select("id", "set_key", "n", F.col("head.id").alias("component"), stays.alias("kept")).unionByName(alone)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                         width: int = 5, percent: int = 80, matches: int = 36) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns: of every component one row,
    and every row without a set or an id."""
    found = stash(_judged(docs, id_col, text_col, width, percent, matches).where(F.col("id").isNotNull()))
    verdict = found.groupBy("id").agg(F.max("kept").alias("any"), F.min("kept").alias("all")).where(~F.col("all"))
    lost, mixed = (written(verdict.where(c).select(F.col("id").alias("_id"))) for c in (~F.col("any"), F.col("any")))
    of = docs[id_col]
    rest = docs.join(lost, of == lost["_id"], "left_anti")
    if not mixed.limit(1).count():
        return rest
    # ids of which some rows stay: by the set, and one row of it
    some = docs.join(mixed, of == mixed["_id"], "left_semi").select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    row = some.schema["row"].dataType.simpleString()
    some = some.mapInArrow(_keyed_rows(width), f"row {row}, id {docs.schema[id_col].dataType.simpleString()}, set_key string")
    kept = found.where(F.col("kept") & F.col("set_key").isNotNull()).select("id", "set_key")
    chosen = some.join(kept, ["id", "set_key"], "left_semi").dropDuplicates(["id", "set_key"])
    return (rest.join(mixed, of == mixed["_id"], "left_anti")
            .unionByName(some.where(F.col("set_key").isNull()).select("row.*"))
            .unionByName(chosen.select("row.*")))
