"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation several times, each time a few turns longer. Every turn gets the
rolling hash of the conversation up to and including it (two 64-bit words, each the exclusive or
of the turns' hashes, which include the turn's place). A conversation is dropped if its last
hash is the hash of a turn that is not the last one of some conversation (it is a prefix of a longer one,
found by an anti-join), and of equal conversations the one with the smallest id stays. The turns
of those that stay are rendered.

The hash is a running value per conversation, but no conversation is gathered in one task: turns
are range-partitioned by (conversation, turn), each partition runs over its own part, and the
parts before it enter through their totals. Prefixes and last hashes are made distinct in the
map tasks before the anti-join, so a first turn that all conversations share is one row.

No text can forge a turn: in rendered texts and roles, ``<``, any number of backslashes and ``|`` get one
backslash more before the ``|``, so they hold no marker, differ if the texts differ, and
``unescaped`` restores them; a role's line breaks are written as ``<n>``, and its ``<n>`` with one backslash more.

Conversations count as equal by two 64-bit hashes: that two of n different prefixes agree in both
has a probability of about n^2 / 2^129, 3e-19 for 10^10 prefixes.

Defined cases: a turn of any length is one cell; turns are ordered by turn, role and text, nulls first; repeated rows are one turn;
a null text is rendered as empty, a null role as ``unknown``, and both differ from that when
compared; a null conversation id is a conversation of its own; other columns are not read; no rows
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmdyn.session import stash

#: How a turn is rendered.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "nth", F.coalesce(F.concat(F.lit("r"), "role"), F.lit("-")),
                      F.coalesce(F.concat(F.lit("t"), "text"), F.lit("-")))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv, nth, role, text, h1, h2, last): every turn of (conv, turn, role, text) with its place
    from 1, the hashes of the conversation up to it, and whether it is the last."""
    keys = ["conv", "turn", "role", "text"]
    placed = stash(turns.dropDuplicates(keys).repartitionByRange(*keys)
                   .withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("conv", "part").orderBy("turn", "role", "text")
    per_part = placed.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_conv = Window.partitionBy("conv")
    per_part = per_part.select("conv", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
                               F.sum("n").over(of_conv).alias("length"))

    def with_parts(rows: DataFrame, parts: DataFrame, *names: str) -> DataFrame:
        return rows.join(parts, rows["conv"].eqNullSafe(parts["conv"]) & (rows["part"] == parts["part"])).select(
            *[rows[c] for c in rows.columns], *names)

    numbered = with_parts(placed.withColumn("row", F.row_number().over(inside)), per_part, "before", "length")
    hashed = (numbered.withColumn("nth", F.col("before") + F.col("row"))
              .withColumn("x1", _hash(1)).withColumn("x2", _hash(2)))
    hashed = stash(hashed.select("conv", "part", "nth", "role", "text", "x1", "x2",
                                 (F.col("nth") == F.col("length")).alias("last")))
    so_far = Window.partitionBy("conv", "part").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    totals = hashed.groupBy("conv", "part").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2"))
    totals = totals.select("conv", "part", *[F.coalesce(F.bit_xor(f"t{k}").over(ahead), F.lit(0)).alias(f"b{k}")
                                             for k in (1, 2)])
    running = hashed.withColumns({f"r{k}": F.bit_xor(f"x{k}").over(so_far) for k in (1, 2)})
    return with_parts(running, totals, "b1", "b2").select(
        "conv", "nth", "role", "text", F.col("r1").bitwiseXOR(F.col("b1")).alias("h1"),
        F.col("r2").bitwiseXOR(F.col("b2")).alias("h2"), "last")


def maximal_turns(log: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """The turns of the conversations that stay: conversation, place of the turn from 1, role, text,
    and n_equal, how many conversations have exactly these turns."""
    turns = log.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                       F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    hashed = stash(prefix_hashes(turns))
    key = ["nth", "h1", "h2"]
    whole = hashed.where("last").groupBy(*key).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_equal"))
    longer = hashed.where(~F.col("last")).select(*key).distinct()
    stay = stash(whole.join(longer, key, "left_anti").select("conv", "n_equal"))
    return hashed.join(stay, hashed["conv"].eqNullSafe(stay["conv"])).select(
        hashed["conv"].alias(conv_col), "nth", "role", "text", "n_equal")


def escaped(text: Column) -> Column:
    """``text`` without markers; texts without ``<|`` (or ``<\\|``, ...) are left alone."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given."""
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escaped_role(role: Column) -> Column:
    """``role`` on one line and without markers."""
    return F.replace(F.regexp_replace(escaped(role), r"<(\\*)n>", r"<$1\\n>"), F.lit("\n"), F.lit("<n>"))


def render(role: Column, text: Column) -> Column:
    """One turn in chat markup."""
    return F.concat(F.lit(OPEN), F.coalesce(escaped_role(role), F.lit("unknown")), F.lit(MIDDLE),
                    F.coalesce(escaped(text), F.lit("")), F.lit(CLOSE))


def format_chats(log: DataFrame, conv_col: str = "conv_id", **columns: str) -> DataFrame:
    """A rendered turn per row: conversation, nth, segment, n_equal. A conversation's segments in
    the order of ``nth`` are its text; rows are not gathered, so none is too long."""
    return maximal_turns(log, conv_col, **columns).select(
        conv_col, "nth", render(F.col("role"), F.col("text")).alias("segment"), "n_equal")


def rendered_chats(segments: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation: id, n_turns, text; for conversations that fit a cell."""
    return segments.groupBy(conv_col).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "segment"))),
                                 lambda s: s["segment"]), "").alias("text"))
