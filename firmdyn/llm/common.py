"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmdyn.session import checked_broadcast

#: Whitespace and words as every contract of this subpackage defines them (fixed values).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: A key with at least 1/HOT_SHARE of all rows is hot, so there are at most HOT_SHARE hot keys.
HOT_SHARE = 1000


#: Tables that are written anyway are broadcast if they take at most so many bytes.
SMALL_BYTES = 16 << 20


def written(df: DataFrame) -> DataFrame:
    """``df`` written and measured: its joins broadcast it if it is small, and shuffle otherwise."""
    return checked_broadcast(df, SMALL_BYTES)[0]


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs now. It deletes them once the driver has
    collected its garbage, which a driver with room to spare may put off for as long as it runs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (null ids count as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per ``key``, one column or several, holding the group's number
    of rows in ``size``; ``total`` is their sum). Groups with at least 1/HOT_SHARE of all rows,
    HOT_SHARE of them at most, are broadcast, so a hot group's rows stay where they are; the
    others are joined by a shuffle."""
    hot = F.col(size) * HOT_SHARE >= total
    rest = [c for c in groups.columns if c not in ([key] if isinstance(key, str) else key)]
    big = groups.where(hot).withColumn("_hot", F.lit(True))
    marked = rows.join(F.broadcast(big), key, "left")
    on_hot = marked.where("_hot").drop("_hot")
    cold = marked.where(F.col("_hot").isNull()).drop("_hot", *rest)
    return on_hot.unionByName(cold.join(groups.where(~hot), key))
