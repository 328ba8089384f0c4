"""Diagnostics over outcome tables: summaries, sign checks, country coverage.

Outcome tables are industry-level (countries x two-digit codes), so these run as
ordinary aggregates over the unpivoted (metric, value) form, not a driver loop.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from firmdyn.schema import OUT_COUNTRY, OUT_INDUSTRY

# Quartiles reported by the summary (linear interpolation).
SUMMARY_QUANTILES = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))


def ld_columns(df: DataFrame, keep: Callable[[str], bool] = lambda c: c.startswith("LD_")):
    return [c for c in df.columns if keep(c)]


def column_stats(df: DataFrame, columns: list[str],
                 stats: dict[str, Callable[[Column], Column]],
                 counts: tuple[str, ...] = (), kind: str = "double") -> DataFrame:
    """One row per column: ``metric`` (the column name) and every statistic.

    The table is unpivoted to (metric, value) and grouped by metric, so each statistic
    is one aggregate whatever the number of columns. The grouped rows are joined onto
    the list of column names (schema, not data), so an empty table still gives one row
    per column: the ``counts`` statistics 0, the others null."""
    cast = df.select(*[F.col(c).cast(kind).alias(c) for c in columns])
    v = F.col("value")
    grouped = (cast.unpivot([], columns, "metric", "value")
                   .groupBy("metric").agg(*[fn(v).alias(name) for name, fn in stats.items()]))
    names = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in columns])).alias("metric"))
    return names.join(grouped, "metric", "left").select(
        "metric", *[F.coalesce(F.col(n), F.lit(0)).alias(n) if n in counts else F.col(n)
                    for n in stats])


def outcome_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: count, null_count, mean, std, min, p25, p50, p75, max of the numbers, and
    min_key, max_key of the text columns; what does not apply is null."""
    cols = columns if columns is not None else df.columns
    texts = [f.name for f in df.schema.fields if f.name in cols and isinstance(f.dataType, StringType)]
    numbers = [c for c in cols if c not in texts]
    parts = []
    if numbers:
        parts.append(_number_summary(df, numbers))
    if texts:
        stats = {"count": F.count, "null_count": lambda v: F.count(F.lit(1)) - F.count(v),
                 "min_key": F.min, "max_key": F.max}
        parts.append(column_stats(df, texts, stats, counts=("count", "null_count"), kind="string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _number_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    stats = {
        "count": F.count,
        "null_count": lambda v: F.count(F.lit(1)) - F.count(v),
        "mean": F.mean,
        "std": F.stddev_samp,
        "min": F.min,
        **{name: (lambda v, q=q: F.percentile(v, q)) for name, q in SUMMARY_QUANTILES},
        "max": F.max,
    }
    return column_stats(df, cols, stats, counts=("count", "null_count"))


def sign_check(df: DataFrame) -> DataFrame:
    """Mean and standard deviation of every LD_ column."""
    return column_stats(df, ld_columns(df), {"mean": F.mean, "std": F.stddev_samp})


def within_check(df: DataFrame) -> DataFrame:
    """Mean of every column whose name contains ``Within``."""
    return column_stats(df, ld_columns(df, lambda c: "Within" in c), {"mean": F.mean})


def country_coverage(results: Mapping[str, DataFrame]) -> DataFrame:
    """Per outcome: number of countries and their sorted, comma-joined codes."""
    parts = [
        df.agg(F.count_distinct(OUT_COUNTRY).alias("n_countries"),
               F.when(F.count(OUT_COUNTRY) > 0, F.concat_ws(
                   ",", F.sort_array(F.collect_set(OUT_COUNTRY)))).alias("countries"))
          .select(F.lit(name).alias("outcome"), "n_countries", "countries")
        for name, df in results.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def outcome_shapes(results: Mapping[str, DataFrame]) -> DataFrame:
    """Per outcome: number of rows and of columns."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("outcome"), "n_rows",
                       F.lit(len(df.columns)).alias("n_columns"))
             for name, df in results.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` industries in the order of their keys."""
    return df.orderBy(OUT_COUNTRY, OUT_INDUSTRY).limit(n)
