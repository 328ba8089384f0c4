"""Survivor pairs: a firm seen at the base year and at a horizon in the same industry.

The reference joins the base-year cross-section to each horizon on (firm, country,
industry); a firm-year that occurs k times at the base and m times at the horizon
gives k * m pairs. No operator here emits those pairs. Rows are first pivoted per
firm key, with per-year counts, sums and extremes (``per_firm``: one partial/final
aggregate, so a hot key is combined map-side), and every pair statistic is computed
from those per-side aggregates:

* sums of products of pair terms factor into per-side counts and sums (the markup
  decomposition), which is exact for any number of copies;
* the sum of |a - b| over pairs does not factor. A key whose base and horizon rows
  each carry one distinct value (the normal case, and exact copies) is closed-form;
  any other key goes through ``exact_abs_pair_sums``, a range-partitioned sort with
  running sums that splits even one huge key over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmdyn.operators.longdiff import not_null
from firmdyn.schema import CELL, FIRM_KEY, YEAR, LongDiffSpec


def side(yr: int) -> str:
    return f"_{yr}"


def count_at(yr: int, n: str = "n") -> Column:
    return F.col(f"{n}{side(yr)}")


def survivor(base: int, h: int, n: str = "n") -> Column:
    """A firm key with rows at the base year and at horizon ``h`` (row counts ``n``)."""
    return (count_at(base, n) > 0) & (count_at(h, n) > 0)


def single_valued(years: Sequence[int], lo: str = "lo", hi: str = "hi") -> Column:
    """Every year of the firm key carries one distinct value (min equals max)."""
    cond = F.lit(True)
    for yr in years:
        cond = cond & F.coalesce(F.col(f"{lo}{side(yr)}") == F.col(f"{hi}{side(yr)}"), F.lit(True))
    return cond


def window_years(specs: Sequence[LongDiffSpec]) -> list[int]:
    """Every year any of the windows reads; windows sharing a panel share one pivot."""
    return sorted({y for spec in specs for y in spec.years})


def firm_key_rows(df: DataFrame, years: Sequence[int], cols: Sequence[str]) -> DataFrame:
    """Rows of the given years whose firm key is complete (null keys never pair)."""
    return (df.where(F.col(YEAR).isin(*years) & not_null(FIRM_KEY))
              .select(*FIRM_KEY, YEAR, *cols))


def per_firm(rows: DataFrame, years: Sequence[int],
             aggregates: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """One row per firm key: per year a row count ``n_{y}`` and every named aggregate
    (a function of the year condition)."""
    y = F.col(YEAR)
    aggs = []
    for yr in years:
        on = y == yr
        aggs.append(F.count(F.when(on, F.lit(1))).alias(f"n{side(yr)}"))
        for name, fn in (aggregates or {}).items():
            aggs.append(fn(on).alias(f"{name}{side(yr)}"))
    return rows.groupBy(*FIRM_KEY).agg(*aggs)


def survivor_pairs(sample: DataFrame, spec: LongDiffSpec) -> DataFrame:
    """Per industry and horizon: survivor pairs (with fan-out of repeated firm-years)
    and distinct surviving firms. Industries and horizons without a pair are absent."""
    firms = per_firm(firm_key_rows(sample, spec.years, []), spec.years)
    aggs = []
    for h in spec.horizons:
        s = survivor(spec.base, h)
        aggs.append(F.sum(F.when(s, count_at(spec.base) * count_at(h))).alias(f"pairs_{h}"))
        aggs.append(F.count(F.when(s, F.lit(1))).alias(f"firms_{h}"))
    cells = firms.groupBy(*CELL).agg(*aggs)
    per_h = F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"pairs_{h}").alias("n_pairs"),
                 F.col(f"firms_{h}").alias("n_firms"))
        for h in spec.horizons]))
    return (cells.select(*CELL, per_h.alias("_h"))
                 .select(*CELL, "_h.horizon", "_h.n_pairs", "_h.n_firms")
                 .where(F.col("n_pairs") > 0))


def exact_abs_pair_sums(vals: DataFrame, pairs: Sequence[tuple[int, int]], value: str,
                        count: str) -> DataFrame:
    """Per industry and (base, horizon) of ``pairs``: ``pairs_{b}_{h}`` and ``abs_{b}_{h}``,
    the number of survivor pairs and the sum of |v_h - v_b| over them, exactly.

    ``vals`` holds (firm key, year, value, count) with one row per distinct value of
    a firm-year, ``count`` copies of it. For a horizon row a,
    sum_b |a - b| = a * (2 * NB_le - NB) - 2 * SB_le + SB, where NB/SB are the base
    count and value sum of the key and NB_le/SB_le those of base rows not above a.

    One range sort serves all pairs. Rows are range-partitioned on (key, value): every
    partition holds a sorted run, and a key bigger than a partition spans several.
    Running sums are taken inside each (key, partition) segment; a key's earlier
    segments enter through their totals, which a second window over the (few) segments
    of the key supplies. Ties contribute zero either way, so their order does not matter.
    """
    y, v, c = F.col(YEAR), F.col(value), F.col(count)
    bases = sorted({b for b, _ in pairs})

    def on(yr: int, expr: Column) -> Column:
        return F.when(y == yr, expr).otherwise(F.lit(0) * expr)

    ranged = (vals.repartitionByRange(*FIRM_KEY, value)
                  .withColumn("_seg", F.spark_partition_id()))
    run = (Window.partitionBy(*FIRM_KEY, "_seg").orderBy(value)
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumns({f"_{k}_le{side(b)}": F.sum(on(b, e)).over(run)
                                for b in bases for k, e in (("n", c), ("s", c * v))})
    seg_aggs = [F.sum(on(b, e)).alias(f"_{k}{side(b)}")
                for b in bases for k, e in (("n", c), ("s", c * v))]
    for h in sorted({h for _, h in pairs}):
        seg_aggs += [F.sum(on(h, c)).alias(f"_c{side(h)}"), F.sum(on(h, c * v)).alias(f"_a{side(h)}")]
    seg_aggs += [F.sum(on(h, c * (v * F.col(f"_n_le{side(b)}") - F.col(f"_s_le{side(b)}"))))
                 .alias(f"_l_{b}_{h}") for b, h in pairs]
    segs = local.groupBy(*FIRM_KEY, "_seg").agg(*seg_aggs)
    key = Window.partitionBy(*FIRM_KEY)
    before = key.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    segs = segs.withColumns({
        f"_{k}_{where}{side(b)}": F.coalesce(F.sum(f"_{k}{side(b)}").over(w), F.lit(0) * F.col(f"_{k}{side(b)}"))
        for b in bases for k in "ns" for where, w in (("before", before), ("all", key))})
    aggs = []
    for b, h in pairs:
        n_all, s_all = F.col(f"_n_all{side(b)}"), F.col(f"_s_all{side(b)}")
        total = (2 * F.col(f"_l_{b}_{h}")
                 + (2 * F.col(f"_n_before{side(b)}") - n_all) * F.col(f"_a{side(h)}")
                 + (s_all - 2 * F.col(f"_s_before{side(b)}")) * F.col(f"_c{side(h)}"))
        aggs.append(F.sum(F.col(f"_c{side(h)}") * n_all).alias(f"pairs_{b}_{h}"))
        aggs.append(F.sum(total).alias(f"abs_{b}_{h}"))
    return segs.groupBy(*CELL).agg(*aggs)
