"""Concentration (top-4 ratio, firm counts) and turbulence.

CR4: sum of the four largest sales shares of an industry-year (ordinal rank, so tied
firms still count four). Ranked on raw sales straight off the scan, the top-4 filter
becomes a partial WindowGroupLimit before the shuffle: at most four rows per
industry-year leave each map task, and four per group of map tasks reach the last
exchange (``largest``). The cell total and the
distinct firm count are one aggregate (the distinct count is split by firm id
first, so a big industry spreads over many tasks); CR4 = top-4 sales / total.

Turbulence: per industry, sum over survivor pairs of |share_h - share_b|, shares over
all positive-sales firms of the industry-year. A level over the pair, not a
difference; anchored on industries with survivors at the first horizon.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmdyn.functions import positive, ratio
from firmdyn.operators.longdiff import long_difference, not_null, output_keys
from firmdyn.operators.pairs import (count_at, exact_abs_pair_sums, firm_key_rows,
                                     per_firm, side, single_valued, survivor, window_years)
from firmdyn.schema import (CELL, CELL_YEAR, FIRM, FIRM_KEY, OUT_COUNTRY, OUT_INDUSTRY,
                            SALES, TOP_K, YEAR, LongDiffSpec, TREATMENT)
from firmdyn.session import checked_broadcast, materialize, materialize_observed


#: Groups of map tasks in which the largest rows are found first.
TOP_SALTS = 16
#: (column, label) of the long differences.
CONCENTRATION_MEASURES = (("cr4", "CR4"), ("n_firms", "n_firms"))


def _positive_sales(panel: DataFrame) -> DataFrame:
    return panel.where(positive(SALES))


def top_sales_by_year(panel: DataFrame, k: int = TOP_K) -> DataFrame:
    """(_country_, sic, year, top_sales): sales of the k largest firms."""
    rows = _positive_sales(panel).select(*CELL_YEAR, SALES)
    return (largest(rows, F.col(SALES), k)
            .groupBy(*CELL_YEAR).agg(F.sum(SALES).alias("top_sales")))


def largest(rows: DataFrame, value: Column, k: int, salts: int = TOP_SALTS) -> DataFrame:
    """The k rows of every industry-year with the largest ``value``, found in two levels.

    Map tasks are dealt to ``salts`` groups, and each industry-year is cut to k rows in its map
    tasks, then in each group, then as a whole. So the last exchange carries k rows per
    industry-year and group at most, however many map tasks there are, and the rows of one
    industry-year from all map tasks meet in ``salts`` tasks instead of one."""
    def cut(df: DataFrame, *keys: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(value.desc())
        return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")

    dealt = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    return cut(cut(dealt, *CELL_YEAR, "_salt").drop("_salt"), *CELL_YEAR)


def n_firms_by_year(panel: DataFrame) -> DataFrame:
    """(_country_, sic, year, n_firms, total_sales) over positive-sales rows.

    n_firms is the exact number of distinct firm ids; a missing id counts as one
    more distinct value."""
    rows = _positive_sales(panel)
    return rows.groupBy(*CELL_YEAR).agg(
        (F.count_distinct(FIRM)
         + F.max(F.col(FIRM).isNull().cast("long"))).alias("n_firms"),
        F.sum(SALES).alias("total_sales"))


def cr4_by_year(panel: DataFrame, k: int = TOP_K) -> DataFrame:
    """(_country_, sic, year, cr4)."""
    return concentration_by_year(panel, k).select(*CELL_YEAR, "cr4")


def concentration_by_year(panel: DataFrame, k: int = TOP_K,
                          with_totals: bool = False) -> DataFrame:
    """(_country_, sic, year, cr4, n_firms[, total_sales]). Both inputs are
    industry-year tables.

    As in the reference's left join of counts onto CR4 rows, an industry-year with
    a missing key gets no firm count."""
    top = top_sales_by_year(panel, k)
    counts = n_firms_by_year(panel).select(
        *[F.col(c).alias(f"_n_{c}") for c in CELL_YEAR], "n_firms", "total_sales")
    cond = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in CELL_YEAR])
    return top.join(counts, cond, "inner").select(
        *CELL_YEAR,
        ratio(F.col("top_sales"), F.col("total_sales")).alias("cr4"),
        F.when(not_null(CELL_YEAR), F.col("n_firms")).alias("n_firms"),
        *(["total_sales"] if with_totals else []))


def turbulence(panel: DataFrame, spec: LongDiffSpec = TREATMENT,
               max_bytes: int | None = None) -> DataFrame:
    """fic_code, borrower_sic, LD_turbulence_{base}_{h} per horizon."""
    return SalesPivot.of(panel, [spec], max_bytes).turbulences([spec])[spec]


def sales_pivot_aggregates() -> dict:
    """Per-year firm aggregates of positive-sales rows: sum ``sal``, min ``lo``, max ``hi``
    of sales (the row count ``n`` comes with every pivot)."""
    s = F.col(SALES)
    return {"sal": lambda on: F.sum(F.when(on, s)),
            "lo": lambda on: F.min(F.when(on, s)),
            "hi": lambda on: F.max(F.when(on, s))}


def sales_pivot(panel: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row per firm key over the positive-sales rows of ``years``."""
    rows = firm_key_rows(_positive_sales(panel), years, [SALES])
    return per_firm(rows, years, sales_pivot_aggregates())


def pivot_cells(firms: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row per industry with ``pivot_cell_aggregates``."""
    return firms.groupBy(*CELL).agg(*pivot_cell_aggregates(years))


def pivot_cell_aggregates(years: Sequence[int]) -> list[Column]:
    """Industry aggregates of a sales pivot: per year the sales total ``T_{y}`` and the
    number of distinct firms ``N_{y}`` (a firm key with rows in that year)."""
    aggs = []
    for yr in years:
        aggs.append(F.sum(f"sal{side(yr)}").alias(f"T{side(yr)}"))
        aggs.append(F.count(F.when(count_at(yr) > 0, F.lit(1))).alias(f"N{side(yr)}"))
    return aggs


def cell_years(cells: DataFrame, years: Sequence[int]) -> DataFrame:
    """(_country_, sic, year, total_sales, n_firms) for the industry-years with firms."""
    per_year = F.explode(F.array(*[
        F.struct(F.lit(yr).alias(YEAR), F.col(f"T{side(yr)}").alias("total_sales"),
                 F.col(f"N{side(yr)}").alias("n_firms"))
        for yr in years]))
    return (cells.select(*CELL, per_year.alias("_y"))
                 .select(*CELL, "_y.*").where(F.col("n_firms") > 0))


def concentration_from(top: DataFrame, cells: DataFrame, years: Sequence[int]) -> DataFrame:
    """(_country_, sic, year, cr4, n_firms, total_sales) of complete keys from the top
    sales table and the pivot's industry table; equals ``concentration_by_year`` there."""
    long = cell_years(cells, years)
    return top.join(long, list(CELL_YEAR), "inner").select(
        *CELL_YEAR, ratio(F.col("top_sales"), F.col("total_sales")).alias("cr4"),
        "n_firms", "total_sales")


def multi_valued(years: Sequence[int]) -> Column:
    """How many firm keys of a sales pivot have a year with several sales values."""
    return F.count(F.when(~single_valued(years), F.lit(1)))


def top_of(values: DataFrame, k: int = TOP_K) -> DataFrame:
    """(_country_, sic, year, top_sales) of the k largest from (cell, year, value, copies).

    The limit to k rows runs in two levels (``largest``); copies count as rows of their own."""
    w = Window.partitionBy(*CELL_YEAR).orderBy(F.col("value").desc())
    few = largest(values, F.col("value"), k)
    upto = F.sum("copies").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    used = F.greatest(F.lit(0), F.least(F.col("copies"), k - (F.col("_upto") - F.col("copies"))))
    return (few.withColumn("_upto", upto).groupBy(*CELL_YEAR)
               .agg(F.sum(F.col("value") * used).alias("top_sales")))


@dataclass
class SalesPivot:
    """A written firm pivot with ``sales_pivot_aggregates`` and what is derived from it once
    for all windows: its industry table, and the distinct values of the firm keys that have
    several sales values in a year (exact copies are one value)."""

    years: list[int]
    firms: DataFrame
    cells: DataFrame
    multi: DataFrame | None

    @classmethod
    def of(cls, panel: DataFrame, specs: Sequence[LongDiffSpec], max_bytes: int | None = None) -> SalesPivot:
        years = window_years(specs)
        firms, seen = materialize_observed(sales_pivot(panel, years), multi=multi_valued(years))
        cells, _ = checked_broadcast(pivot_cells(firms, years), max_bytes)
        return cls.from_tables(panel, years, firms, cells, bool(seen["multi"]), max_bytes)

    @classmethod
    def from_tables(cls, panel: DataFrame, years: list[int], firms: DataFrame, cells: DataFrame,
                    has_multi: bool, max_bytes: int | None = None) -> SalesPivot:
        """``cells`` as returned by ``checked_broadcast``; the panel is read again only for
        the firm keys with several values, and their values are written."""
        multi = None
        if has_multi:
            keys, _ = checked_broadcast(firms.where(~single_valued(years)).select(*FIRM_KEY), max_bytes)
            rows = firm_key_rows(_positive_sales(panel), years, [SALES]).join(keys, list(FIRM_KEY), "left_semi")
            multi = materialize(rows.groupBy(*FIRM_KEY, YEAR, F.col(SALES).alias("value"))
                                    .agg(F.count(F.lit(1)).alias("copies")))
        return cls(years, firms, cells, multi)

    def top_sales(self) -> DataFrame:
        """(_country_, sic, year, top_sales) of the pivot's years, without the panel."""
        per_year = F.explode(F.array(*[
            F.struct(F.lit(yr).alias(YEAR), F.col(f"lo{side(yr)}").alias("value"), count_at(yr).alias("copies"))
            for yr in self.years]))
        values = (self.firms.where(single_valued(self.years)).select(*CELL, per_year.alias("_y"))
                  .select(*CELL, "_y.*").where(F.col("copies") > 0))
        if self.multi is not None:
            values = values.unionByName(self.multi.select(*CELL_YEAR, "value", "copies"))
        return top_of(values)

    def concentration(self) -> DataFrame:
        return concentration_from(self.top_sales(), self.cells, self.years)

    def turbulences(self, specs: Sequence[LongDiffSpec]) -> dict[LongDiffSpec, DataFrame]:
        """Turbulence of several windows. A firm key with one sales value per year (the
        normal case, and exact copies) is closed-form, the others share one range sort
        (``exact_abs_pair_sums``); the industry sums of both are written once. The industry
        table is broadcast onto the firm rows after a size check, so shares need no shuffle."""
        small = self.cells.select(*[F.col(c).alias(f"_t{c}") for c in CELL],
                                  *[f"T{side(y)}" for y in self.years])
        joined = self.firms.where(single_valued(self.years)).join(
            small, reduce(and_, [F.col(c) == F.col(f"_t{c}") for c in CELL]))
        sums = _closed_form_sums(joined, specs)
        if self.multi is not None:
            totals = cell_years(self.cells, self.years).select(*[F.col(c).alias(f"_t_{c}") for c in CELL_YEAR], "total_sales")
            shares = self.multi.join(totals, reduce(and_, [F.col(c) == F.col(f"_t_{c}") for c in CELL_YEAR])).select(
                *FIRM_KEY, YEAR, ratio(F.col("value"), F.col("total_sales")).alias("share"), "copies")
            exact = exact_abs_pair_sums(shares, window_pairs(specs), "share", "copies")
            sums = sums.unionByName(exact).groupBy(*CELL).agg(
                *[F.sum(c).alias(c) for c in exact.columns if c not in CELL])
        sums = materialize(sums)
        return {spec: _turbulence_of(sums, spec) for spec in specs}


def window_pairs(specs: Sequence[LongDiffSpec]) -> list[tuple[int, int]]:
    """Every (base, horizon) of the windows, once."""
    return list(dict.fromkeys((spec.base, h) for spec in specs for h in spec.horizons))


def _closed_form_sums(simple: DataFrame, specs: Sequence[LongDiffSpec]) -> DataFrame:
    """Per industry, for every (base, horizon) of the windows: survivor pairs and the
    sum of |share_h - share_b| over the single-valued firm keys. One aggregation."""
    def share(yr: int):
        return ratio(F.col(f"lo{side(yr)}"), F.col(f"T{side(yr)}"))

    aggs = []
    for b, h in window_pairs(specs):
        sv = survivor(b, h)
        pairs = count_at(b) * count_at(h)
        aggs.append(F.sum(F.when(sv, pairs)).alias(f"pairs_{b}_{h}"))
        aggs.append(F.sum(F.when(sv, pairs * F.abs(share(h) - share(b)))).alias(f"abs_{b}_{h}"))
    return simple.groupBy(*CELL).agg(*aggs)


def _turbulence_of(sums: DataFrame, spec: LongDiffSpec) -> DataFrame:
    b, h0 = spec.base, spec.horizons[0]
    cols = output_keys(CELL) + [
        F.when(F.col(f"pairs_{b}_{h}") > 0, F.col(f"abs_{b}_{h}")).alias(spec.label("turbulence", h))
        for h in spec.horizons]
    return sums.where(F.col(f"pairs_{b}_{h0}") > 0).select(*cols)


def concentration(panel: DataFrame, spec: LongDiffSpec = TREATMENT,
                  max_bytes: int | None = None) -> DataFrame:
    """fic_code, borrower_sic, per horizon LD_CR4 and LD_n_firms, then every
    LD_turbulence, all from one sales pivot. Turbulence is left-joined: industries without
    survivors at the first horizon keep null turbulence. Both sides are industry-level
    tables."""
    pivot = SalesPivot.of(panel, [spec], max_bytes)
    levels = long_difference(pivot.concentration(), CONCENTRATION_MEASURES, spec)
    return levels.join(pivot.turbulences([spec])[spec], [OUT_COUNTRY, OUT_INDUSTRY], "left")
