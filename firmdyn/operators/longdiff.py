"""Long differences: value at a horizon year minus value at the base year, per industry.

The stitched form (one inner join per horizon, then left joins) becomes a single
grouped pivot of the industry-year table: one existence flag and one value per year,
then subtractions. Rows are the industries present at the base year and at the
first horizon; a later horizon that is missing gives null. A row that exists with a
null value (a one-firm standard deviation) is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmdyn.schema import CELL, OUT_COUNTRY, OUT_INDUSTRY, YEAR, LongDiffSpec
from firmdyn.session import materialize


def not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def output_keys(keys: Sequence[str] = CELL) -> list[Column]:
    """Industry keys renamed to the output convention."""
    return [F.col(k).alias(o) for k, o in zip(keys, (OUT_COUNTRY, OUT_INDUSTRY))]


def year_pivot(by_year: DataFrame, measures: Sequence[tuple[str, str]], years: Sequence[int],
               keys: Sequence[str] = CELL, year: str = YEAR) -> DataFrame:
    """One row per industry: per year an existence flag ``_has_{y}`` and every measure
    ``_{column}_{y}``. ``by_year`` must have one row per (keys, year)."""
    y = F.col(year)
    aggs = []
    for yr in years:
        aggs.append(F.max(F.when(y == yr, F.lit(1))).alias(f"_has_{yr}"))
        for col, _ in measures:
            aggs.append(F.max(F.when(y == yr, F.col(col))).alias(f"_{col}_{yr}"))
    return by_year.where(y.isin(*years) & not_null(keys)).groupBy(*keys).agg(*aggs)


def long_difference(by_year: DataFrame, measures: Sequence[tuple[str, str]],
                    spec: LongDiffSpec, keys: Sequence[str] = CELL,
                    year: str = YEAR) -> DataFrame:
    """``measures`` are (column, label) pairs; output ``LD_{label}_{base}_{h}``.

    ``by_year`` must have one row per (keys, year), as every grouped table has.
    Output columns: the two keys, then per horizon every measure in order.
    """
    return from_year_pivot(year_pivot(by_year, measures, spec.years, keys, year),
                           measures, spec, keys)


def long_differences(by_year: DataFrame, measures: Sequence[tuple[str, str]],
                     specs: Sequence[LongDiffSpec], keys: Sequence[str] = CELL,
                     year: str = YEAR) -> dict[LongDiffSpec, DataFrame]:
    """``long_difference`` for several windows from one written year pivot; each window
    is then a filter and a projection of that small table."""
    years = sorted({y for spec in specs for y in spec.years})
    wide = materialize(year_pivot(by_year, measures, years, keys, year))
    return {spec: from_year_pivot(wide, measures, spec, keys) for spec in specs}


def from_year_pivot(wide: DataFrame, measures: Sequence[tuple[str, str]],
                    spec: LongDiffSpec, keys: Sequence[str] = CELL) -> DataFrame:
    """Anchor on the base year and the first horizon, then subtract."""
    wide = wide.where(F.col(f"_has_{spec.base}").isNotNull()
                      & F.col(f"_has_{spec.horizons[0]}").isNotNull())
    cols = output_keys(keys)
    for h in spec.horizons:
        for col, label in measures:
            diff = F.col(f"_{col}_{h}") - F.col(f"_{col}_{spec.base}")
            cols.append(F.when(F.col(f"_has_{h}").isNotNull(), diff).alias(spec.label(label, h)))
    return wide.select(*cols)
