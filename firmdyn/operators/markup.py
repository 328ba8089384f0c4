"""Firm markups and the within / between / cross decomposition of markup change.

markup = sales / cogs over firms with positive sales and cogs, trimmed to
[0.5, 10]; the share is taken over the trimmed sample. For survivors of base b and
horizon h (per industry, s = share, mu = markup, bar = two-period mean, d = change):

    Within = sum s_bar * d_mu,  Between = sum mu_bar * d_s,  Cross = sum d_mu * d_s

With S, M, P the per-side sums of sales, markup and sales * markup of a firm key,
n the row counts and T the industry totals, the pair sums are exactly

    Within  = (Z1 / T_h - Z2 / T_b) / 2      Z1 = n_b P_h - M_b S_h
    Between = (Y1 / T_h - Y2 / T_b) / 2      Z2 = n_h P_b - M_h S_b
    Cross   =  Z1 / T_h + Z2 / T_b           Y1 = M_b S_h + n_b P_h,  Y2 = n_h P_b + M_h S_b

summed over survivor keys. So the decomposition is one aggregate per firm key and
one per industry: no join of totals onto firm rows and no firm pairs at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmdyn.functions import positive, ratio
from firmdyn.operators.longdiff import output_keys
from firmdyn.operators.pairs import (count_at, firm_key_rows, per_firm, side, survivor,
                                     window_years)
from firmdyn.operators.share import attach_cell_values, industry_share
from firmdyn.schema import (CELL, CELL_YEAR, COGS, MARKUP_MAX, MARKUP_MIN, SALES,
                            LongDiffSpec, TREATMENT)
from firmdyn.session import materialize_observed

DECOMP_TERMS = ("Within", "Between", "Cross")


def in_markup_sample(markup: Column) -> Column:
    """Positive sales and cogs, markup in [0.5, 10] (both ends kept)."""
    return positive(COGS) & positive(SALES) & markup.between(MARKUP_MIN, MARKUP_MAX)


def markup_sample(panel: DataFrame) -> DataFrame:
    """Rows with positive sales and cogs, ``markup`` added, trimmed to [0.5, 10]."""
    return (panel.where(positive(COGS) & positive(SALES))
                 .withColumn("markup", ratio(SALES, COGS))
                 .where(F.col("markup").between(MARKUP_MIN, MARKUP_MAX)))


def markup_pivot_aggregates(in_sample: Column) -> dict:
    """Per-year firm aggregates of the decomposition over the rows where ``in_sample``
    holds: row count ``mn``, sums of sales ``ms``, markup ``mu``, sales * markup ``sm``.
    Rows need ``sales`` and ``markup``."""
    s, m = F.col(SALES), F.col("markup")

    def summed(expr):
        return lambda on: F.sum(F.when(on & in_sample, expr))

    return {"mn": lambda on: F.count(F.when(on & in_sample, F.lit(1))),
            "ms": summed(s), "mu": summed(m), "sm": summed(s * m)}


def markup_pivot(sample: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row per firm key of the markup sample with ``markup_pivot_aggregates``."""
    return per_firm(firm_key_rows(sample, years, [SALES, "markup"]), years,
                    markup_pivot_aggregates(F.lit(True)))


def firm_markup(panel: DataFrame, max_bytes: int | None = None,
                totals: DataFrame | None = None) -> DataFrame:
    """The firm panel: every input column, ``markup`` and ``share`` (sales over the
    trimmed sample of the industry-year). ``totals`` (the cell's keys, ``markup_sales``: a
    written table with ``markup_total``) saves the scan that sums them."""
    sample = markup_sample(panel)
    if totals is None:
        return industry_share(sample, SALES, CELL_YEAR, "share", max_bytes)
    out = attach_cell_values(sample, totals.where(F.col("markup_sales").isNotNull()), CELL_YEAR, max_bytes)
    return out.withColumn("share", ratio(SALES, "markup_sales")).drop("markup_sales")


def markup_total() -> Column:
    """Sales of the trimmed markup sample, as an aggregate of panel rows."""
    return F.sum(F.when(in_markup_sample(ratio(SALES, COGS)), F.col(SALES))).alias("markup_sales")


def decomposition_sums(firms: DataFrame, specs: Sequence[LongDiffSpec]) -> DataFrame:
    """One row per industry with ``decomposition_aggregates``."""
    return firms.groupBy(*CELL).agg(*decomposition_aggregates(specs))


def decomposition_aggregates(specs: Sequence[LongDiffSpec]) -> list[Column]:
    """Industry aggregates of a firm pivot with ``markup_pivot_aggregates``: totals MT_y, and
    per window and horizon the pair count and Z1, Z2, Y1, Y2 (``{term}_{base}_{h}``)."""
    years = window_years(specs)

    def at(name: str, yr: int):
        return F.col(f"{name}{side(yr)}")

    aggs = [F.sum(at("ms", yr)).alias(f"MT{side(yr)}") for yr in years]
    pairs = dict.fromkeys((spec.base, h) for spec in specs for h in spec.horizons)
    for b, h in pairs:
        nb, nh = count_at(b, "mn"), count_at(h, "mn")
        terms = {
            "mpairs": nb * nh,
            "z1": nb * at("sm", h) - at("mu", b) * at("ms", h),
            "z2": nh * at("sm", b) - at("mu", h) * at("ms", b),
            "y1": at("mu", b) * at("ms", h) + nb * at("sm", h),
            "y2": nh * at("sm", b) + at("mu", h) * at("ms", b),
        }
        aggs += [F.sum(F.when(survivor(b, h, "mn"), e)).alias(f"{k}_{b}_{h}")
                 for k, e in terms.items()]
    return aggs


def survivor_flags(specs: Sequence[LongDiffSpec]) -> dict[str, Column]:
    """Per (base, horizon): whether any industry has a survivor pair in the markup sample."""
    pairs = dict.fromkeys((s.base, h) for s in specs for h in s.horizons)
    return {f"h{b}_{h}": F.max(F.col(f"mpairs_{b}_{h}") > 0) for b, h in pairs}


def decompositions_from(sums: DataFrame, flags: dict,
                        specs: Sequence[LongDiffSpec]) -> dict[LongDiffSpec, DataFrame]:
    """Every window's decomposition from a written industry table and its observed flags."""
    return {spec: _from_sums(sums, spec, flags) for spec in specs}


def markup_decompositions(sample: DataFrame,
                          specs: Sequence[LongDiffSpec]) -> dict[LongDiffSpec, DataFrame]:
    """``markup_decomposition`` for several windows from one firm pivot and one written
    industry table."""
    firms = markup_pivot(sample, window_years(specs))
    sums, flags = materialize_observed(decomposition_sums(firms, specs), **survivor_flags(specs))
    return decompositions_from(sums, flags, specs)


def markup_decomposition(sample: DataFrame, spec: LongDiffSpec = TREATMENT) -> DataFrame:
    """fic_code, borrower_sic, per horizon LD_Within, LD_Between, LD_Cross.

    ``sample`` is ``markup_sample(panel)`` or ``firm_markup(panel)``. Moving anchor:
    a horizon without any survivor anywhere is skipped, the first horizon with
    survivors selects the rows, and skipped horizons stay as null columns (so the
    schema is fixed; with no survivor at all the table is empty).
    """
    return markup_decompositions(sample, [spec])[spec]


def _from_sums(sums: DataFrame, spec: LongDiffSpec, flags: dict) -> DataFrame:
    b = spec.base
    anchor = next((h for h in spec.horizons if flags[f"h{b}_{h}"]), None)
    t_b = F.col(f"MT{side(b)}")
    cols = output_keys(CELL)
    for h in spec.horizons:
        t_h = F.col(f"MT{side(h)}")
        z1, z2 = ratio(F.col(f"z1_{b}_{h}"), t_h), ratio(F.col(f"z2_{b}_{h}"), t_b)
        y1, y2 = ratio(F.col(f"y1_{b}_{h}"), t_h), ratio(F.col(f"y2_{b}_{h}"), t_b)
        values = {"Within": (z1 - z2) / 2, "Between": (y1 - y2) / 2, "Cross": z1 + z2}
        has = F.col(f"mpairs_{b}_{h}") > 0
        cols += [F.when(has, values[t]).alias(spec.label(t, h)) for t in DECOMP_TERMS]
    rows = sums.where(F.col(f"mpairs_{b}_{anchor}") > 0) if anchor else sums.where(F.lit(False))
    return rows.select(*cols)
