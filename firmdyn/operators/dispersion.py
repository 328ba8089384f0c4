"""Within-industry dispersion of revenue products and markups.

Per industry-year, over firms with positive sales: the sample standard deviation
(n - 1) of ln(sales/employees), ln(sales/assets) and ln(sales/cogs), each over the
firms whose divisor is positive. Null when fewer than two firms qualify. No markup
trim here. One hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmdyn.functions import guarded_log_ratio, positive
from firmdyn.operators.longdiff import long_difference
from firmdyn.schema import ASSETS, CELL_YEAR, COGS, EMPLOYEES, SALES, LongDiffSpec, TREATMENT

# Fixed values: (by-year column, output label) of the three dispersion measures.
DISPERSION_MEASURES = (
    ("sigma_mrpl", "sigma_MRPL"),
    ("sigma_mrpk", "sigma_MRPK"),
    ("sigma_markup", "sigma_markup"),
)


def log_ratios(panel: DataFrame) -> DataFrame:
    """Positive-sales rows with the three guarded log ratios."""
    return panel.where(positive(SALES)).select(
        *panel.columns,
        guarded_log_ratio(SALES, EMPLOYEES).alias("log_mrpl"),
        guarded_log_ratio(SALES, ASSETS).alias("log_mrpk"),
        guarded_log_ratio(SALES, COGS).alias("log_markup"),
    )


def dispersion_by_year(panel: DataFrame) -> DataFrame:
    """(_country_, sic, year, sigma_mrpl, sigma_mrpk, sigma_markup)."""
    return log_ratios(panel).groupBy(*CELL_YEAR).agg(
        F.stddev_samp("log_mrpl").alias("sigma_mrpl"),
        F.stddev_samp("log_mrpk").alias("sigma_mrpk"),
        F.stddev_samp("log_markup").alias("sigma_markup"),
    )


def dispersion(panel: DataFrame, spec: LongDiffSpec = TREATMENT,
               by_year: DataFrame | None = None) -> DataFrame:
    """fic_code, borrower_sic, per horizon LD_sigma_MRPL, LD_sigma_MRPK, LD_sigma_markup."""
    table = dispersion_by_year(panel) if by_year is None else by_year
    return long_difference(table, DISPERSION_MEASURES, spec)


def industry_year_stats(panel: DataFrame, *more: Column) -> DataFrame:
    """OP covariance and the three dispersions in one aggregate over positive-sales rows:
    (_country_, sic, year, n_opcov, opcov, sigma_mrpl, sigma_mrpk, sigma_markup).

    The covariance sample (positive employees too) is a sub-sample, selected inside
    the aggregate: ln(sales/employees) is non-null exactly on its rows. Industry-years
    with ``n_opcov = 0`` have no OP covariance row. ``more`` are further aggregates of the
    same rows."""
    rows = log_ratios(panel)
    on = F.col("log_mrpl").isNotNull()
    sales = F.when(on, F.col(SALES))
    n = F.count(F.when(on, F.lit(1)))
    return rows.groupBy(*CELL_YEAR).agg(
        n.alias("n_opcov"),
        F.try_divide(n * F.covar_pop(sales, F.col("log_mrpl")), F.sum(sales)).alias("opcov"),
        F.stddev_samp("log_mrpl").alias("sigma_mrpl"),
        F.stddev_samp("log_mrpk").alias("sigma_mrpk"),
        F.stddev_samp("log_markup").alias("sigma_markup"),
        *more,
    )
