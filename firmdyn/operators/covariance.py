"""Olley-Pakes covariance of market share and labour productivity.

Per industry-year: sum_i (s_i - mean s)(phi_i - mean phi) with s_i = sales_i / total
and phi_i = ln(sales_i / employees_i), over firms with positive sales and employees.
Because the shares sum to one, this equals n * covar_pop(sales, phi) / sum(sales):
one partial/final hash aggregate instead of three window passes, and a big
industry is combined map-side instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmdyn.functions import positive, ratio
from firmdyn.operators.longdiff import long_difference
from firmdyn.schema import CELL_YEAR, EMPLOYEES, SALES, LongDiffSpec, TREATMENT


def opcov_by_year(panel: DataFrame) -> DataFrame:
    """(_country_, sic, year, opcov) for every industry-year with a usable firm."""
    sample = panel.where(positive(EMPLOYEES) & positive(SALES))
    phi = F.ln(ratio(SALES, EMPLOYEES))
    return sample.groupBy(*CELL_YEAR).agg(
        ratio(F.count(F.lit(1)) * F.covar_pop(F.col(SALES), phi), F.sum(SALES)).alias("opcov"))


def op_covariance(panel: DataFrame, spec: LongDiffSpec = TREATMENT,
                  by_year: DataFrame | None = None) -> DataFrame:
    """fic_code, borrower_sic, LD_OPcov_{base}_{h} per horizon."""
    table = opcov_by_year(panel) if by_year is None else by_year
    return long_difference(table, [("opcov", "OPcov")], spec)
