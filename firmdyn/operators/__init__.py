"""Industry statistics over a firm-year panel. Every operator is DataFrame -> DataFrame."""

from firmdyn.operators.concentration import (
    concentration,
    concentration_by_year,
    cr4_by_year,
    n_firms_by_year,
    top_sales_by_year,
    turbulence,
)
from firmdyn.operators.covariance import op_covariance, opcov_by_year
from firmdyn.operators.diagnostics import (
    country_coverage,
    outcome_shapes,
    outcome_summary,
    preview,
    sign_check,
    within_check,
)
from firmdyn.operators.dispersion import dispersion, dispersion_by_year, log_ratios
from firmdyn.operators.longdiff import long_difference
from firmdyn.operators.markup import (
    decomposition_sums,
    firm_markup,
    markup_decomposition,
    markup_sample,
)
from firmdyn.operators.pairs import exact_abs_pair_sums, survivor_pairs
from firmdyn.operators.share import attach_cell_values, cell_totals, industry_share

__all__ = [
    "attach_cell_values", "cell_totals", "concentration", "concentration_by_year",
    "country_coverage", "cr4_by_year", "decomposition_sums", "dispersion",
    "dispersion_by_year", "exact_abs_pair_sums", "firm_markup", "industry_share",
    "log_ratios", "long_difference", "markup_decomposition", "markup_sample",
    "n_firms_by_year", "op_covariance", "opcov_by_year", "outcome_shapes", "outcome_summary",
    "preview",
    "sign_check", "survivor_pairs", "top_sales_by_year", "turbulence", "within_check",
]
