"""Column names, cell keys and long-difference windows.

Every operator takes its columns from here by default, so one panel layout
(firm x year rows with country and two-digit industry cells) serves all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

# Input column names of the firm-year panel.
FIRM = "bvd_id"
YEAR = "year"
INDUSTRY = "sic"
COUNTRY = "_country_"
SALES = "sales"
COGS = "costs_of_goods_sold"
EMPLOYEES = "number_of_employees"
ASSETS = "total_assets"

# Key names of every industry-level output.
OUT_COUNTRY = "fic_code"
OUT_INDUSTRY = "borrower_sic"

CELL = (COUNTRY, INDUSTRY)            # an industry: country x SIC-2
CELL_YEAR = (COUNTRY, INDUSTRY, YEAR)  # an industry-year
FIRM_KEY = (FIRM, COUNTRY, INDUSTRY)   # a firm inside its industry (survivor key)

# Columns the four outcome families read; everything else is pruned.
MEASURES = (SALES, COGS, EMPLOYEES, ASSETS)
PANEL_COLUMNS = (FIRM, COUNTRY, INDUSTRY, YEAR) + MEASURES

# Markup outlier trim, both ends inclusive.
MARKUP_MIN = 0.5
MARKUP_MAX = 10.0

# Fixed value: firms summed in the concentration ratio.
TOP_K = 4


@dataclass(frozen=True)
class LongDiffSpec:
    """A base year and the horizon years it is differenced against.

    The first horizon anchors the rows of every long-difference table.
    """

    base: int
    horizons: tuple[int, ...]

    def __post_init__(self) -> None:
        if not self.horizons:
            raise ValueError("a long difference needs at least one horizon")
        if self.base in self.horizons:
            raise ValueError("the base year cannot also be a horizon")
        if len(set(self.horizons)) != len(self.horizons):
            raise ValueError("horizons must be distinct")

    @property
    def years(self) -> tuple[int, ...]:
        return (self.base, *self.horizons)

    def label(self, measure: str, horizon: int) -> str:
        return f"LD_{measure}_{self.base}_{horizon}"


# The two windows of the study.
TREATMENT = LongDiffSpec(2012, (2013, 2014, 2015))
PRESHOCK = LongDiffSpec(2010, (2013, 2014))
