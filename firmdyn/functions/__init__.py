"""Column expressions shared by the operators (all built-in Spark SQL functions)."""

from firmdyn.functions.expressions import (
    country_of,
    guarded_log_ratio,
    positive,
    ratio,
    round6,
    sic2,
)

__all__ = ["country_of", "guarded_log_ratio", "positive", "ratio", "round6", "sic2"]
