"""firmdyn: industry dynamics of firm-year panels on Spark.

Markup decomposition, Olley-Pakes covariance, dispersion, concentration and
turbulence as long differences between a base year and horizon years. Every
operator is a DataFrame -> DataFrame function made of built-in Spark SQL
expressions; nothing is collected to the driver.
"""

from firmdyn.schema import PRESHOCK, TREATMENT, LongDiffSpec

__all__ = ["LongDiffSpec", "PRESHOCK", "TREATMENT"]
