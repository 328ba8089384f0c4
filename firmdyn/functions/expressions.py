"""Scalar expressions.

All of these compile to JVM expressions inside whole-stage codegen; none is a UDF.
Division goes through ``try_divide`` so that ANSI mode never raises on a zero
divisor, whatever order Catalyst evaluates conjuncts in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def country_of(firm: str | Column) -> Column:
    """First two characters of the firm id (null stays null, short ids stay short)."""
    return F.substring(_col(firm), 1, 2)


def sic2(industry: str | Column) -> Column:
    """Cast any industry code to string and keep two characters: 3711 and 3711.0 give 37."""
    return F.substring(_col(industry).cast("string"), 1, 2)


def positive(c: str | Column) -> Column:
    """Not null and strictly positive."""
    c = _col(c)
    return c.isNotNull() & (c > 0)


def ratio(num: str | Column, den: str | Column) -> Column:
    """True division; null instead of an error for a zero divisor."""
    return F.try_divide(_col(num), _col(den))


def guarded_log_ratio(num: str | Column, den: str | Column) -> Column:
    """ln(num / den) when den is positive, else null."""
    return F.when(positive(den), F.ln(ratio(num, den)))


def round6(c: str | Column) -> Column:
    """Round to six decimals and fold -0.0 into 0.0 (used only for comparisons)."""
    return F.round(_col(c), 6) + F.lit(0.0)
