"""Within-cell sales shares (a weight divided by its cell total).

The window form ``sales / sum(sales) over (partition by cell)`` shuffles and sorts
every firm row by its cell, and one big cell lands in one task. Here the totals are
a partial/final hash aggregate (one row per cell), which is broadcast back to the
firm rows after its size is checked, so the firm rows never move.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmdyn.functions import ratio
from firmdyn.schema import CELL_YEAR, SALES
from firmdyn.session import checked_broadcast


def cell_totals(df: DataFrame, weight: str = SALES, keys=CELL_YEAR,
                name: str = "cell_total") -> DataFrame:
    """One row per cell with the sum of ``weight``; null keys form their own cell."""
    return df.groupBy(*keys).agg(F.sum(weight).alias(name))


def attach_cell_values(df: DataFrame, cell_table: DataFrame, keys=CELL_YEAR,
                       max_bytes: int | None = None) -> DataFrame:
    """Join a cell-level table onto firm rows with null-safe keys.

    The cell table is materialised and broadcast when it takes at most ``max_bytes``
    of memory; a larger one is shuffle-joined.
    """
    renamed = cell_table.select(
        *[F.col(k).alias(f"_cell_{k}") for k in keys],
        *[c for c in cell_table.columns if c not in keys])
    small, _ = checked_broadcast(renamed, max_bytes)
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_cell_{k}")) for k in keys])
    return df.join(small, cond, "inner").drop(*[f"_cell_{k}" for k in keys])


def industry_share(df: DataFrame, weight: str = SALES, keys=CELL_YEAR,
                   name: str = "share", max_bytes: int | None = None) -> DataFrame:
    """Add ``name = weight / sum(weight)`` over the rows of the same cell."""
    totals = cell_totals(df, weight, keys, "_cell_total")
    out = attach_cell_values(df, totals, keys, max_bytes)
    return out.withColumn(name, ratio(weight, "_cell_total")).drop("_cell_total")
