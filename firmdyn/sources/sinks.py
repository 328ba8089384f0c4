"""Sinks: the firm-level markup panel (parquet) and one CSV per outcome family.

Industry-level outcomes are countries x two-digit codes rows, so a single CSV file
per outcome is safe; the firm panel is written by all tasks in parallel and never
coalesced.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from firmdyn.schema import FIRM_KEY, YEAR, LongDiffSpec, PRESHOCK, TREATMENT

# Output names of the outcome families and the firm panel.
OUTPUT_NAMES = {
    "markup_decomp": "industry_markup_decomp",
    "op_covariance": "industry_op_covariance",
    "dispersion": "industry_dispersion",
    "concentration": "industry_concentration",
}
FIRM_PANEL_NAME = "firm_panel_markup"
# Fixed value: sub-folder of every window other than the treatment window.
OTHER_WINDOW_FOLDER = "block2"


def output_dir(root: str, spec: LongDiffSpec) -> str:
    """Folder of one window: the root for the treatment window, ``block2/`` otherwise."""
    return root if spec == TREATMENT else os.path.join(root, OTHER_WINDOW_FOLDER)


def outcome_path(root: str, family: str, spec: LongDiffSpec) -> str:
    """The outcome's CSV folder. Windows other than the two predefined ones carry their
    horizons in the name, so windows with one base year do not overwrite each other."""
    name = OUTPUT_NAMES[family]
    if spec != TREATMENT:
        name = f"{name}_{spec.base}base"
        if spec != PRESHOCK:
            name = "_".join([name, *map(str, spec.horizons)])
    return os.path.join(output_dir(root, spec), f"{name}.csv")


def write_outcome_csv(df: DataFrame, path: str) -> None:
    """A folder named like the CSV file, holding one CSV part with a header; nulls are
    empty fields. An empty result still gets its header."""
    (df.coalesce(1).write.mode("overwrite")
       .option("header", True).option("nullValue", "").option("emptyValue", "")
       .csv(path))


def write_firm_panel(df: DataFrame, path: str, buckets: int | None = None, table: str | None = None) -> None:
    """The firm panel as parquet. With ``buckets`` it is dealt by the firm key and, within a file,
    sorted by it: a firm's years lie together in one file, which folds them before any later
    shuffle. With a ``table`` name too, the same files are a bucketed table of the session's
    catalog, and grouping or joining it by the firm key needs no shuffle at all."""
    if buckets is None:
        if table is not None:
            raise ValueError("a table of the firm panel needs buckets")
        df.write.mode("overwrite").parquet(path)
        return
    dealt = df.repartition(buckets, *FIRM_KEY)
    if table is None:
        dealt.sortWithinPartitions(*FIRM_KEY, YEAR).write.mode("overwrite").parquet(path)
    else:
        (dealt.write.mode("overwrite").bucketBy(buckets, *FIRM_KEY).sortBy(*FIRM_KEY)
              .option("path", path).saveAsTable(table))
