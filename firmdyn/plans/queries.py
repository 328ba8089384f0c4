"""Registered queries: each takes (spark, folder of driver tables) and returns a
DataFrame over the derived firm-year panel, with doubles rounded to six decimals so
that it can be compared value by value with the naive SQL of ``naive_sql``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from firmdyn.functions import positive, round6
from firmdyn.operators import (
    concentration, concentration_by_year, country_coverage, dispersion, dispersion_by_year,
    firm_markup, industry_share, log_ratios, markup_decomposition, markup_sample,
    n_firms_by_year, op_covariance, opcov_by_year, outcome_shapes, outcome_summary,
    preview, sign_check, survivor_pairs, turbulence, within_check,
)
from firmdyn.plans.outcomes import FAMILIES, prepare, run_windows
from firmdyn.schema import (CELL_YEAR, COUNTRY, FIRM, INDUSTRY, PRESHOCK, SALES, TREATMENT, YEAR,
                            LongDiffSpec)
from firmdyn.session import materialize, run_folder
from firmdyn.sources import derived_panel, load_panel, panel_count, prepare_panel
from firmdyn.sources.sinks import FIRM_PANEL_NAME, outcome_path, write_firm_panel, write_outcome_csv

Query = Callable[[SparkSession, str], DataFrame]


def panel_of(spark: SparkSession, sf_dir: str, written: bool) -> DataFrame:
    """The derived firm-year panel, a join of four tables; ``written`` once as parquet for
    the statistics that read it several times."""
    panel = prepare_panel(derived_panel(spark, sf_dir))
    return materialize(panel) if written else panel


def present(df: DataFrame) -> DataFrame:
    """Round every double column to six decimals (comparison form)."""
    return df.select(*[
        round6(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema.fields])


def _outcomes(panel: DataFrame, spec: LongDiffSpec = TREATMENT) -> dict[str, DataFrame]:
    """The four outcome tables as the full run makes them."""
    return prepare(panel, [spec]).outcomes[spec]


def _panel_round_trip(panel: DataFrame) -> DataFrame:
    """The panel as the firm-panel sink writes it in several files, loaded again."""
    path = f"{run_folder(panel.sparkSession)}/{uuid.uuid4().hex}"
    write_firm_panel(panel.drop(COUNTRY).repartition(4), path)
    return load_panel(panel.sparkSession, path).select(*panel.columns)


def _named_file(panel: DataFrame, folder: str, name: str) -> None:
    """The panel as one parquet file of that name in a folder."""
    spark, part = panel.sparkSession, f"{run_folder(panel.sparkSession)}/{uuid.uuid4().hex}"
    panel.coalesce(1).write.parquet(part)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(part).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(folder))
    (written,) = [f.getPath() for f in fs.listStatus(hadoop(part)) if f.getPath().getName().endswith(".parquet")]
    fs.rename(written, hadoop(folder, name))


def _smoke_panel(panel: DataFrame) -> DataFrame:
    """The first file of a folder with a file a year, whose names hold characters of patterns."""
    folder = f"{run_folder(panel.sparkSession)}/{uuid.uuid4().hex} [all]"
    for yr in (2012, 2013, 2011):
        _named_file(panel.drop(COUNTRY).where(F.col(YEAR) == yr), folder, f"part[{yr}] a+b%.parquet")
    escaped = folder.replace("[", "\\[").replace("]", "\\]")
    return load_panel(panel.sparkSession, escaped, first_file_only=True).select(*panel.columns)


def _saved_firm_panel(panel: DataFrame) -> DataFrame:
    """The firm panel as a saving run writes it, dealt by firm, read again."""
    out = f"{run_folder(panel.sparkSession)}/{uuid.uuid4().hex}"
    run_windows(panel, [TREATMENT], save=True, out_dir=out, firm_buckets=4)
    return panel.sparkSession.read.parquet(f"{out}/{FIRM_PANEL_NAME}")


def _csv_round_trip(panel: DataFrame) -> DataFrame:
    """The concentration outcome of 2010 as its CSV sink writes it, read again."""
    df = _outcomes(panel, PRESHOCK)["concentration"]
    path = outcome_path(f"{run_folder(df.sparkSession)}/{uuid.uuid4().hex}", "concentration", PRESHOCK)
    write_outcome_csv(df, path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def _summary(panel: DataFrame) -> DataFrame:
    parts = [outcome_summary(df).select(F.lit(name).alias("outcome"), "*")
             for name, df in _outcomes(panel).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


ROW_KEYS = (FIRM, COUNTRY, INDUSTRY, YEAR)

# name -> statistic of a prepared panel (the operator under test)
PANEL_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "firm_panel": lambda p: p,
    "guarded_log_ratios": lambda p: log_ratios(p).select(
        *ROW_KEYS, "log_mrpl", "log_mrpk", "log_markup"),
    "industry_share": lambda p: industry_share(p.where(positive(SALES))).select(
        *ROW_KEYS, SALES, "share"),
    "firm_markup": firm_markup,
    "survivor_pairs": lambda p: survivor_pairs(p.where(positive(SALES)), TREATMENT),
    "opcov_by_year": opcov_by_year,
    "dispersion_by_year": dispersion_by_year,
    "cr4_by_year": lambda p: concentration_by_year(p).select(*CELL_YEAR, "cr4"),
    "n_firms_by_year": lambda p: n_firms_by_year(p).select(*CELL_YEAR, "n_firms"),
    "concentration_by_year": concentration_by_year,
    "outcome_summary": _summary,
    "opcov_sign_check": lambda p: sign_check(op_covariance(p, TREATMENT)),
    "within_check": lambda p: within_check(markup_decomposition(markup_sample(p), TREATMENT)),
    "country_coverage": lambda p: country_coverage(_outcomes(p)),
    "outcome_shapes": lambda p: outcome_shapes(_outcomes(p)),
    "outcome_shapes_2010": lambda p: outcome_shapes(_outcomes(p, PRESHOCK)),
    "outcome_preview_2010": lambda p: preview(_outcomes(p, PRESHOCK)["op_covariance"]),
    "panel_round_trip": _panel_round_trip,
    "csv_round_trip": _csv_round_trip,
    "smoke_panel": _smoke_panel,
    "saved_firm_panel": _saved_firm_panel,
    "panel_count": panel_count,
}
for _spec in (TREATMENT, PRESHOCK):
    PANEL_QUERIES.update({
        f"markup_decomp_{_spec.base}": lambda p, s=_spec: markup_decomposition(markup_sample(p), s),
        f"op_covariance_{_spec.base}": lambda p, s=_spec: op_covariance(p, s),
        f"dispersion_{_spec.base}": lambda p, s=_spec: dispersion(p, s),
        f"turbulence_{_spec.base}": lambda p, s=_spec: turbulence(p, s),
        f"concentration_{_spec.base}": lambda p, s=_spec: concentration(p, s),
    })
    # the same outcomes as the full run makes them, both windows at once
    PANEL_QUERIES.update({
        f"run_{family}_{_spec.base}": lambda p, s=_spec, f=family: prepare(
            p, [TREATMENT, PRESHOCK]).outcomes[s][f]
        for family in FAMILIES})

#: Queries that read the panel once; the others get it written.
ONE_SCAN = {"firm_panel", "guarded_log_ratios", "survivor_pairs", "opcov_by_year", "dispersion_by_year",
            "n_firms_by_year", "panel_count", "panel_round_trip", "opcov_sign_check", "within_check",
            *(f"{f}_{s.base}" for f in ("markup_decomp", "op_covariance", "dispersion") for s in (TREATMENT, PRESHOCK))}


def _on_driver_tables(name: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(fn(panel_of(spark, sf_dir, name not in ONE_SCAN)))


QUERIES: dict[str, Query] = {name: _on_driver_tables(name, fn) for name, fn in PANEL_QUERIES.items()}
