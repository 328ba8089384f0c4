"""The full outcome run: four families for one or more windows, optionally written out.

Shared work is done once per panel, whatever the number of windows, in two scans of the
window years:

* one industry-year aggregate for OP covariance and the three dispersions;
* one firm pivot: the run's only shuffle of firm rows. One aggregation of it gives the sums
  of the markup decomposition, the firm counts and the sales totals of every window; the top
  four sales and turbulence of every window follow from it too. Only firm keys with several
  sales values in a year are read from the panel once more, and their values written.

Each family's industry-year table is pivoted once for all windows. Tables that are read more
than once are written as parquet, independent chains run as concurrent Spark jobs, and
every outcome table is a filter and projection of a small written table (the concentration
one also a join of two of them). Only the panel columns the statistics read are kept, so a
parquet panel is scanned with a pruned schema and pushed-down filters; the firm panel sink
alone reads every input column.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmdyn.functions import positive, ratio
from firmdyn.operators.concentration import (CONCENTRATION_MEASURES, SalesPivot, multi_valued,
                                             pivot_cell_aggregates, sales_pivot_aggregates)
from firmdyn.operators.dispersion import DISPERSION_MEASURES, industry_year_stats
from firmdyn.operators.longdiff import long_differences, not_null
from firmdyn.operators.markup import (decomposition_aggregates, decompositions_from, firm_markup,
                                      in_markup_sample, markup_pivot_aggregates, markup_total,
                                      survivor_flags)
from firmdyn.operators.pairs import firm_key_rows, per_firm, window_years
from firmdyn.schema import (CELL, CELL_YEAR, COGS, OUT_COUNTRY, OUT_INDUSTRY, PANEL_COLUMNS, PRESHOCK,
                            SALES, TREATMENT, YEAR, LongDiffSpec)
from firmdyn.session import RunTables, checked_broadcast, materialize, materialize_observed
from firmdyn.sources.sinks import (FIRM_PANEL_NAME, outcome_path, write_firm_panel,
                                   write_outcome_csv)

FAMILIES = ("markup_decomp", "op_covariance", "dispersion", "concentration")


def firm_pivot(panel: DataFrame, years: Sequence[int]) -> DataFrame:
    """The one firm-level shuffle of a run: per firm key and window year, the sales
    aggregates of positive-sales rows (turbulence, firm counts, sales totals) and the
    markup aggregates of the trimmed markup sample (decomposition)."""
    rows = (firm_key_rows(panel.where(positive(SALES)), years, [SALES, COGS])
            .withColumn("markup", ratio(SALES, COGS)))
    aggregates = {**sales_pivot_aggregates(),
                  **markup_pivot_aggregates(in_markup_sample(F.col("markup")))}
    return per_firm(rows, years, aggregates)


@dataclass
class Shared:
    """Per-panel work shared by all windows, and the outcome tables built from it. Every table
    in ``by_year`` covers the window years and the industries with complete keys."""

    panel: DataFrame
    by_year: dict[str, DataFrame]
    outcomes: dict[LongDiffSpec, dict[str, DataFrame]]
    markup_totals: DataFrame | None
    tables: RunTables

    def close(self) -> None:
        """Deletes the written tables; the outcomes can not be read any more."""
        self.tables.close()

    def __enter__(self) -> Shared:
        return self

    def __exit__(self, *_) -> None:
        self.close()


class Jobs:
    """Chains of Spark jobs, in threads of a small pool or one after another. The threads
    carry the caller's job properties; when one chain fails the others' jobs are cancelled."""

    def __init__(self, spark: SparkSession, concurrent: bool):
        self.spark, self.tag = spark, f"firmdyn-{uuid.uuid4().hex}"
        self.pool = ThreadPoolExecutor(4, thread_name_prefix="firmdyn") if concurrent else None

    def submit(self, chain: Callable) -> Future:
        if self.pool is None:
            done: Future = Future()
            done.set_result(chain())
            return done

        def tagged():
            self.spark.addTag(self.tag)
            try:
                return chain()
            finally:
                self.spark.removeTag(self.tag)

        return self.pool.submit(copy_context().run, inheritable_thread_target(self.spark)(tagged))

    def __enter__(self) -> Jobs:
        return self

    def __exit__(self, failed, *_) -> None:
        if self.pool is not None:
            if failed is not None:
                self.spark.interruptTag(self.tag)
            self.pool.shutdown(wait=True, cancel_futures=failed is not None)


def prepare(panel: DataFrame, specs: Sequence[LongDiffSpec], *,
            materialize_panel: bool = False, max_bytes: int | None = None,
            concurrent: bool = True, markup_totals: bool = False) -> Shared:
    """Compute every outcome of every window (see the module's text). ``materialize_panel``
    writes the pruned panel first; use it when the panel is an expensive plan itself (a
    join). ``markup_totals`` lets the statistics pass also sum the trimmed markup sample of
    every industry-year, for the firm panel sink; it then reads all years.

    The tables of firms are deleted once the last table made of them is written, all tables if
    an error occurs, and those that the outcomes read when the result is closed (or used in a
    ``with`` block) or the application ends."""
    with RunTables(panel.sparkSession) as tables:
        shared = _prepare(panel, specs, materialize_panel, max_bytes, concurrent, markup_totals, tables)
        tables.keep()
    return shared


def _prepare(panel: DataFrame, specs: Sequence[LongDiffSpec], materialize_panel: bool, max_bytes: int | None,
             concurrent: bool, markup_totals: bool, tables: RunTables) -> Shared:
    pruned = panel.select(*PANEL_COLUMNS)
    if materialize_panel:
        pruned = materialize(pruned)
    years = window_years(specs)
    read_years = F.col(YEAR).isin(*years)

    def statistics():
        if markup_totals:  # every year, and incomplete keys too
            written = materialize(industry_year_stats(pruned, markup_total()))
            totals = written.select(*CELL_YEAR, "markup_sales")
            table = written.where(read_years & not_null(CELL_YEAR))
        else:
            totals = None
            table = materialize(industry_year_stats(pruned.where(read_years)).where(not_null(CELL_YEAR)))
        opcov = table.where(F.col("n_opcov") > 0).select(*CELL_YEAR, "opcov")
        disp = table.select(*CELL_YEAR, *[c for c, _ in DISPERSION_MEASURES])
        return ({"opcov": opcov, "dispersion": disp}, long_differences(opcov, [("opcov", "OPcov")], specs),
                long_differences(disp, DISPERSION_MEASURES, specs), totals)

    with Jobs(panel.sparkSession, concurrent) as jobs:
        firm_job = jobs.submit(lambda: materialize_observed(firm_pivot(pruned, years), multi=multi_valued(years)))
        stats = jobs.submit(statistics)
        # hundreds of expressions, made while the firm pivot is written
        sums = [*pivot_cell_aggregates(years), *decomposition_aggregates(specs)]
        survivors = survivor_flags(specs)
        firms, seen = firm_job.result()
        flags: dict = {}
        cells, _ = checked_broadcast(firms.groupBy(*CELL).agg(*sums), max_bytes, flags, **survivors)
        pivot = SalesPivot.from_tables(pruned, years, firms, cells, bool(seen["multi"]), max_bytes)

        def levels():
            conc = materialize(pivot.concentration())
            return conc, long_differences(conc, CONCENTRATION_MEASURES, specs)

        level_job = jobs.submit(levels)
        turb = pivot.turbulences(specs)
        decomp = decompositions_from(cells, flags, specs)
        conc, conc_ld = level_job.result()
        by_year, opcov_ld, disp_ld, totals = stats.result()
    # what is left is made of industry tables alone
    tables.drop(firms, pivot.multi, *([pruned] if materialize_panel else []))
    outcomes = {
        spec: {
            "markup_decomp": decomp[spec],
            "op_covariance": opcov_ld[spec],
            "dispersion": disp_ld[spec],
            "concentration": conc_ld[spec].join(turb[spec], [OUT_COUNTRY, OUT_INDUSTRY], "left"),
        }
        for spec in specs
    }
    return Shared(pruned, {**by_year, "concentration": conc}, outcomes, totals, tables)


def run_windows(panel: DataFrame, specs: Sequence[LongDiffSpec] = (TREATMENT, PRESHOCK), *,
                materialize_panel: bool = False, save: bool = False, out_dir: str | None = None,
                max_bytes: int | None = None, concurrent: bool = True,
                firm_buckets: int | None = None) -> dict[LongDiffSpec, dict[str, DataFrame]]:
    """Every family for every window: window -> name -> outcome table. With ``save``,
    one CSV per outcome (``block2/`` for windows other than the treatment window) and,
    when the treatment window is among them, the firm markup panel as parquet (one more scan of
    the panel; its totals come from the run's statistics). After an error nothing that the run
    wrote for itself is left."""
    if save:
        if out_dir is None:
            raise ValueError("save=True needs out_dir")
        paths = [outcome_path(out_dir, f, spec) for spec in specs for f in FAMILIES]
        if len(set(paths)) < len(paths):
            raise ValueError("two windows would be written to one path")
    firm_panel = save and TREATMENT in specs
    shared = prepare(panel, specs, materialize_panel=materialize_panel, max_bytes=max_bytes,
                     concurrent=concurrent, markup_totals=firm_panel)
    if save:
        try:
            with shared.tables as tables:  # the broadcast totals are written too
                if firm_panel:
                    write_firm_panel(firm_markup(panel, max_bytes, shared.markup_totals),
                                     os.path.join(out_dir, FIRM_PANEL_NAME), firm_buckets)
                for spec, results in shared.outcomes.items():
                    for family, df in results.items():
                        write_outcome_csv(df, outcome_path(out_dir, family, spec))
                tables.keep()
        except BaseException:
            shared.close()
            raise
    return shared.outcomes


def run_outcomes(panel: DataFrame, spec: LongDiffSpec = TREATMENT, *, save: bool = False,
                 out_dir: str | None = None, max_bytes: int | None = None) -> dict[str, DataFrame]:
    """Name -> outcome table for one window (the reference's per-window run)."""
    return run_windows(panel, [spec], save=save, out_dir=out_dir, max_bytes=max_bytes)[spec]
