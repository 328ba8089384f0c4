"""Benchmark: all four outcome families for both windows.

Setup (timed as ``derive_panel``): the firm-year panel is derived from the driver
tables and written as parquet (2 x cores files) to a fresh scratch folder. Headline (``value``): load
that parquet panel, build every table both windows share (``shared_tables``), and
execute each outcome of the 2012 and 2010 windows with the no-op sink. The same outcomes
through the naive reference-shaped SQL on the same session are reported as
``naive_value``. Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3, best run is reported; the first run is the warm-up),
     BENCH_NAIVE (default 1), BENCH_NAIVE_REPEAT (default 2, best run is reported),
     BENCH_SEQUENTIAL (default 1: also one run of the same plans without concurrent jobs),
     BENCH_PANEL_COPIES (default 1: the derived panel as is; K > 1 writes it K times
     under new firm ids, so every industry grows K-fold -- a scale-up check)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from firmdyn.plans import naive_sql  # noqa: E402
from firmdyn.plans.outcomes import FAMILIES, prepare  # noqa: E402
from firmdyn.schema import PRESHOCK, TREATMENT  # noqa: E402
from firmdyn.session import local_session  # noqa: E402
from firmdyn.sources import derived_panel, load_panel  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def optimised(spark, panel_dir: str, concurrent: bool = True) -> dict[str, float]:
    """Shared tables (concurrent jobs unless ``concurrent`` is off), then each outcome
    executed by the caller (a filter / projection of small written tables)."""
    times: dict[str, float] = {}
    specs = (TREATMENT, PRESHOCK)
    t = time.perf_counter()
    shared = prepare(load_panel(spark, panel_dir), specs, concurrent=concurrent)
    times["shared_tables"] = time.perf_counter() - t
    results = shared.outcomes
    for spec in specs:
        for family in FAMILIES:
            times[f"{family}_{spec.base}"] = timed(lambda: run(results[spec][family]))
    return times


def naive(spark, sf_dir: str, panel_dir: str) -> dict[str, float]:
    spark.read.parquet(panel_dir).createOrReplaceTempView("raw_panel_files")
    sql = naive_sql.queries("select * from raw_panel_files", dialect="spark")
    times = {}
    for spec in (TREATMENT, PRESHOCK):
        for family in ("markup_decomp", "op_covariance", "dispersion", "concentration"):
            name = f"{family}_{spec.base}"
            times[name] = timed(lambda: run(spark.sql(sql[name])))
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    naive_repeat = int(os.environ.get("BENCH_NAIVE_REPEAT", "2"))
    with_naive = os.environ.get("BENCH_NAIVE", "1") == "1"
    spark = local_session(cores=cpus, shuffle_partitions=cpus, app="firmdyn-bench")
    scratch = tempfile.mkdtemp(prefix="firmdyn-bench-")
    panel_dir = os.path.join(scratch, "panel")

    copies = int(os.environ.get("BENCH_PANEL_COPIES", "1"))

    def derive_panel():
        panel = derived_panel(spark, sf_dir)
        if copies > 1:
            # every firm-year row repeated K times; new firm ids keep the country prefix
            copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy")
            panel = panel.select("*", copy).withColumn(
                "bvd_id", F.concat("bvd_id", F.lit("-"), F.col("_copy").cast("string"))
            ).drop("_copy")
        # a folder of many files, as production panels are: 2 x cores files
        panel.repartition(2 * cpus).write.mode("overwrite").parquet(panel_dir)

    derive = timed(derive_panel)
    runs = [optimised(spark, panel_dir) for _ in range(max(repeat, 1))]
    best = min(runs, key=lambda r: sum(r.values()))
    out = {
        "metric": "outcomes_both_windows_sec",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in best.items()},
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "panel_copies": copies,
        "cpus": cpus,
        "derive_panel_sec": round(derive, 3),
        "runs_sec": [round(sum(r.values()), 3) for r in runs],
        "spark": spark.version,
    }
    if os.environ.get("BENCH_SEQUENTIAL", "1") == "1":
        out["sequential_value"] = round(sum(optimised(spark, panel_dir, concurrent=False).values()), 3)
    if with_naive:
        nv = min((naive(spark, sf_dir, panel_dir) for _ in range(max(naive_repeat, 1))),
                 key=lambda r: sum(r.values()))
        out["naive_value"] = round(sum(nv.values()), 3)
        out["naive_queries"] = {k: round(v, 3) for k, v in nv.items()}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
