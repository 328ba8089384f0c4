"""Shuffle volume of the optimised run and of the naive plan, from Spark's event log.

usage: python tools/shuffle_volume.py [sf_dir] [panel copies] [panel files, one map task each]

Derives the panel, writes it as parquet, then runs (a) every outcome of both windows
through ``run_windows`` and (b) the naive SQL of the same outcomes, each in its own
session with the event log in a fresh scratch folder, and sums the shuffle bytes and
records written by all tasks. Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def session(log_dir: str | None) -> SparkSession:
    b = (SparkSession.builder.master("local[8]").appName("firmdyn-shuffle")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.files.openCostInBytes", "128m"))  # a map task for every file
    if log_dir:
        b = (b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
              .config("spark.eventLog.rolling.enabled", "false")
              .config("spark.eventLog.compress", "false"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def shuffle_totals(log_dir: str) -> dict[str, int]:
    out = {"shuffle_bytes_written": 0, "shuffle_records_written": 0, "tasks": 0}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                w = m.get("Shuffle Write Metrics") or {}
                out["shuffle_bytes_written"] += w.get("Shuffle Bytes Written", 0)
                out["shuffle_records_written"] += w.get("Shuffle Records Written", 0)
                out["tasks"] += 1
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    files = int(sys.argv[3]) if len(sys.argv) > 3 else 16
    scratch = tempfile.mkdtemp(prefix="firmdyn-shuffle-")
    panel_dir = os.path.join(scratch, "panel")

    from firmdyn.session import ensure_checkpoint_dir
    from firmdyn.sources import derived_panel

    spark = session(None)
    ensure_checkpoint_dir(spark)
    panel = derived_panel(spark, sf_dir)
    if copies > 1:
        copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy")
        panel = panel.select("*", copy).withColumn(
            "bvd_id", F.concat("bvd_id", F.lit("-"), F.col("_copy").cast("string"))).drop("_copy")
    panel.repartition(files).write.parquet(panel_dir)
    spark.stop()

    result = {"sf": sf_dir, "panel_copies": copies, "panel_files": files}
    for label in ("optimised", "naive"):
        log_dir = os.path.join(scratch, f"events-{label}")
        os.makedirs(log_dir)
        spark = session(log_dir)
        ensure_checkpoint_dir(spark)
        if label == "optimised":
            from firmdyn.plans.outcomes import run_windows
            from firmdyn.sources import load_panel

            for tables in run_windows(load_panel(spark, panel_dir), concurrent=False).values():
                for df in tables.values():
                    df.write.format("noop").mode("overwrite").save()
        else:
            from firmdyn.plans import naive_sql

            spark.read.parquet(panel_dir).createOrReplaceTempView("raw_panel_files")
            sql = naive_sql.queries("select * from raw_panel_files", dialect="spark")
            for base in (2012, 2010):
                for family in ("markup_decomp", "op_covariance", "dispersion", "concentration"):
                    spark.sql(sql[f"{family}_{base}"]).write.format("noop").mode("overwrite").save()
        spark.stop()
        result[label] = shuffle_totals(log_dir)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
