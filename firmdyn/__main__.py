"""Command line: all outcome families of a panel folder, for one or both windows.

    python -m firmdyn PANEL_DIR OUT_DIR [--window treatment|preshock|both]
                      [--smoke] [--no-save] [--master local[8]]

``--smoke`` reads only the first parquet file in name order; ``--no-save`` computes
and reports without writing. On a cluster, submit with spark-submit and give the
shared checkpoint folder in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from firmdyn.plans.outcomes import run_windows
from firmdyn.schema import PRESHOCK, TREATMENT
from firmdyn.session import ensure_checkpoint_dir
from firmdyn.sources import load_panel, panel_count

WINDOWS = {"treatment": [TREATMENT], "preshock": [PRESHOCK], "both": [TREATMENT, PRESHOCK]}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="firmdyn", description=__doc__.split("\n\n")[0])
    parser.add_argument("panel_dir")
    parser.add_argument("out_dir")
    parser.add_argument("--window", choices=sorted(WINDOWS), default="both")
    parser.add_argument("--smoke", action="store_true", help="first parquet file only")
    parser.add_argument("--no-save", action="store_true")
    parser.add_argument("--master", default=None, help="e.g. local[8]; default: spark-submit's")
    args = parser.parse_args(argv)

    builder = SparkSession.builder.appName("firmdyn")
    if args.master:
        builder = builder.master(args.master).config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)

    panel = load_panel(spark, args.panel_dir, first_file_only=args.smoke)
    print(f"firm-year rows: {panel_count(panel).first().n_rows:,}")
    results = run_windows(panel, WINDOWS[args.window], save=not args.no_save,
                          out_dir=args.out_dir)
    for spec, tables in results.items():
        for family, df in tables.items():
            print(f"{family} {spec.base}: {df.count():,} industries x {len(df.columns)} columns")
    if not args.no_save:
        print(f"written to {args.out_dir}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
