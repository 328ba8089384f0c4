"""Sources (firm-year panels) and sinks (firm panel parquet, outcome CSVs)."""

from firmdyn.sources.panel import (
    derived_panel,
    load_panel,
    panel_count,
    panel_files,
    prepare_panel,
    read_table,
)
from firmdyn.sources.sinks import OUTPUT_NAMES, output_dir, write_firm_panel, write_outcome_csv

__all__ = [
    "OUTPUT_NAMES",
    "derived_panel",
    "load_panel",
    "output_dir",
    "panel_count",
    "panel_files",
    "prepare_panel",
    "read_table",
    "write_firm_panel",
    "write_outcome_csv",
]
