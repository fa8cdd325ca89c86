"""Scans and sinks: CSV landing, dated partitions, Silver/Gold Parquet."""

from flagstar.sources.landing import (
    LandingResult,
    land_by_date,
    land_csv,
    load_report,
    path_exists,
    read_csv,
    read_latest,
    table_counts,
    tables_ready,
    write_partition,
)
from flagstar.sources.layers import materialize, read_source, read_table, write_table

__all__ = [
    "LandingResult",
    "land_by_date",
    "land_csv",
    "load_report",
    "materialize",
    "path_exists",
    "read_csv",
    "read_latest",
    "read_source",
    "read_table",
    "table_counts",
    "tables_ready",
    "write_partition",
    "write_table",
]
