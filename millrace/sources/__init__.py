"""Batch sources.  Streaming sources are in ``millrace.streaming``."""

from millrace.sources.files import (
    NAME,
    NUMBER,
    file_lineage,
    fit_names,
    quarantine_csv,
    scan_csv,
    scan_lines,
    scan_parquet,
    source_names,
)
from millrace.sources.flows import flow_schema
from millrace.sources.inline import inline_rows, inline_values, view_query

__all__ = [
    "NAME", "NUMBER", "file_lineage", "fit_names", "flow_schema", "inline_rows", "inline_values", "quarantine_csv",
    "scan_csv", "scan_lines", "scan_parquet", "source_names", "view_query",
]
