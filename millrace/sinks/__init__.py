"""Batch sinks and the check of what they wrote."""

from millrace.sinks.files import (
    check_separate,
    scalar_columns,
    sibling_path,
    validate_output,
    write_csv_summary,
    write_partitioned,
)
from millrace.sinks.jdbc import jdbc_options, write_jdbc

__all__ = [
    "check_separate", "jdbc_options", "scalar_columns", "sibling_path", "validate_output",
    "write_csv_summary", "write_jdbc", "write_partitioned",
]
