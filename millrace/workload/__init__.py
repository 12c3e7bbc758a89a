"""The operators as queries over the benchmark tables, each with SQL to check it by."""

from millrace.workload import cleaning, features, jobs, learning, lines, sources, streams, tables  # noqa: F401
from millrace.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
