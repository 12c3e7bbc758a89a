"""Column expressions; everything here stays inside the JVM."""

from millrace.functions.columns import (
    blank_as_null,
    bounded,
    bucket,
    flag_unless,
    hash_percent,
    infinite_as,
    is_infinite,
    is_missing,
    quoted,
    ratio,
    to_double,
)

__all__ = [
    "blank_as_null", "bounded", "bucket", "flag_unless", "hash_percent", "infinite_as",
    "is_infinite", "is_missing", "quoted", "ratio", "to_double",
]
