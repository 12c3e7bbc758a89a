"""Filtering, grouping and summarising."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import quoted


def where_greater(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.filter(quoted(column) > F.lit(limit))


def where_equal(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows that equal every given value."""
    for name, value in values.items():
        df = df.filter(quoted(name) == F.lit(value))
    return df


def group_count(df: DataFrame, keys: Sequence[str], name: str = "count", largest_first: bool = False) -> DataFrame:
    """Rows per group, optionally by falling count with the keys as tie-break."""
    counted = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), *[quoted(k) for k in keys]) if largest_first else counted


def sum_by_key(df: DataFrame, keys: Sequence[str], value: str, name: str = "total") -> DataFrame:
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.sum(quoted(value)).alias(name))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """All rows and the rows meeting each condition, in one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )
