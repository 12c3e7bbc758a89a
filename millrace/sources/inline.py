"""Small tables given in the program, and SQL over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def inline_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str] | str) -> DataFrame:
    """A table from tuples; ``names`` may also be a DDL schema."""
    return spark.createDataFrame(list(rows), names if isinstance(names, str) else list(names))


def inline_values(spark: SparkSession, values: Sequence[object], name: str = "value") -> DataFrame:
    """A one-column string table from a list that may mix types."""
    schema = T.StructType([T.StructField(name, T.StringType())])
    return spark.createDataFrame([(None if v is None else str(v),) for v in values], schema)


def view_query(df: DataFrame, view: str, text: str) -> DataFrame:
    """SQL text over ``df``, which it names ``{view}``; no view outlives the call, and none of
    the caller's is replaced."""
    return df.sparkSession.sql(text, **{view: df})
