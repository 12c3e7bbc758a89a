"""Delimited text lines, as DataFrames and as RDDs.

Use the DataFrame forms: they stay in the JVM.  The RDD forms do the same for
programs that hold RDDs; their functions run in Python workers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import quoted


def parse_lines(lines: DataFrame, schema: T.StructType, delimiter: str = ",", quotes: bool = True) -> DataFrame:
    """Typed columns from the text column ``value``.

    With ``quotes``, fields may be quoted as in CSV files; without, every delimiter
    separates.  A field that does not fit its type is NULL.
    """
    if quotes:
        parsed = F.from_csv("value", schema.simpleString()[len("struct<") : -1].replace(":", " "), {"sep": delimiter})
        return lines.select(parsed.alias("row")).select("row.*")
    fields = F.split("value", _literal(delimiter))
    return lines.select(
        [F.get(fields, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )


def _literal(delimiter: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() else c for c in delimiter)


def column_sum(df: DataFrame, column: str, name: str = "total") -> DataFrame:
    """Sum over all rows; NULL, not an error, if there are none."""
    return df.agg(F.sum(quoted(column)).alias(name))


def count_where_greater(df: DataFrame, column: str, limit: float, name: str = "count") -> DataFrame:
    return df.agg(F.count_if(quoted(column) > F.lit(limit)).alias(name))


def lines_rdd(spark: SparkSession, path: str, skip_header: bool = False) -> RDD:
    """Text lines as an RDD; the header is the first line, wherever it repeats."""
    lines = spark.sparkContext.textFile(path)
    if not skip_header:
        return lines
    header = lines.first()
    return lines.filter(lambda line: line != header)


def values_rdd(spark: SparkSession, values: Sequence[object], slices: int | None = None) -> RDD:
    return spark.sparkContext.parallelize(list(values), slices)


def fields_rdd(lines: RDD, converters: Sequence[Callable[[str], object]], delimiter: str = ",") -> RDD:
    """Tuples of converted fields."""
    chosen = tuple(converters)
    return lines.map(lambda line: tuple(convert(text) for convert, text in zip(chosen, line.split(delimiter))))


def sum_by_key_rdd(rows: RDD, key: int, value: int) -> RDD:
    """(key, sum) pairs; sums are combined before the shuffle."""
    return rows.map(lambda row: (row[key], row[value])).reduceByKey(lambda a, b: a + b)


def sum_rdd(rows: RDD, value: int) -> float | int:
    """Sum over all rows; 0 if there are none."""
    return rows.map(lambda row: row[value]).fold(0, lambda a, b: a + b)


def count_rdd(rows: RDD, condition: Callable[[tuple], bool]) -> int:
    return rows.filter(condition).count()
