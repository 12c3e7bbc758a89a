"""Registration of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: The clean tables with gaps, infinities, blanks and copies put in by rule.
DIRTY_SQL = """
base AS (
  SELECT l_orderkey, l_linenumber, l_discount,
    CASE WHEN (l_orderkey + l_linenumber) % 31 = 0 THEN NULL ELSE l_extendedprice END AS duration,
    CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN NULL ELSE l_quantity END AS qty,
    CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN CAST('Infinity' AS DOUBLE)
         WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN CAST('-Infinity' AS DOUBLE)
         WHEN (l_orderkey + l_linenumber) % 19 = 0 THEN CAST('NaN' AS DOUBLE)
         WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN NULL
         ELSE l_extendedprice END AS rate,
    CASE WHEN (l_orderkey + l_linenumber) % 29 = 0 THEN ' '
         ELSE concat(' ', l_returnflag, ' ') END AS label
  FROM lineitem),
dirty AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE l_orderkey % 10 = 0)
"""


#: The same rows, each from one of three files; copies are from other files than their originals.
FILED_SQL = DIRTY_SQL.rstrip() + """,
filed AS (SELECT *, CASE day WHEN 0 THEN 'Tuesday' WHEN 1 THEN 'Friday' ELSE 'Monday' END || '-WorkingHours' AS source_file
  FROM (SELECT *, l_orderkey % 3 AS day FROM base
        UNION ALL SELECT *, (l_orderkey + 1) % 3 AS day FROM base WHERE l_orderkey % 10 = 0))
"""


def filed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``FILED_SQL``."""
    day = (F.col("l_orderkey") + F.col("copy") - 1) % 3
    name = F.when(day == 0, "Tuesday").when(day == 1, "Friday").otherwise("Monday")
    return _dirty(spark, sf_dir).withColumn("source_file", F.concat(name, F.lit("-WorkingHours"))).drop("copy")


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``DIRTY_SQL``."""
    return _dirty(spark, sf_dir).drop("copy")


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows from a single scan, with the number of the copy."""
    place = F.col("l_orderkey") + F.col("l_linenumber")

    def every(n: int) -> Column:
        return place % n == 0

    price = F.col("l_extendedprice")
    rate = (
        F.when(every(13), F.lit(float("inf")))
        .when(every(17), F.lit(float("-inf")))
        .when(every(19), F.lit(float("nan")))
        .when(every(23), F.lit(None))
        .otherwise(price)
    )
    copies = F.when(F.col("l_orderkey") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_discount",
        F.when(~every(31), price).alias("duration"),
        F.when(~every(11), F.col("l_quantity")).alias("qty"),
        rate.alias("rate"),
        F.when(every(29), F.lit(" ")).otherwise(F.concat(F.lit(" "), "l_returnflag", F.lit(" "))).alias("label"),
        F.explode(copies).alias("copy"),
    )
