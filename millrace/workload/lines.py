"""Text lines: read, parse, filter, sum."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import lines, relational
from millrace.sources import inline_values, scan_lines
from millrace.workload.registry import query, table
from millrace.workspace import shared_dir

HEADER = "order,customer,status,priority,cents"
SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("cents", T.LongType()),
    ]
)
CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
PARSED = f"""p AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
  o_orderpriority AS priority, {CENTS} AS cents FROM orders)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text files, each with a header line, read back without it."""
    path = shared_dir(spark, "order-lines")
    orders = table(spark, sf_dir, "orders")
    text = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.expr(CENTS))
    header = spark.range(1).select(F.lit(HEADER).alias("value"))
    header.unionAll(orders.select(text.alias("value"))).write.text(path)
    return scan_lines(spark, path, HEADER)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.parse_lines(_lines(spark, sf_dir), SCHEMA, quotes=False)


@query(
    "rdd_text_source",
    f"WITH {PARSED} SELECT concat_ws(',', order_id, customer_id, status, priority, cents) AS value FROM p",
)
def rdd_text_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir)


@query("rdd_parse_lines", f"WITH {PARSED} SELECT * FROM p")
def rdd_parse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir)


@query("rdd_parse_quoted", f"WITH {PARSED} SELECT * FROM p")
def rdd_parse_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.parse_lines(_lines(spark, sf_dir), SCHEMA)


@query("rdd_sum_by_key", f"WITH {PARSED} SELECT priority, CAST(sum(cents) AS BIGINT) AS total FROM p GROUP BY 1")
def rdd_sum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.sum_by_key(_parsed(spark, sf_dir), ["priority"], "cents")


@query("rdd_global_sum", f"WITH {PARSED} SELECT CAST(sum(cents) AS BIGINT) AS total FROM p")
def rdd_global_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.column_sum(_parsed(spark, sf_dir), "cents")


@query("rdd_filter_count", f"WITH {PARSED} SELECT count(*) FILTER (WHERE cents > 25000000) AS row_count FROM p")
def rdd_filter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.count_where_greater(_parsed(spark, sf_dir), "cents", 25_000_000, "row_count")


@query(
    "rdd_from_list",
    """SELECT event_type, count(*) AS row_count FROM events WHERE event_type IN ('view', 'click', 'purchase', '404') GROUP BY 1""",
)
def rdd_from_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = inline_values(spark, ["view", "click", "purchase", 404], "wanted")
    kept = table(spark, sf_dir, "events").join(F.broadcast(wanted), F.col("event_type") == F.col("wanted"), "left_semi")
    return relational.group_count(kept, ["event_type"], "row_count")
