"""Sources and sinks: what is written has to come back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.relational import group_count
from millrace.sinks import sibling_path, validate_output, write_csv_summary, write_partitioned
from millrace.sources import file_lineage, inline_rows, quarantine_csv, scan_csv, scan_parquet, view_query
from millrace.workload.registry import query, table
from millrace.workspace import shared_dir

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _orders_csv(spark: SparkSession, sf_dir: str, price: Column | None = None) -> str:
    """Orders as headed CSV files, with blanks around the names."""
    orders = table(spark, sf_dir, "orders").select(ORDERS)
    if price is not None:
        orders = orders.withColumn("o_totalprice", price)
    path = shared_dir(spark, "orders-csv")
    # Blanks around the names are kept only if the writer is told so.
    orders.toDF(*[f" {c} " for c in ORDERS]).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _broken_price() -> Column:
    text = F.col("o_totalprice").cast("string")
    return F.when(F.col("o_orderkey") % 10 == 0, F.lit("n/a")).otherwise(text)


ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
ORDERS_SQL = """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
  o_orderstatus, o_totalprice, o_orderpriority FROM orders"""


def _typed(df: DataFrame) -> DataFrame:
    """Inference narrows to int what fits."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


@query("src_csv_infer", ORDERS_SQL)
def src_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(scan_csv(spark, _orders_csv(spark, sf_dir)))


@query("src_csv_schema", ORDERS_SQL)
def src_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_csv(spark, _orders_csv(spark, sf_dir), schema=ORDERS_SCHEMA, enforceSchema="true")


@query("src_csv_dropmalformed", f"{ORDERS_SQL} WHERE o_orderkey % 10 <> 0")
def src_csv_dropmalformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_csv(spark, _orders_csv(spark, sf_dir, _broken_price()), schema=ORDERS_SCHEMA)


@query(
    "src_csv_one_column",
    """SELECT o_orderstatus, count(*) AS row_count, (SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 0) AS all_rows
       FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY 1""",
)
def src_csv_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good column of rows that have a bad value in another one: they are dropped all the same."""
    orders = scan_csv(spark, _orders_csv(spark, sf_dir, _broken_price()), schema=ORDERS_SCHEMA)
    counts = group_count(orders, ["o_orderstatus"], "row_count")
    return counts.withColumn("all_rows", F.lit(orders.count()).cast("bigint"))


@query(
    "src_csv_quarantine",
    """SELECT o_orderkey, o_orderkey % 10 = 0 AS is_malformed,
      CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def src_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = quarantine_csv(spark, _orders_csv(spark, sf_dir, _broken_price()), ORDERS_SCHEMA)
    return read.select("o_orderkey", F.col("_corrupt_record").isNotNull().alias("is_malformed"), "o_totalprice")


@query("src_parquet", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/part.parquet")


@query(
    "src_partitioned_readback",
    """SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(o_orderstatus <> 'F' AS INTEGER) AS is_open
       FROM orders WHERE o_orderstatus <> 'F'""",
)
def src_partitioned_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition, its column typed from the directory name; the others are not listed."""
    path = shared_dir(spark, "partitioned-orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_partitioned(orders.withColumn("is_open", (F.col("o_orderstatus") != "F").cast("int")), path, ["is_open"])
    return scan_parquet(spark, f"{path}/is_open=1", base_path=path)


@query("file_lineage", "SELECT 'lineitem' AS source_file, count(*) AS row_count FROM lineitem")
def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "lineitem").select(file_lineage(r"(\w+)\.parquet").alias("source_file"))
    return group_count(named, ["source_file"], "row_count")


@query(
    "src_inline_rows",
    """SELECT o_orderpriority, urgency, count(*) AS row_count FROM orders
       JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 2), ('5-LOW', 1))
         AS v(priority, urgency) ON priority = o_orderpriority GROUP BY 1, 2""",
)
def src_inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)]
    urgency = inline_rows(spark, rows, "priority string, urgency int")
    joined = table(spark, sf_dir, "orders").join(F.broadcast(urgency), F.col("priority") == F.col("o_orderpriority"))
    return group_count(joined, ["o_orderpriority", "urgency"], "row_count")


@query("sql_select_star", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sql_select_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_query(table(spark, sf_dir, "customer"), "customer_rows", "SELECT * FROM {customer_rows}")


@query(
    "sink_partitioned_parquet",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag,
         CAST(l_returnflag <> 'N' AS INTEGER) AS is_returned FROM lineitem""",
)
def sink_partitioned_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "lines")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"
    )
    write_partitioned(lines.withColumn("is_returned", (F.col("l_returnflag") != "N").cast("int")), path, ["is_returned"])
    return scan_parquet(spark, path)


@query(
    "sink_csv_summary",
    """SELECT l_returnflag, CAST(l_returnflag <> 'N' AS INTEGER) AS is_returned, count(*) AS row_count
       FROM lineitem GROUP BY 1, 2""",
)
def sink_csv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    data_set = shared_dir(spark, "lines")
    path = sibling_path(data_set, "summary")
    flagged = table(spark, sf_dir, "lineitem").withColumn("is_returned", (F.col("l_returnflag") != "N").cast("int"))
    summary = group_count(flagged, ["l_returnflag", "is_returned"], "row_count", largest_first=True)
    write_csv_summary(summary, path, data_set)
    return scan_csv(spark, path, schema="l_returnflag string, is_returned int, row_count bigint")


@query(
    "validate_output",
    """SELECT CAST(l_returnflag <> 'N' AS INTEGER) AS is_returned, count(*) AS row_count, 4 AS column_count
       FROM lineitem GROUP BY 1""",
)
def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "lines")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_returnflag") != "N").cast("int").alias("is_returned")
    )
    write_partitioned(lines, path, ["is_returned"])
    return validate_output(spark, path, ["is_returned"])
