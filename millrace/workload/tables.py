"""Projections, filters, aggregations, windows and order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import columns, profile, ranking, relational, selection
from millrace.sources import view_query
from millrace.workload.registry import query, table


def _untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.toDF(*[f"  {c} " for c in part.columns])


@query(
    "clean_column_names",
    """SELECT p_partkey, p_name, p_brand AS brand, p_type AS "type/name", p_size, p_retailprice FROM part""",
)
def clean_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = columns.rename_columns(columns.strip_names(_untidy(spark, sf_dir)), {"p_brand": "brand"})
    return columns.rename_at(named, {3: "type/name"})


@query("select_columns", "SELECT l_orderkey, l_extendedprice, l_discount FROM lineitem")
def select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.select_columns(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_extendedprice", "l_discount"])


@query("drop_columns", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.drop_columns(table(spark, sf_dir, "supplier"), ["s_acctbal"])


@query(
    "numeric_columns",
    "SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
)
def numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    names = columns.numeric_columns(lines, exclude=["l_orderkey", "l_partkey", "l_suppkey"])
    return columns.select_columns(lines, names)


@query(
    "schema_profile",
    """SELECT 0 AS position, 'c_custkey' AS column_name, 'bigint' AS data_type, count(c_custkey) AS value_count FROM customer
       UNION ALL SELECT 1, 'c_name', 'string', count(c_name) FROM customer
       UNION ALL SELECT 2, 'c_nationkey', 'int', count(c_nationkey) FROM customer
       UNION ALL SELECT 3, 'c_acctbal', 'double', count(c_acctbal) FROM customer
       UNION ALL SELECT 4, 'c_mktsegment', 'string', count(c_mktsegment) FROM customer""",
)
def schema_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.schema_profile(table(spark, sf_dir, "customer"))


@query("filter_gt", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.where_greater(table(spark, sf_dir, "orders"), "o_totalprice", 250_000).select(
        "o_orderkey", "o_totalprice"
    )


@query("filter_eq", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.where_equal(table(spark, sf_dir, "orders"), {"o_orderstatus": "F"}).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


@query(
    "sql_conjunction",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 1""",
)
def sql_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_query(
        table(spark, sf_dir, "lineitem"),
        "line_rows",
        """SELECT l_orderkey, l_linenumber, l_quantity FROM {line_rows}
           WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 1""",
    )


@query("group_count", "SELECT o_custkey, count(*) AS row_count FROM orders GROUP BY o_custkey")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.group_count(table(spark, sf_dir, "orders"), ["o_custkey"], "row_count")


GROUPED = """SELECT o_orderpriority, count(*) AS row_count FROM {orders}
  WHERE o_totalprice > 100000 GROUP BY o_orderpriority"""


@query("sql_group_count", GROUPED.format(orders="orders"))
def sql_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_query(table(spark, sf_dir, "orders"), "order_rows", GROUPED.format(orders="{order_rows}"))


@query("sql_group_order", GROUPED.format(orders="orders") + " ORDER BY row_count DESC, o_orderpriority")
def sql_group_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = GROUPED.format(orders="{order_rows}") + " ORDER BY row_count DESC, o_orderpriority"
    return view_query(table(spark, sf_dir, "orders"), "order_rows", text)


@query(
    "sql_then_dataframe",
    """SELECT o_orderpriority, row_count, row_count > 2000 AS is_large FROM (
         SELECT o_orderpriority, count(*) AS row_count FROM orders WHERE o_totalprice > 100000
         GROUP BY o_orderpriority)""",
)
def sql_then_dataframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = view_query(table(spark, sf_dir, "orders"), "order_rows", GROUPED.format(orders="{order_rows}"))
    return counted.withColumn("is_large", F.col("row_count") > 2000)


@query(
    "class_counts",
    """SELECT count(*) AS row_count, count(*) FILTER (WHERE l_returnflag = 'N') AS normal,
         count(*) FILTER (WHERE l_returnflag <> 'N') AS other FROM lineitem""",
)
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return relational.conditional_counts(table(spark, sf_dir, "lineitem"), {"normal": flag == "N", "other": flag != "N"})


@query(
    "sum_by_key",
    "SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority",
)
def sum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = relational.sum_by_key(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice")
    return summed.withColumn("total", F.round("total", 2))


QUARTILES = """SELECT '{c}' AS column_name, round(quantile_cont({c}, 0.25), 4) AS q1,
  round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3 FROM lineitem"""


@query("quartiles", " UNION ALL ".join(QUARTILES.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_tax")))
def quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.quartiles(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], exact=True
    )
    return found.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


OWN_TYPE = """SELECT quantile_disc({c}, 0.25) AS {a}_q1, quantile_disc({c}, 0.5) AS {a}_median,
  quantile_disc({c}, 0.75) AS {a}_q3 FROM own"""
#: Keys far beyond what doubles tell apart, and days.
OWN_ROWS = """own AS (SELECT CAST(o_orderkey AS BIGINT) + 9007199254740992 AS key,
  CAST(o_orderdate AS DATE) AS day FROM orders)"""


@query(
    "quantiles_own_type",
    f"""WITH {OWN_ROWS} SELECT * FROM ({OWN_TYPE.format(c='key', a='key')}), ({OWN_TYPE.format(c='day', a='day')})""",
)
def quantiles_own_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("bigint") + F.lit(9007199254740992)
    rows = table(spark, sf_dir, "orders").select(key.alias("key"), F.col("o_orderdate").cast("date").alias("day"))
    found = selection.discrete_quantiles(rows, ["key", "day"], [0.25, 0.5, 0.75])
    names = [f"{c}_{q}" for c in ("key", "day") for q in ("q1", "median", "q3")]
    kinds = ", ".join(f"{n} {'bigint' if n.startswith('key') else 'date'}" for n in names)
    return spark.createDataFrame([(*found["key"], *found["day"])], kinds)


@query(
    "quartiles_approx",
    """SELECT column_name, true AS q1_in_rank, true AS median_in_rank, true AS q3_in_rank
       FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_tax')) AS v(column_name)""",
)
def quartiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranks of the estimates are within the stated error, a ten-thousandth of the rows."""
    lines, names = table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"]
    found = {r["column_name"]: r for r in profile.quartiles(lines, names).collect()}
    checks = []
    for name in names:
        marks = [F.lit(name).alias("column_name")]
        for q, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            c, value, rows = F.col(name).cast("double"), F.lit(float(found[name][q])), F.count(name)
            under, upto = F.count_if(c < value), F.count_if(c <= value)
            marks.append(((under <= rows * (share + 1e-4) + 1) & (upto >= rows * (share - 1e-4) - 1)).alias(f"{q}_in_rank"))
        checks.append(F.struct(*marks))
    return lines.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for a in NUMBERS
        for b in NUMBERS
    ),
)
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.correlation_matrix(table(spark, sf_dir, "lineitem"), NUMBERS).withColumn("corr", F.round("corr", 6))


DIMENSIONS = 64


@query(
    "correlation_matrix_wide",
    """WITH e AS (SELECT vec_id, unnest(embedding) AS v, unnest(range(64)) AS i FROM embeddings)
       SELECT concat('e', a.i) AS col_a, concat('e', b.i) AS col_b, round(corr(a.v::DOUBLE, b.v::DOUBLE), 6) AS corr
       FROM e a JOIN e b USING (vec_id) GROUP BY a.i, b.i""",
)
def correlation_matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More columns than one generated aggregation should hold."""
    names = [f"e{i}" for i in range(DIMENSIONS)]
    parts = table(spark, sf_dir, "embeddings").select(
        [F.get("embedding", F.lit(i)).cast("double").alias(name) for i, name in enumerate(names)]
    )
    return profile.correlation_matrix(parts, names).withColumn("corr", F.round("corr", 6))


@query(
    "window_row_number",
    """SELECT o_orderkey, o_orderstatus, o_totalprice,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS row_num FROM orders""",
)
def window_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    groups, order = ["o_orderstatus"], ["o_totalprice", "o_orderkey"]
    return ranking.number_rows(orders, groups, order, "row_num", ranking.fit_range_cuts(orders, groups, order))


@query(
    "window_rank",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
         rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS place FROM lineitem""",
)
def window_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    groups, order = ["l_returnflag"], ["l_quantity"]
    return ranking.rank_rows(lines, groups, order, "place", ranking.fit_range_cuts(lines, groups, order))


#: Rows of a group that the queries below leave to one task; all groups are larger, as the largest
#: are in tables of real size.
FEW_ROWS = 600


@query(
    "window_row_number_large",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (
         PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS row_num FROM orders""",
)
def window_row_number_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    groups, order = ["o_orderstatus"], ["-o_totalprice", "o_orderkey"]
    large = ranking.fit_range_cuts(orders, groups, order, rows_per_task=FEW_ROWS)
    return ranking.number_rows(orders, groups, order, "row_num", large)


@query(
    "window_rank_large",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice,
         rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC, l_extendedprice) AS place FROM lineitem""",
)
def window_rank_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(columns)
    groups, order = ["l_returnflag"], ["-l_quantity", "l_extendedprice"]
    large = ranking.fit_range_cuts(lines, groups, order, rows_per_task=FEW_ROWS)
    return ranking.rank_rows(lines, groups, order, "place", large)


@query(
    "window_running_total",
    """SELECT o_orderkey, o_orderstatus, coalesce(sum(CAST(o_custkey AS HUGEINT)) OVER (
         PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM orders""",
)
def window_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", F.col("o_custkey").cast("bigint"))
    totals = ranking.prefix_sums(orders, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], "o_custkey", rows_per_task=FEW_ROWS)
    return totals.select("o_orderkey", "o_orderstatus", "before")


@query(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.top_rows(orders, ["-o_totalprice", "o_orderkey"], 10)
