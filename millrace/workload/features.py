"""Encoding, scaling, weighting, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import bucket, flag_unless, ratio
from millrace.operators import features, metrics, quality, relational, sampling
from millrace.workload.registry import DIRTY_SQL, dirty_lines, query, table

WITH = f"WITH {DIRTY_SQL}"


@query(
    "label_summary",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem)
       SELECT l_returnflag, CAST(l_returnflag <> 'N' AS INTEGER) AS is_returned, count(*) AS row_count,
         round(max(least(greatest(l_extendedprice, a - 0.25 * (b - a)), b + 0.25 * (b - a))), 4) AS highest
       FROM lineitem, q GROUP BY 1, 2 ORDER BY row_count DESC, l_returnflag""",
)
def label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cap, flag, group and order: the flagship."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    capped = quality.cap_outliers(lines, quality.fit_bounds(lines, ["l_extendedprice"], factor=0.25, exact=True))
    flagged = capped.withColumn("is_returned", flag_unless(F.col("l_returnflag"), "N"))
    summary = flagged.groupBy("l_returnflag", "is_returned").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.max("l_extendedprice"), 4).alias("highest")
    )
    return summary.orderBy(F.desc("row_count"), "l_returnflag")


LABEL = "nullif(trim(label), '')"


@query(
    "binary_label",
    f"""{WITH}, t AS (SELECT l_orderkey, l_linenumber, {LABEL} AS label FROM dirty)
        SELECT l_orderkey, l_linenumber, CASE WHEN label = 'N' THEN 0 ELSE 1 END AS flag_null_is_one,
          CASE WHEN label IS NULL THEN 'unknown' WHEN label = 'N' THEN '0' ELSE '1' END AS flag FROM t""",
)
def binary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both policies for rows without a label: count as 1, or stay unknown."""
    label = F.expr(LABEL)
    return dirty_lines(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        flag_unless(label, "N", 1).alias("flag_null_is_one"),
        F.coalesce(flag_unless(label, "N").cast("string"), F.lit("unknown")).alias("flag"),
    )


@query(
    "safe_ratio",
    """SELECT l_orderkey, l_linenumber,
         round(CASE WHEN l_discount > 0 THEN l_tax / l_discount ELSE 0.0 END, 6) AS tax_ratio FROM lineitem""",
)
def safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = ratio(F.col("l_tax"), F.col("l_discount"), 0.0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(value, 6).alias("tax_ratio"))


@query(
    "safe_ratio_fallback",
    """SELECT l_orderkey, l_linenumber,
         round(CASE WHEN l_discount > 0 THEN l_quantity / l_discount ELSE l_quantity END, 6) AS lot_ratio FROM lineitem""",
)
def safe_ratio_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = ratio(F.col("l_quantity"), F.col("l_discount"), F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(value, 6).alias("lot_ratio"))


@query(
    "bucketize",
    f"""{WITH} SELECT l_orderkey, l_linenumber, CASE WHEN duration IS NULL THEN 'unknown' WHEN duration < 1000 THEN 'very_short'
          WHEN duration < 10000 THEN 'short' WHEN duration < 50000 THEN 'medium' ELSE 'long' END AS duration_bucket
        FROM dirty""",
)
def bucketize(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = bucket(F.col("duration"), (1_000, 10_000, 50_000), ("very_short", "short", "medium", "long"), "unknown")
    return dirty_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", name.alias("duration_bucket"))


def _index_sql(source: str, column: str, name: str) -> str:
    return f"""{name} AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx
      FROM (SELECT CAST({column} AS VARCHAR) AS label, count(*) AS n FROM {source} GROUP BY 1))"""


@query(
    "string_index",
    f"""WITH {_index_sql('orders', 'o_orderpriority', 'p')}
        SELECT o_orderkey, o_orderpriority, idx AS priority_index FROM orders JOIN p ON label = o_orderpriority""",
)
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    fitted = features.fit_categories(orders, ["o_orderpriority"])
    return features.index_categories(orders, fitted, {"o_orderpriority": "priority_index"})


INDEXED = {"l_returnflag": "flag_index", "l_linestatus": "status_index", "l_linenumber": "line_index", "l_quantity": "lot_index"}


@query(
    "string_index_many",
    "WITH lines AS (SELECT l_orderkey, l_returnflag, l_linestatus, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity FROM lineitem), "
    + ", ".join(_index_sql("lines", c, f"t_{c}") for c in INDEXED)
    + " SELECT l_orderkey, "
    + ", ".join(f"t_{c}.idx AS {out}" for c, out in INDEXED.items())
    + " FROM lines "
    + " ".join(f"JOIN t_{c} ON t_{c}.label = CAST({c} AS VARCHAR)" for c in INDEXED),
)
def string_index_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *INDEXED)
    lines = lines.withColumn("l_quantity", F.col("l_quantity").cast("int"))
    fitted = features.fit_categories(lines, list(INDEXED))
    return features.index_categories(lines, fitted, INDEXED).select("l_orderkey", *INDEXED.values())


@query(
    "string_index_parts",
    f"""WITH {_index_sql('lineitem', 'l_partkey', 'p')}
        SELECT l_orderkey, l_linenumber, l_partkey, idx AS part_index FROM lineitem
        JOIN p ON label = CAST(l_partkey AS VARCHAR)""",
)
def string_index_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary that grows with the data."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    fitted = features.fit_categories(lines, ["l_partkey"])
    return features.index_categories(lines, fitted, {"l_partkey": "part_index"})


@query(
    "assemble_skip",
    f"""{WITH} SELECT l_orderkey, l_linenumber, 2 AS width FROM dirty
        WHERE qty IS NOT NULL AND rate IS NOT NULL AND NOT isnan(rate)""",
)
def assemble_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    assembled = features.assemble(dirty_lines(spark, sf_dir), ["qty", "rate"], "features", "skip")
    return assembled.select("l_orderkey", "l_linenumber", F.size(vector_to_array("features")).alias("width"))


@query(
    "standardize",
    """SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_samp(o_totalprice) OVER (), 6) AS price_z,
         0.0::DOUBLE AS constant_z FROM orders""",
)
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.lit(3.5).alias("constant"))
    scaled = features.standardize(orders, features.fit_scaler(orders, ["o_totalprice", "constant"]), "_z")
    return scaled.select("o_orderkey", F.round("o_totalprice_z", 6).alias("price_z"), "constant_z")


@query(
    "target_encode",
    """WITH c AS (SELECT o_orderpriority AS p, count(*) AS n, sum(CAST(o_orderstatus = 'F' AS INTEGER)) AS s FROM orders GROUP BY 1),
         g AS (SELECT sum(s) * 1.0 / sum(n) AS m FROM c)
       SELECT o_orderkey, round(s * 1.0 / n, 6) AS encoded, round((s + 100.0 * m) / (n + 100.0), 6) AS smoothed
       FROM orders JOIN c ON p = o_orderpriority, g""",
)
def target_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("y")
    )
    fitted = features.fit_target_means(orders, ["o_orderpriority"], "y")
    plain = features.encode_targets(orders, fitted, {"o_orderpriority": "encoded"})
    both = features.encode_targets(plain, fitted, {"o_orderpriority": "smoothed"}, smoothing=100)
    return both.select("o_orderkey", F.round("encoded", 6).alias("encoded"), F.round("smoothed", 6).alias("smoothed"))


@query(
    "class_weights",
    """WITH c AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, count(*) AS n FROM lineitem GROUP BY 1)
       SELECT y, n AS row_count, round((SELECT sum(n) FROM c) / (2.0 * n), 6) AS class_weight FROM c""",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"))
    weighted = features.add_class_weights(lines, features.fit_class_weights(lines, "y"), "y")
    counted = relational.group_count(weighted, ["y", "class_weight"], "row_count")
    return counted.withColumn("class_weight", F.round("class_weight", 6))


@query(
    "sample_fraction",
    "SELECT count(*) AS all_rows, true AS size_is_likely, CAST(0 AS BIGINT) AS strangers, CAST(0 AS BIGINT) AS repeats FROM orders",
)
def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample differs with the partitioning, but not in these respects."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    drawn = sampling.sample_fraction(orders, 0.05, 42).withColumn("drawn", F.lit(1)).groupBy("o_orderkey", "o_totalprice").agg(F.sum("drawn").alias("drawn"))
    both = orders.join(drawn, ["o_orderkey", "o_totalprice"], "full")
    counts = both.join(orders.select("o_orderkey", F.lit(1).alias("known")), "o_orderkey", "left").agg(
        F.count("known").alias("all_rows"),
        _is_likely(F.coalesce(F.sum("drawn"), F.lit(0)), F.count("known"), 0.05).alias("size_is_likely"),
        F.count_if(F.col("known").isNull()).alias("strangers"),
        F.count_if(F.col("drawn") > 1).alias("repeats"),
    )
    return counts


def _is_likely(n: Column, rows: Column, share: float) -> Column:
    """Whether ``n`` of ``rows`` is within six deviations of the share."""
    return F.abs(n - rows * share) <= 6 * F.sqrt(rows * (share * (1 - share))) + 1


HASH = "CAST(concat('0x', substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 100"


@query("sample_by_hash", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {HASH} < 5")
def sample_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_by_hash(table(spark, sf_dir, "orders"), "o_orderkey", 5).select("o_orderkey", "o_totalprice")


@query(
    "split_random",
    "SELECT count(*) AS row_count, count(DISTINCT o_orderkey) AS keys, true AS size_is_likely FROM orders",
)
def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides together are the rows, each once, and have about the sizes asked for."""
    sides = sampling.split_random(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"))
    train, test = (side.withColumn("part", F.lit(name)) for side, name in zip(sides, ("train", "test")))
    rows = F.count(F.lit(1))
    return train.unionByName(test).agg(
        rows.alias("row_count"),
        F.count_distinct("o_orderkey").alias("keys"),
        _is_likely(F.count_if(F.col("part") == "train"), rows, 0.8).alias("size_is_likely"),
    )


@query(
    "split_by_hash",
    f"SELECT o_orderkey, o_orderstatus, CASE WHEN {HASH} < 80 THEN 'train' ELSE 'test' END AS part FROM orders",
)
def split_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.split_by_hash(orders, "o_orderkey", 80)


@query(
    "split_stratified",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (
           PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey)
         <= 0.8 * count(*) OVER (PARTITION BY o_orderstatus) THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.split_stratified(orders, "o_orderstatus", "o_orderkey", 0.8)


@query(
    "split_stratified_large",
    """SELECT o_orderkey, stratum, CASE WHEN row_number() OVER (
           PARTITION BY stratum ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey)
         <= 0.7 * count(*) OVER (PARTITION BY stratum) THEN 'train' ELSE 'test' END AS part
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_orderstatus ELSE 'most' END AS stratum FROM orders)""",
)
def split_stratified_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stratum holds nine tenths of the rows; its bins are searched until they are small."""
    stratum = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_orderstatus")).otherwise("most")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", stratum.alias("stratum"))
    return sampling.split_stratified(orders, "stratum", "o_orderkey", 0.7, rows_per_task=20, bin_digits=1)


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("y"),
        (F.col("l_quantity") > 25).cast("double").alias("prediction"),
        "l_extendedprice",
    )


PREDICTED = """WITH m AS (SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS y, CAST(l_quantity > 25 AS DOUBLE) AS p FROM lineitem)"""


@query(
    "confusion_matrix",
    f"{PREDICTED} SELECT y AS label, p AS prediction, count(*) AS n FROM m GROUP BY 1, 2 ORDER BY 1, 2",
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(metrics.tally(_predicted(spark, sf_dir), "y", "prediction"))


@query(
    "binary_metrics",
    f"""{PREDICTED}, k AS (SELECT c, count(*) FILTER (WHERE y = c) AS n, count(*) FILTER (WHERE p = c) AS ph,
            count(*) FILTER (WHERE y = c AND p = c) AS tp FROM m, (VALUES (0.0), (1.0)) AS v(c) GROUP BY c),
          s AS (SELECT c, n, tp, coalesce(tp / nullif(ph, 0), 0) AS pr, coalesce(tp / nullif(n, 0), 0) AS re FROM k),
          f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM s)
        SELECT round(sum(tp) / sum(n), 4) AS accuracy, round(sum(pr * n) / sum(n), 4) AS weighted_precision,
          round(sum(re * n) / sum(n), 4) AS weighted_recall, round(sum(f1 * n) / sum(n), 4) AS weighted_f1,
          round(max(pr) FILTER (WHERE c = 1), 4) AS positive_precision, round(max(re) FILTER (WHERE c = 1), 4) AS positive_recall,
          round(max(f1) FILTER (WHERE c = 1), 4) AS positive_f1 FROM f""",
)
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.overall_metrics(metrics.tally(_predicted(spark, sf_dir), "y", "prediction"), digits=4)


def _auc_sql(score: str) -> str:
    return f"""WITH g AS (SELECT {score} AS s, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS p,
           CAST(count(*) FILTER (WHERE l_returnflag <> 'R') AS DOUBLE) AS n FROM lineitem GROUP BY 1),
         r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn FROM g)
       SELECT round(sum(p * (cn + n / 2)) / (sum(p) * sum(n)), 6) AS auc FROM r"""


@query("auc_exact_large", _auc_sql("l_extendedprice"))
def auc_exact_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With more distinct scores than one task may sort."""
    tallied = metrics.tally(_predicted(spark, sf_dir), "y", "prediction", "l_extendedprice")
    return metrics.area_under_roc(tallied, rows_per_task=600).withColumn("auc", F.round("auc", 6))


@query(
    "string_index_large",
    f"""WITH {_index_sql('lineitem', 'l_partkey', 'p')}
        SELECT l_orderkey, l_linenumber, l_partkey, idx AS part_index FROM lineitem JOIN p ON label = CAST(l_partkey AS VARCHAR)""",
)
def string_index_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With more labels than one task may sort."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    fitted = features.fit_categories(lines, ["l_partkey"], rows_per_task=600)
    return features.index_categories(lines, fitted, {"l_partkey": "part_index"})


@query(
    "auc_exact",
    """WITH g AS (SELECT l_extendedprice AS s, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS p,
           CAST(count(*) FILTER (WHERE l_returnflag <> 'R') AS DOUBLE) AS n FROM lineitem GROUP BY 1),
         r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn FROM g)
       SELECT round(sum(p * (cn + n / 2)) / (sum(p) * sum(n)), 6) AS auc FROM r""",
)
def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    tallied = metrics.tally(_predicted(spark, sf_dir), "y", "prediction", "l_extendedprice")
    return metrics.area_under_roc(tallied).withColumn("auc", F.round("auc", 6))
