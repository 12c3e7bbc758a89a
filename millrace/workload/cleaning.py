"""Data quality, over the table with injected dirt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.workload.registry import DIRTY_SQL, dirty_lines, query, table

WITH = f"WITH {DIRTY_SQL}"
IS_INF = "{c} IN (CAST('Infinity' AS DOUBLE), CAST('-Infinity' AS DOUBLE))"
RATE_INF = IS_INF.format(c="rate")
KEYS = ["l_orderkey", "l_linenumber"]


def _profile_sql(name: str, floating: bool) -> str:
    nan = f"count(*) FILTER (WHERE isnan({name}))" if floating else "CAST(0 AS BIGINT)"
    inf = f"count(*) FILTER (WHERE {IS_INF.format(c=name)})" if floating else "CAST(0 AS BIGINT)"
    return f"""SELECT '{name}' AS column_name, count(*) AS row_count, count(*) - count({name}) + {nan} AS missing_count,
      count(*) - count({name}) AS null_count, {nan} AS nan_count, {inf} AS infinite_count FROM dirty"""


PROFILED = {"l_orderkey": False, "l_discount": True, "duration": True, "qty": True, "rate": True, "label": False}


@query("null_profile", WITH + " UNION ALL ".join(_profile_sql(n, f) for n, f in PROFILED.items()))
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(dirty_lines(spark, sf_dir), list(PROFILED))


@query(
    "dropna_any",
    f"""{WITH} SELECT l_orderkey, l_linenumber, qty, rate FROM dirty
        WHERE duration IS NOT NULL AND qty IS NOT NULL AND rate IS NOT NULL AND NOT isnan(rate)""",
)
def dropna_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_missing(dirty_lines(spark, sf_dir)).select(*KEYS, "qty", "rate")


@query(
    "dropna_subset",
    f"{WITH} SELECT l_orderkey, l_linenumber, qty FROM dirty WHERE duration IS NOT NULL AND qty IS NOT NULL",
)
def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_missing(dirty_lines(spark, sf_dir), ["duration", "qty"]).select(*KEYS, "qty")


FILLED = "coalesce(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 0) AS {c}"


@query(
    "fill_missing",
    f"""{WITH} SELECT l_orderkey, l_linenumber, duration, {FILLED.format(c='qty')}, {FILLED.format(c='rate')}, label
        FROM dirty WHERE duration IS NOT NULL""",
)
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fill_missing(dirty_lines(spark, sf_dir), 0, keys=["duration"]).select(
        *KEYS, "duration", "qty", "rate", "label"
    )


@query(
    "fill_missing_subset",
    f"""{WITH} SELECT l_orderkey, l_linenumber, CAST(qty IS NULL AS INTEGER) AS qty_missing,
        {FILLED.format(c='rate')} FROM dirty""",
)
def fill_missing_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = quality.fill_missing(dirty_lines(spark, sf_dir), 0, columns=["rate"])
    return filled.select(*KEYS, F.col("qty").isNull().cast("int").alias("qty_missing"), "rate")


STATE = """CASE WHEN {c} IS NULL THEN 'null' WHEN isnan({c}) THEN 'nan'
  WHEN {c} = CAST('Infinity' AS DOUBLE) OR {c} = CAST('-Infinity' AS DOUBLE) THEN 'infinite' ELSE 'number' END"""


def _state(name: str) -> Column:
    return F.expr(STATE.format(c=name)).alias("state")


@query(
    "replace_inf_zero",
    f"""{WITH}, r AS (SELECT l_orderkey, l_linenumber, CASE WHEN {RATE_INF} THEN 0 ELSE rate END AS rate FROM dirty)
        SELECT l_orderkey, l_linenumber, CASE WHEN isnan(rate) THEN NULL ELSE rate END AS rate,
          {STATE.format(c='rate')} AS state FROM r""",
)
def replace_inf_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and NULL have to pass, so the state of the value is part of the result."""
    repaired = quality.replace_infinity(dirty_lines(spark, sf_dir), ["rate"], 0.0)
    return repaired.select(*KEYS, F.nanvl("rate", F.lit(None)).alias("rate"), _state("rate"))


@query(
    "replace_inf_null",
    f"""{WITH}, r AS (SELECT l_orderkey, l_linenumber, CASE WHEN {RATE_INF} THEN NULL ELSE rate END AS rate FROM dirty)
        SELECT l_orderkey, l_linenumber, {FILLED.format(c='rate')}, {STATE.format(c='rate')} AS state FROM r""",
)
def replace_inf_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = quality.replace_infinity(dirty_lines(spark, sf_dir), ["rate"], None)
    marked = repaired.withColumn("state", _state("rate"))
    return quality.fill_missing(marked, 0, columns=["rate"]).select(*KEYS, "rate", "state")


@query("dedup_rows", f"{WITH} SELECT DISTINCT l_orderkey, l_linenumber, l_discount, qty, rate, label FROM dirty")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_duplicates(dirty_lines(spark, sf_dir).drop("duration"))


@query(
    "dedup_subset",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) = 1""",
)
def dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*KEYS, "l_partkey", "l_suppkey", "l_quantity")
    return quality.keep_first(lines, KEYS, ["l_partkey", "l_suppkey", "l_quantity"])


@query(
    "duplicate_report",
    f"""{WITH} SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_rows FROM
        (SELECT count(*) AS total_rows FROM dirty),
        (SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT * FROM dirty))""",
)
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_report(dirty_lines(spark, sf_dir))


@query(
    "cap_outliers",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b,
         quantile_cont(l_quantity * l_quantity, 0.25) AS c, quantile_cont(l_quantity * l_quantity, 0.75) AS d FROM lineitem)
       SELECT l_orderkey, l_linenumber,
         round(least(greatest(l_extendedprice, a - 0.25 * (b - a)), b + 0.25 * (b - a)), 4) AS price,
         round(least(greatest(l_quantity * l_quantity, c - 0.25 * (d - c)), d + 0.25 * (d - c)), 4) AS square
       FROM lineitem, q""",
)
def cap_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fences a quarter of the spread wide, so that these even columns have outliers."""
    lines = table(spark, sf_dir, "lineitem").select(
        *KEYS, F.col("l_extendedprice").alias("price"), (F.col("l_quantity") * F.col("l_quantity")).alias("square")
    )
    bounds = quality.fit_bounds(lines, ["price", "square"], factor=0.25, exact=True)
    capped = quality.cap_outliers(lines, bounds)
    return capped.withColumns({c: F.round(c, 4) for c in ("price", "square")})


SKEWED = "l_extendedprice * l_extendedprice / 1000"


@query(
    "cap_outliers_approx",
    f"""WITH r AS (SELECT l_orderkey, l_linenumber, {SKEWED} AS x FROM lineitem),
      f AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM r)
    SELECT l_orderkey, l_linenumber, true AS is_near, x > q3 + 1.55 * (q3 - q1) AS is_capped FROM r, f
    WHERE x NOT BETWEEN q3 + 1.45 * (q3 - q1) AND q3 + 1.55 * (q3 - q1)""",
)
def cap_outliers_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Far from the fences the same rows are capped as by exact ones, to nearly the same value."""
    lines = table(spark, sf_dir, "lineitem").select(*KEYS, F.expr(SKEWED).alias("x"))
    capped = quality.cap_outliers(lines.withColumn("own", F.col("x")), quality.fit_bounds(lines, ["x"]))
    exact = quality.fit_bounds(lines, ["x"], exact=True)["x"]
    step = (exact.upper - exact.lower) / 4  # the distance of the quartiles
    own, high = F.col("own"), F.lit(exact.upper)
    near = F.abs(F.col("x") - F.least(own, high)) <= 0.05 * step
    away = ~own.between(exact.upper - 0.05 * step, exact.upper + 0.05 * step)
    return capped.filter(away).select(*KEYS, near.alias("is_near"), (F.col("x") < own).alias("is_capped"))


BALANCE = "CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE concat(' ', CAST(c_nationkey AS VARCHAR), '.5 ') END"


@query(
    "blank_to_null_cast",
    f"SELECT c_custkey, CAST(nullif(trim({BALANCE}), '') AS DOUBLE) AS charges FROM customer",
)
def blank_to_null_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(BALANCE.replace("VARCHAR", "STRING"))
    charged = table(spark, sf_dir, "customer").select("c_custkey", text.alias("charges"))
    return quality.blank_to_number(charged, ["charges"])


BRAND = "CASE WHEN p_partkey % 5 = 0 THEN p_brand ELSE CAST(p_size AS {t}) END"


@query(
    "try_cast_columns",
    f"""SELECT p_partkey, TRY_CAST({BRAND.format(t='VARCHAR')} AS DOUBLE) AS size_text,
          CAST(p_size AS DOUBLE) AS p_size FROM part""",
)
def try_cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = table(spark, sf_dir, "part").select(
        "p_partkey", F.expr(BRAND.format(t="STRING")).alias("size_text"), "p_size"
    )
    return quality.cast_to_double(mixed, ["size_text", "p_size"])


@query("trim_values", f"{WITH} SELECT l_orderkey, l_linenumber, trim(label) AS label FROM dirty")
def trim_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.trim_values(dirty_lines(spark, sf_dir), ["label"]).select(*KEYS, "label")


@query(
    "step_metrics",
    f"""{WITH}, k AS (SELECT * FROM dirty WHERE duration IS NOT NULL),
        c AS (SELECT (SELECT count(*) FROM dirty) AS t, (SELECT count(*) FROM k) AS s,
                (SELECT count(*) FROM (SELECT DISTINCT * FROM k)) AS u)
        SELECT 1 AS position, 'drop_missing' AS step, t AS rows_in, s AS rows_out, t - s AS rows_dropped FROM c
        UNION ALL SELECT 2, 'drop_duplicates', s, u, s - u FROM c""",
)
def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.step_report(dirty_lines(spark, sf_dir), F.col("duration").isNotNull())
