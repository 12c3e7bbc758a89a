"""Encoding, scaling and weighting.

``fit_*`` learns a small table or a few numbers; the apply functions are plain
projections and lookups that also work on new data and on streams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import is_missing, quoted
from millrace.operators.lookup import BROADCAST_ROWS, lookup
from millrace.operators.ranking import ROWS_PER_TASK, fit_range_cuts, number_rows
from millrace.workspace import BROADCAST_BYTES, FittedTable, freeze


def _label_rows(df: DataFrame, columns: Sequence[str], *extra: Column) -> DataFrame:
    """One row per (column, label).  Only the aggregation right after it sees these
    rows, and it merges them before the shuffle."""
    pairs = [F.struct(F.lit(c).alias("column_name"), quoted(c).cast("string").alias("label")) for c in columns]
    return df.select(F.inline(F.array(*pairs)), *extra).filter(F.col("label").isNotNull())


def fit_categories(df: DataFrame, columns: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> FittedTable:
    """Number the labels of all columns by falling frequency, ties in label order.

    One scan for all columns.  Table: ``column_name, label, n, idx``.  NULL is no label.
    """
    counted = freeze(
        _label_rows(df, columns).groupBy("column_name", "label").agg(F.count(F.lit(1)).alias("n")), "label-counts"
    )
    order = ["-n", "label"]
    cuts = None
    if counted.rows > rows_per_task:
        cuts = fit_range_cuts(counted.table, ["column_name"], order, rows_per_task=rows_per_task)
    numbered = number_rows(counted.table, ["column_name"], order, "idx", cuts)
    return freeze(numbered.withColumn("idx", (F.col("idx") - 1).cast("double")), "label-index", counted)


def _by_column(fitted: FittedTable, columns: Sequence[str]) -> dict[str, FittedTable]:
    """The table of each column.  The extents of a table too large to broadcast whole are
    measured column by column, and each counts those of all smaller columns as its own, so
    that what is broadcast in all keeps the limit."""
    extents = dict.fromkeys(columns, (fitted.rows, fitted.size))
    if fitted.rows > BROADCAST_ROWS or fitted.size > BROADCAST_BYTES:
        size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint"))
        found = fitted.table.groupBy("column_name").agg(F.count(F.lit(1)), size).collect()
        extents, rows, total = dict.fromkeys(columns, (0, 0)), 0, 0
        for name, n, own in sorted((tuple(r) for r in found if r[0] in extents), key=lambda r: (r[2], r[0])):
            rows, total = rows + n, total + own
            extents[name] = (rows, total)
    own_table = lambda c: fitted.table.filter(F.col("column_name") == c).drop("column_name")
    return {c: FittedTable(own_table(c), *extents[c]) for c in columns}


def _as_label(df: DataFrame, column: str) -> tuple[DataFrame, str]:
    key = f"__{column}_label"
    return df.withColumn(key, quoted(column).cast("string")), key


def index_categories(
    df: DataFrame, fitted: FittedTable, outputs: Mapping[str, str], invalid: str = "error"
) -> DataFrame:
    """Add the index of each column under its output name.

    ``invalid`` decides about NULL and labels never seen: ``error`` raises when such a
    row is read, ``keep`` gives them one index after the last, ``skip`` drops the row.
    """
    if invalid not in ("error", "keep", "skip"):
        raise ValueError(f"unknown policy {invalid!r}")
    sizes: dict[str, int] = {}
    if invalid == "keep":
        sizes = {r[0]: r[1] for r in fitted.table.groupBy("column_name").count().collect()}
    tables = _by_column(fitted, list(outputs))
    for column, output in outputs.items():
        keyed, key = _as_label(df, column)
        one = tables[column]
        renamed = replace(one, table=one.table.withColumnRenamed("idx", output))
        found = lookup(keyed, renamed, {key: "label"})
        if invalid == "skip":
            found = found.filter(F.col(output).isNotNull())
        elif invalid == "keep":
            found = found.withColumn(output, F.coalesce(quoted(output), F.lit(float(sizes.get(column, 0)))))
        else:
            message = F.concat(F.lit(f"{column} has no index for "), F.coalesce(F.col(key), F.lit("NULL")))
            found = found.withColumn(output, F.coalesce(quoted(output), F.raise_error(message).cast("double")))
        df = found.drop(key)
    return df


def fit_target_means(df: DataFrame, columns: Sequence[str], label: str) -> FittedTable:
    """Rows and label sum of each category.  Table: ``column_name, label, n, total``."""
    rows = _label_rows(df, columns, quoted(label).cast("double").alias("y")).filter(F.col("y").isNotNull())
    grouped = rows.groupBy("column_name", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("total"))
    return freeze(grouped, "target-means")


def encode_targets(
    df: DataFrame, fitted: FittedTable, outputs: Mapping[str, str], smoothing: float = 0.0
) -> DataFrame:
    """Replace categories by the mean label of their rows, drawn towards the overall mean
    as if it had ``smoothing`` rows.  Categories never seen get the overall mean."""
    sums = fitted.table.groupBy("column_name").agg((F.sum("total") / F.sum("n")).alias("mean"))
    overall = {r["column_name"]: r["mean"] for r in sums.collect()}
    tables = _by_column(fitted, list(outputs))
    for column, output in outputs.items():
        one = tables[column]
        mean = F.lit(overall.get(column))
        blended = (F.col("total") + F.lit(float(smoothing)) * mean) / (F.col("n") + F.lit(float(smoothing)))
        encoded = replace(one, table=one.table.select("label", "n", blended.alias("__mean")))
        keyed, key = _as_label(df, column)
        found = lookup(keyed, encoded, {key: "label"})
        df = found.withColumn(output, F.coalesce(F.col("__mean"), mean)).drop("__mean", key)
    return df


def fit_class_weights(df: DataFrame, label: str) -> FittedTable:
    """``rows / (classes * rows of the class)`` for every class present.

    One grouping gives all counts; rows without a label are in no class and get no
    weight.  Table: ``label, n, weight``.
    """
    labelled = df.filter(quoted(label).isNotNull())
    counted = freeze(labelled.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n")), "class-counts")
    total, classes = counted.table.agg(F.sum("n"), F.count(F.lit(1))).first()
    weight = F.lit(float(total or 0)) / (F.lit(float(classes)) * F.col("n"))
    return replace(counted, table=counted.table.withColumn("weight", weight))


def add_class_weights(df: DataFrame, fitted: FittedTable, label: str, output: str = "class_weight") -> DataFrame:
    weights = replace(fitted, table=fitted.table.withColumnRenamed("weight", output))
    return lookup(df, weights, {label: "label"})


@dataclass(frozen=True)
class Scale:
    mean: float | None
    deviation: float | None


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, Scale]:
    """Mean and sample standard deviation of all columns in one scan; NULL and NaN are
    left out."""
    measures = []
    for c in columns:
        value = quoted(c).cast("double")
        present = F.when(~is_missing(value), value)
        measures += [F.avg(present), F.stddev_samp(present)]
    row = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first()
    return {c: Scale(row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}


def standardize(df: DataFrame, scales: Mapping[str, Scale], suffix: str = "_scaled") -> DataFrame:
    """``(x - mean) / deviation``; a column that does not vary becomes 0."""
    scaled = {}
    for name, scale in scales.items():
        value = quoted(name).cast("double")
        if scale.mean is None:
            scaled[name + suffix] = F.lit(None).cast("double")
        elif not scale.deviation:
            scaled[name + suffix] = F.when(value.isNotNull(), F.lit(0.0))
        else:
            scaled[name + suffix] = (value - F.lit(scale.mean)) / F.lit(scale.deviation)
    return df.withColumns(scaled)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features", invalid: str = "skip") -> DataFrame:
    """Collect columns into a vector.  ``skip`` drops rows with NULL or NaN in any of
    them, ``error`` raises, ``keep`` stores NaN."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid).transform(df)


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows ``assemble`` would keep under ``skip``."""
    return df.na.drop(subset=list(columns))
