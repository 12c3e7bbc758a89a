"""Statistics over many columns at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import is_missing, quoted
from millrace.operators.quantiles import approx_quantiles, exact_quantiles

#: Up to this many columns, pairs are correlated by one generated aggregation.
NATIVE_COLUMNS = 12


def quartiles(df: DataFrame, columns: Sequence[str], exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """First quartile, median and third quartile per column."""
    probabilities = (0.25, 0.5, 0.75)
    if exact:
        found = exact_quantiles(df, columns, probabilities)
    else:
        found = approx_quantiles(df, columns, probabilities, accuracy)
    return df.sparkSession.createDataFrame(
        [(name, *values) for name, values in found.items()], "column_name string, q1 double, median double, q3 double"
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, over all rows where both hold a finite value.

    Long form ``(col_a, col_b, corr)`` with both orders of each pair and the diagonal.
    """
    if len(columns) <= NATIVE_COLUMNS:
        upper = _native_pairs(df, columns)
    else:
        upper = _moment_pairs(df, columns)
    mirrored = F.when(F.col("a") == F.col("b"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    names = F.array(*[F.lit(c) for c in columns])
    both = upper.select("a", "b", "corr", F.explode(mirrored).alias("swap"))
    first = F.when(F.col("swap"), F.col("b")).otherwise(F.col("a"))
    second = F.when(F.col("swap"), F.col("a")).otherwise(F.col("b"))
    return both.select(
        F.get(names, first).alias("col_a"), F.get(names, second).alias("col_b"), F.col("corr")
    )


def _finite(name: str) -> Column:
    """The column as doubles; what is missing or infinite is NULL, at any number of columns."""
    value = quoted(name).cast("double")
    return F.when(~is_missing(value) & (F.abs(value) != F.lit(float("inf"))), value)


def _native_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = {c: _finite(c) for c in columns}

    def correlation(a: Column, b: Column) -> Column:
        # F.corr divides by zero, an error in ANSI mode, if a column does not vary.
        spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
        return F.try_divide(F.covar_pop(a, b), spread)

    pairs = [
        F.struct(F.lit(i).alias("a"), F.lit(j).alias("b"), correlation(values[a], values[b]).alias("corr"))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if i <= j
    ]
    return df.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))


def _moment_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise moments by matrix products in each task, then summed per pair.

    A generated aggregation over thousands of pairs would outgrow what the JVM can
    compile; here a task emits one row per pair, whatever its number of rows.
    Values are shifted by the column means first, which keeps the sums accurate.
    """
    doubles = df.select([_finite(c).alias(f"c{i}") for i, c in enumerate(columns)])
    row = doubles.agg(*[F.avg(F.when(~F.isnan(c), F.col(c))) for c in doubles.columns]).first()
    shift = [float(m) if m is not None and abs(m) != float("inf") else 0.0 for m in row]
    width = len(columns)

    def moments(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype("float64") for c in batch.columns]) - shift
            seen = (~np.isnan(x)).astype("float64")
            x = np.where(seen == 1.0, x, 0.0)
            part = np.stack([seen.T @ seen, x.T @ seen, seen.T @ x, (x * x).T @ seen, seen.T @ (x * x), x.T @ x])
            sums = part if sums is None else sums + part
        if sums is not None:
            a, b = np.triu_indices(width)
            flat = [pa.array(sums[k][a, b]) for k in range(6)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.astype("int32")), pa.array(b.astype("int32")), *flat],
                names=["a", "b", "n", "x", "y", "xx", "yy", "xy"],
            )

    fields = "a int, b int, n double, x double, y double, xx double, yy double, xy double"
    summed = (
        doubles.mapInArrow(moments, fields)
        .groupBy("a", "b")
        .agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    )
    n, x, y = F.col("n"), F.col("x"), F.col("y")

    def variation(square: Column, total: Column) -> Column:
        """Zero for a column that does not vary, whatever rounding has left of it."""
        rest = n * square - total * total
        return F.when(rest > 1e-12 * n * square, rest)

    spread = F.sqrt(variation(F.col("xx"), x)) * F.sqrt(variation(F.col("yy"), y))
    return summed.select("a", "b", F.try_divide(n * F.col("xy") - x * y, spread).alias("corr"))
