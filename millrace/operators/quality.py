"""Finding and repairing missing, infinite, blank, duplicate and outlying values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import blank_as_null, bounded, infinite_as, is_infinite, is_missing, quoted, to_double
from millrace.functions.columns import FLOATING
from millrace.operators.columns import numeric_columns
from millrace.operators.quantiles import approx_quantiles, exact_quantiles
from millrace.operators.ranking import order_columns


def null_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Per column: rows, missing (NULL or NaN), NULL, NaN and infinite values.

    All columns are counted in one aggregation, and its single row is unpivoted.
    """
    names = list(columns) if columns is not None else df.columns
    entries = []
    for name in names:
        c, dtype = quoted(name), df.schema[name].dataType
        floating = isinstance(dtype, FLOATING)
        nan = F.count_if(F.isnan(c)) if floating else F.lit(0).cast("bigint")
        inf = F.count_if(is_infinite(c) & ~F.isnan(c)) if floating else F.lit(0).cast("bigint")
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(is_missing(c, dtype)).alias("missing_count"),
                F.count_if(c.isNull()).alias("null_count"),
                nan.alias("nan_count"),
                inf.alias("infinite_count"),
            )
        )
    return df.agg(F.array(*entries).alias("profile")).select(F.inline("profile"))


def floating_columns(df: DataFrame) -> list[str]:
    """The columns that can hold NaN or infinity."""
    return numeric_columns(df, types=FLOATING)


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with NULL or NaN in any (chosen) column."""
    return df.na.drop(subset=list(subset) if subset is not None else None)


def fill_missing(
    df: DataFrame, value: float = 0, columns: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Drop rows whose ``keys`` are missing, then replace NULL and NaN by ``value`` in
    all numeric (or the chosen) columns.  Strings and infinities are left alone."""
    kept = df.na.drop(subset=list(keys)) if keys else df
    return kept.na.fill(value, subset=list(columns) if columns is not None else None)


def replace_infinity(df: DataFrame, columns: Sequence[str] | None = None, value: float | None = 0.0) -> DataFrame:
    """Both infinities become ``value`` (``None`` for NULL) in the given floating columns."""
    names = list(columns) if columns is not None else floating_columns(df)
    return df.withColumns({name: infinite_as(quoted(name), value) for name in names})


def trim_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.trim(quoted(name)) for name in columns})


def blank_to_number(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Strings to double; blank text is NULL, other text NULL or an error if ``strict``."""
    return df.withColumns({name: to_double(blank_as_null(quoted(name)), strict) for name in columns})


def cast_to_double(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Bulk cast to double; what is no number is NULL, or an error if ``strict``."""
    return df.withColumns({name: to_double(quoted(name), strict) for name in columns})


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One row of each group of rows equal in all columns.

    NULL equals NULL, NaN equals NaN and -0.0 equals 0.0.  Copies are merged before the
    shuffle, so a row repeated very often costs no more than one per task.
    """
    return df.dropDuplicates()


def keep_first(df: DataFrame, subset: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row by ``order_by`` of each group equal in ``subset``.

    Spark limits every group to one row before the shuffle (``WindowGroupLimit``), so
    a dominant key does not gather in one task.
    """
    window = Window.partitionBy(*[quoted(c) for c in subset]).orderBy(*order_columns(order_by))
    place = "__place"
    return df.withColumn(place, F.row_number().over(window)).filter(F.col(place) == 1).drop(place)


def _multiplicities(df: DataFrame) -> DataFrame:
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))


def duplicate_report(df: DataFrame) -> DataFrame:
    """Total rows, distinct rows and surplus copies, from one shuffle."""
    total, distinct = F.coalesce(F.sum("__copies"), F.lit(0)), F.count(F.lit(1))
    return _multiplicities(df).agg(
        total.cast("bigint").alias("total_rows"),
        distinct.alias("distinct_rows"),
        (total - distinct).cast("bigint").alias("duplicate_rows"),
    )


def step_report(df: DataFrame, keep: Column) -> DataFrame:
    """Rows read, rows kept by the filter, and rows left after removing duplicates.

    Counted by an aggregation rather than by ``DataFrame.observe``: observed counts grow
    when tasks run again after losing an executor, and a session that has observed
    once can no longer ship models that carry a training summary to its executors.
    """
    kept = F.coalesce(keep, F.lit(False))
    flagged = df.withColumn("__kept", kept)
    total = F.coalesce(F.sum("__copies"), F.lit(0)).cast("bigint")
    surviving = F.coalesce(F.sum(F.when(F.col("__kept"), F.col("__copies"))), F.lit(0)).cast("bigint")
    unique = F.count_if(F.col("__kept"))
    counts = _multiplicities(flagged).agg(total.alias("t"), surviving.alias("s"), unique.alias("u"))

    def step(position: int, name: str, before: str, after: str) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("step"),
            F.col(before).alias("rows_in"),
            F.col(after).alias("rows_out"),
            (F.col(before) - F.col(after)).alias("rows_dropped"),
        )

    return counts.select(
        F.inline(F.array(step(1, "drop_missing", "t", "s"), step(2, "drop_duplicates", "s", "u")))
    )


@dataclass(frozen=True)
class Bounds:
    """Capping limits of one column; ``None`` where the column held no value."""

    lower: float | None
    upper: float | None


def fit_bounds(
    df: DataFrame, columns: Sequence[str], *, factor: float = 1.5, exact: bool = False, accuracy: int = 10_000
) -> dict[str, Bounds]:
    """Tukey fences ``q1 - factor * iqr`` and ``q3 + factor * iqr`` for all columns.

    The approximate quartiles of all columns come from one scan with bounded
    memory; ``exact`` adds a few more scans (see ``exact_quantiles``).
    """
    if exact:
        quartiles = exact_quantiles(df, columns, (0.25, 0.75))
    else:
        quartiles = approx_quantiles(df, columns, (0.25, 0.75), accuracy)
    fences = {}
    for name, (q1, q3) in quartiles.items():
        if q1 is None or q3 is None:
            fences[name] = Bounds(None, None)
        else:
            reach = factor * (q3 - q1)
            fences[name] = Bounds(q1 - reach, q3 + reach)
    return fences


def cap_outliers(df: DataFrame, bounds: Mapping[str, Bounds]) -> DataFrame:
    """Clamp each column to its fitted bounds; the column becomes double."""
    return df.withColumns({name: bounded(quoted(name), b.lower, b.upper) for name, b in bounds.items()})
