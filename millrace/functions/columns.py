"""Scalar expressions used by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)


def quoted(name: str) -> Column:
    """Column by its literal name, also when the name holds dots, blanks or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(c: Column, dtype: T.DataType | None = None) -> Column:
    """NULL, or NaN where the type can hold it.  Never NULL itself."""
    if dtype is not None and not isinstance(dtype, FLOATING):
        return c.isNull()
    return c.isNull() | F.isnan(c)


def is_infinite(c: Column) -> Column:
    """True for both infinities; NULL for NULL."""
    return F.abs(c) == F.lit(float("inf"))


def infinite_as(c: Column, value: float | None) -> Column:
    """Both infinities become ``value``; NULL and NaN pass."""
    return F.when(is_infinite(c), F.lit(value)).otherwise(c)


def bounded(c: Column, lower: float | None, upper: float | None) -> Column:
    """Clamp to ``[lower, upper]`` as double.

    NULL and NaN pass, and missing bounds (fitted on an empty column) leave the
    values alone.
    """
    value = c.cast("double")
    if lower is None or upper is None:
        return value
    clamped = F.greatest(F.least(value, F.lit(float(upper))), F.lit(float(lower)))
    return F.when(is_missing(value), value).otherwise(clamped)


def blank_as_null(c: Column) -> Column:
    """Trim spaces; an empty rest is NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def to_double(c: Column, strict: bool = False) -> Column:
    """Number in a string.  Text that is not a number is NULL, or an error if ``strict``."""
    return c.cast("double") if strict else c.try_cast("double")


def ratio(numerator: Column, denominator: Column, fallback: Column | float | None) -> Column:
    """``numerator / denominator`` where the denominator is positive, else ``fallback``."""
    other = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.when(denominator > 0, numerator / denominator).otherwise(other.cast("double"))


def bucket(
    c: Column,
    thresholds: Sequence[float],
    labels: Sequence[str],
    null_label: str | None = None,
) -> Column:
    """Name of the half-open range ``[t[i-1], t[i])`` that holds the value.

    ``labels`` has one entry more than ``thresholds``; the last one has no upper end.
    """
    if len(labels) != len(thresholds) + 1:
        raise ValueError("labels must have one entry more than thresholds")
    if list(thresholds) != sorted(set(thresholds)):
        raise ValueError("thresholds must strictly increase")
    picked = F.when(c.isNull(), F.lit(null_label))
    for limit, label in zip(thresholds, labels):
        picked = picked.when(c < limit, F.lit(label))
    return picked.otherwise(F.lit(labels[-1]))


def flag_unless(c: Column, normal: str | int | float, null_flag: int | None = None) -> Column:
    """0 for the normal value, 1 for any other, ``null_flag`` for NULL."""
    return F.coalesce((c != F.lit(normal)).cast("int"), F.lit(null_flag).cast("int"))


def hash_percent(key: Column, seed: str = "") -> Column:
    """A stable number in 0..99 from the key alone, whatever the partitioning.

    The first eight hex digits of MD5 are used so that other engines can reproduce it.
    """
    text = key.cast("string") if not seed else F.concat(F.lit(seed), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
