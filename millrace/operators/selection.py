"""Exact quantiles of whole numbers, decimals, dates and timestamps, in their own type.

The value at a rank is found by radix descent: columns become integer codes that keep their order,
and each pass counts the rows by the next 16 bits of the code, among those that share the bits
found so far.  A pass merges to at most 65,536 rows for each search before anything is shuffled,
and four passes settle 64 bits, whatever the number of rows and however they repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal, localcontext
from fractions import Fraction
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import quoted

BITS = 16
LEAST = -(1 << 63)
#: Decimals of up to so many digits are one code; the digits of longer ones make three.
DIGITS, PIECE = 18, 13
EPOCH = datetime(1970, 1, 1)


def codes(c: Column, kind: T.DataType) -> list[Column]:
    """Bigint columns that compare, one after the other, like ``c``."""
    if isinstance(kind, T.IntegralType):
        return [c.cast("bigint")]
    if isinstance(kind, T.DateType):
        return [F.unix_date(c).cast("bigint")]
    if isinstance(kind, T.TimestampType):
        return [F.unix_micros(c)]
    if isinstance(kind, T.TimestampNTZType):
        return [F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), c)]
    if isinstance(kind, T.DecimalType):
        if kind.precision <= DIGITS:
            return [_unscaled(c, kind.scale)]
        # Taken apart as text, for no further digit fits into a decimal.
        digits = F.lpad(F.regexp_replace(c.cast("string"), r"[^0-9]", ""), 3 * PIECE, "0")
        sign = F.when(c < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
        return [sign * F.substring(digits, 1 + i * PIECE, PIECE).cast("bigint") for i in range(3)]
    raise TypeError(f"no whole-number code for {kind.simpleString()}: use exact_quantiles")


def _unscaled(c: Column, scale: int) -> Column:
    return (c * F.lit(Decimal(10) ** scale)).cast("bigint") if scale else c.cast("bigint")


def decode(found: Sequence[int], kind: T.DataType) -> object:
    """The value that has these codes."""
    if isinstance(kind, T.DateType):
        return date(1970, 1, 1) + timedelta(days=found[0])
    if isinstance(kind, T.TimestampType):
        return (EPOCH.replace(tzinfo=timezone.utc) + timedelta(microseconds=found[0])).astimezone().replace(tzinfo=None)
    if isinstance(kind, T.TimestampNTZType):
        return EPOCH + timedelta(microseconds=found[0])
    if isinstance(kind, T.DecimalType):
        whole = reduce(lambda a, d: a * 10**PIECE + d, found, 0)
        with localcontext(prec=60):
            return Decimal(whole).scaleb(-kind.scale)
    return found[0]


@dataclass
class _Search:
    column: str
    width: int
    #: Rows below the wanted one among those that share ``prefix``.
    place: int
    prefix: tuple[int, ...] = ()

    @property
    def found(self) -> list[int]:
        parts = [self.prefix[i : i + 4] for i in range(0, len(self.prefix), 4)]
        return [reduce(lambda a, d: a << BITS | d, p, 0) + LEAST for p in parts]


def _matches(names: list[str], prefix: tuple[int, ...]) -> Column:
    """Which rows have codes that begin with these digits."""
    hit = F.lit(True)
    for i, name in enumerate(names):
        own = prefix[4 * i : 4 * i + 4]
        if own:
            head = reduce(lambda a, d: a << BITS | d, own, 0)
            shift = 64 - BITS * len(own)
            # The sign bit is turned around so that the unsigned order is that of the values.
            head = head - (1 << 64) if head >= 1 << 63 else head
            hit = hit & (F.shiftrightunsigned(F.col(name), shift) == head)
    return hit


def discrete_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list]:
    """The least value of each column that at least the wanted share of its values do not exceed,
    as SQL's ``percentile_disc``.  NULL is no value; a column without any gives ``None``."""
    kinds = {c: df.schema[c].dataType for c in columns}
    own = {c: codes(quoted(c), kinds[c]) for c in columns}
    names = {c: [f"c{i}_{j}" for j in range(len(own[c]))] for i, c in enumerate(columns)}
    flipped = [code.bitwiseXOR(F.lit(LEAST)).alias(n) for c in columns for code, n in zip(own[c], names[c])]
    values = df.select(*flipped)
    sizes = values.agg(*[F.count(names[c][0]) for c in columns]).first()
    rows = dict(zip(columns, sizes))
    searches: dict[tuple[str, int], _Search] = {}

    def rank(c: str, p: float) -> int:
        return min(max(ceil(Fraction(str(p)) * rows[c]) - 1, 0), rows[c] - 1)

    for c in columns:
        for p in probabilities if rows[c] else ():
            searches[c, rank(c, p)] = _Search(c, 4 * len(names[c]), rank(c, p))
    while open_ := [s for s in searches.values() if len(s.prefix) < s.width]:
        _descend(values, open_, names)
    return {
        c: [decode(searches[c, rank(c, p)].found, kinds[c]) if rows[c] else None for p in probabilities] for c in columns
    }


def _descend(values: DataFrame, searches: list[_Search], names: dict[str, list[str]]) -> None:
    """One pass: the next digit of every search."""
    shared = list(dict.fromkeys((s.column, s.prefix) for s in searches))
    looks = []
    for i, (column, prefix) in enumerate(shared):
        part, at = divmod(len(prefix), 4)
        digit = F.shiftrightunsigned(F.col(names[column][part]), 64 - BITS * (at + 1)).bitwiseAND((1 << BITS) - 1)
        look = F.struct(F.lit(i).alias("look"), digit.cast("int").alias("digit"))
        looks.append(F.when(_matches(names[column], prefix) & F.col(names[column][0]).isNotNull(), look))
    met = values.select(F.explode(F.filter(F.array(*looks), lambda x: x.isNotNull())).alias("x")).select("x.*")
    counts = met.groupBy("look", "digit").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("look").orderBy("digit"))
    places = [(i, s.place, k) for k, s in enumerate(searches) for i in [shared.index((s.column, s.prefix))]]
    wanted = values.sparkSession.createDataFrame(places, "look int, place long, search int")
    hit = counts.withColumn("upto", upto).join(F.broadcast(wanted), "look")
    hit = hit.filter((F.col("upto") > F.col("place")) & (F.col("upto") - F.col("n") <= F.col("place")))
    for r in hit.select("search", "digit", (F.col("upto") - F.col("n")).alias("below")).collect():
        s = searches[r["search"]]
        s.prefix, s.place = (*s.prefix, r["digit"]), s.place - r["below"]
