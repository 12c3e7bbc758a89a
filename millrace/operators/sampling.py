"""Sampling and splitting."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import hash_percent, quoted
from millrace.operators.lookup import lookup
from millrace.workspace import FittedTable, freeze

#: Hex digits of the hash that tell bins apart in one pass: 16 ** 4 bins per stratum.
BIN_DIGITS = 4
MD5_DIGITS = 32
#: Rows of a stratum that a single task may sort.
BIN_ROWS = 1_000_000


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Each row with the given chance.  The choice depends on the partitioning; use
    ``sample_by_hash`` where it has to repeat."""
    return df.sample(fraction=fraction, seed=seed)


def sample_by_hash(df: DataFrame, key: str, percent: int) -> DataFrame:
    """The rows whose key hashes into the first ``percent`` of 100; always the same ones."""
    return df.filter(hash_percent(quoted(key)) < percent)


def split_random(df: DataFrame, train_ratio: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Seeded random split; like ``sample_fraction`` it depends on the partitioning."""
    train, test = df.randomSplit([train_ratio, 1 - train_ratio], seed=seed)
    return train, test


def split_by_hash(df: DataFrame, key: str, train_percent: int = 80, output: str = "part") -> DataFrame:
    """Label rows ``train`` or ``test`` by their key alone: a projection, no shuffle."""
    side = F.when(hash_percent(quoted(key)) < train_percent, "train").otherwise("test")
    return df.withColumn(output, side)


def split_stratified(
    df: DataFrame,
    stratum: str,
    key: str,
    train_ratio: float = 0.8,
    output: str = "part",
    rows_per_task: int = BIN_ROWS,
    bin_digits: int = BIN_DIGITS,
) -> DataFrame:
    """Exactly ``floor(train_ratio * rows)`` rows of every stratum become ``train``: those
    first in the order of the MD5 of their (unique) key.

    Nothing is sorted as a whole.  Counts per stratum and next hash digits tell in which bin
    the quota is reached; the bin is searched in the same way while it holds more than
    ``rows_per_task``, then it alone is ordered, to find the last key that still
    belongs to ``train``; labelling the rows is a comparison with that key.
    """
    digest = F.md5(quoted(key).cast("string"))
    keyed = df.select(quoted(stratum).alias("s"), quoted(key).alias("id"), digest.alias("digest"))
    bins = _quota_bins(keyed, None, train_ratio, bin_digits)
    while bins.table.filter((F.col("size") > rows_per_task) & (F.length("prefix") < MD5_DIGITS)).first():
        bins = _quota_bins(keyed, bins, train_ratio, bin_digits)
    place = F.row_number().over(Window.partitionBy("s").orderBy("digest", "id"))
    last_keys = (
        _in_bins(keyed, bins)
        .withColumn("place", place)
        .filter(F.col("place") == F.col("take"))
        .select(F.col("s").alias("stratum"), "n", F.struct("digest", "id").alias("__last"))
    )
    limits = freeze(last_keys, "quota-keys")
    found = lookup(df, limits, {stratum: "stratum"})
    own = F.struct(digest.alias("digest"), quoted(key).alias("id"))
    side = F.when(own <= F.col("__last"), "train").otherwise("test")
    return found.withColumn(output, side).drop("__last")


def _in_bins(keyed: DataFrame, bins: FittedTable) -> DataFrame:
    """The rows in the bin of their stratum."""
    met = lookup(keyed, bins, {"s": "stratum"}, keep_weight=True)
    return met.filter(F.col("digest").startswith(F.col("prefix")))


def _quota_bins(keyed: DataFrame, bins: FittedTable | None, ratio: float, digits: int) -> FittedTable:
    """For each stratum the bin, by ``digits`` more of the hash, in which its quota is reached.

    Table: ``stratum, n`` (its rows), ``prefix`` (the bin), ``size`` (rows in it), ``take`` (how many
    of them the quota needs)."""
    start = [F.lit("").alias("prefix"), F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("take")]
    inside = keyed.select("s", "digest", *start) if bins is None else _in_bins(keyed, bins).drop("size")
    following = F.substring("digest", F.length("prefix") + 1, F.lit(digits))
    sizes = inside.groupBy("s", F.concat("prefix", following).alias("prefix"), "n", "take").agg(F.count(F.lit(1)).alias("size"))
    upto = F.sum("size").over(Window.partitionBy("s").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    running = sizes.withColumn("upto", upto)
    if bins is None:
        running = running.withColumn("n", F.sum("size").over(Window.partitionBy("s")))
        running = running.withColumn("take", F.floor(F.lit(Decimal(str(ratio))) * F.col("n")))
    reached = (F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("size") < F.col("take"))
    rest = (F.col("take") - F.col("upto") + F.col("size")).cast("bigint")
    return freeze(running.filter(reached).select(F.col("s").alias("stratum"), "n", "prefix", "size", rest.alias("take")), "quota-bins")
