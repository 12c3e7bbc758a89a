"""What the operators share on the DataFrame side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import SHUFFLE_CLEANUP, discard, freed_shuffles, shared_dir  # noqa: F401

LEAST = -(2**63)


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, text (null: empty) and the key ``_k, _h`` that orders and joins documents.

    ``_k`` is the id (a null id comes before all others), ``_h`` a hash of the text, which
    tells apart different texts under one id.  Rows that agree in both are one document
    listed twice, and get equal results.  Columns other than ``more`` are left behind, so
    that none can clash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *more,
        text.alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)).alias("_k"),
        F.xxhash64(text).alias("_h"),
    )


class Scratch:
    """Written tables of one job; each is deleted as soon as nothing reads it any more.  Those named
    in ``packed``, which hold texts, are written in about two thirds of the usual space."""

    def __init__(self, spark: SparkSession, packed: tuple[str, ...] = ()):
        self.spark = spark
        self.packed = packed
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and continue from the written table; an older one of the same name goes."""
        path = shared_dir(self.spark, name)
        with freed_shuffles(self.spark):
            df.write.options(**({"compression": "zstd"} if name in self.packed else {})).parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete these tables; nothing lazy may still read them."""
        discard(self.spark, *(self.paths.pop(n) for n in names if n in self.paths))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranged(df: DataFrame, *columns: str) -> DataFrame:
    """Sorted by ``columns`` across partitions; a frequent first column spreads over many."""
    return df.repartitionByRange(partitions(df.sparkSession), *columns).sortWithinPartitions(*columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, which every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)
