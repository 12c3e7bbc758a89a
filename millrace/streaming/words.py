"""Word counting, the same for batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import quoted


def split_words(df: DataFrame, column: str = "value", pattern: str = " ", name: str = "word") -> DataFrame:
    """One row per piece of text between matches of ``pattern``; empty pieces are kept.

    Stateless: every row is handled on its own.
    """
    return df.select(F.explode(F.split(quoted(column), pattern)).alias(name))


def count_words(words: DataFrame, column: str = "word", name: str = "count") -> DataFrame:
    """Rows per word.  Each task counts its own words before the shuffle.

    On a stream the counts are state, kept for every word ever seen: choose the RocksDB
    state store for large vocabularies.
    """
    return words.groupBy(quoted(column).alias(column)).agg(F.count(F.lit(1)).alias(name))
