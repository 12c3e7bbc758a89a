"""Where intermediate tables live.

Spark jobs that lose executors must be able to re-read what earlier jobs produced,
so intermediate results go to the folder the cluster shares (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Learned tables within both limits are embedded in the plan; larger ones stay files.
EMBED_ROWS = 10_000
EMBED_BYTES = 8 << 20
#: Learned tables within this measured size may be broadcast.
BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing path for ``purpose`` below the shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/millrace/{purpose}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries inside delete their shuffle files as they end; else these stay until the driver
    collects garbage.  The session's own setting is put back."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once and continue from the written table (cuts the lineage)."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """A staged table that is deleted on leaving; nothing lazy may outlive it."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        discard(df.sparkSession, path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Free the space of written tables, wherever they lie: each is overwritten by no rows."""
    for path in paths:
        spark.createDataFrame([], "gone int").coalesce(1).write.mode("overwrite").parquet(path)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows, and their size as text, which bounds what a broadcast of them would hold."""
    size = F.octet_length(F.to_json(F.struct("*"))).cast("bigint")
    rows, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows, total or 0


@dataclass(frozen=True)
class FittedTable:
    """A learned lookup table together with its measured rows and bytes."""

    table: DataFrame
    rows: int
    size: int

    @property
    def embeds(self) -> bool:
        return self.rows <= EMBED_ROWS and self.size <= EMBED_BYTES


def freeze(df: DataFrame, purpose: str, like: FittedTable | None = None) -> FittedTable:
    """Evaluate a learned table once, and find out how large it is.

    It is staged, and measured where it lies.  If small, it then becomes a local relation
    inside the plans that use it.  A table derived row by row from one that is known
    to be small (``like``) is fetched without staging.
    """
    if like is not None and like.embeds:
        return FittedTable(_embedded(df), like.rows, like.size)
    table = stage(df, purpose)
    found = FittedTable(table, *measure(table))
    return replace(found, table=_embedded(table)) if found.embeds else found


def _embedded(small: DataFrame) -> DataFrame:
    return small.sparkSession.createDataFrame(small.toArrow(), schema=small.schema)
