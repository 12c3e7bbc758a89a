"""Starting and draining streaming queries."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from millrace.workspace import discard, shared_dir


def _writer(df: DataFrame, mode: str, checkpoint: str | None, continuous: bool) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint or shared_dir(df.sparkSession, "stream-state"))
    return writer if continuous else writer.trigger(availableNow=True)


def console_sink(
    df: DataFrame, mode: str = "complete", checkpoint: str | None = None, continuous: bool = True
) -> StreamingQuery:
    """Print every result; runs until stopped."""
    return _writer(df, mode, checkpoint, continuous).format("console").start()


def memory_sink(
    df: DataFrame, name: str, mode: str = "complete", checkpoint: str | None = None, continuous: bool = False
) -> StreamingQuery:
    """Keep the result as table ``name`` in the driver: only for small results."""
    return _writer(df, mode, checkpoint, continuous).format("memory").queryName(name).start()


def files_sink(
    df: DataFrame, path: str, checkpoint: str | None = None, continuous: bool = False
) -> StreamingQuery:
    """Append rows to a Parquet data set, exactly once."""
    return _writer(df, "append", checkpoint, continuous).format("parquet").start(path)


def complete_to_files(
    df: DataFrame, path: str, checkpoint: str | None = None, continuous: bool = False
) -> StreamingQuery:
    """Replace a Parquet data set by the complete result of every trigger.

    Written by the executors, so that the result may outgrow the driver; a trigger
    that is run again overwrites its own output.
    """

    def replace(result: DataFrame, batch: int) -> None:
        result.write.mode("overwrite").parquet(path)

    return _writer(df, "complete", checkpoint, continuous).foreachBatch(replace).start()


PUBLISHED = "batch long, folder string"


def publish_complete(
    df: DataFrame, path: str, checkpoint: str | None = None, continuous: bool = False, keep: int = 2
) -> StreamingQuery:
    """Keep the complete result of the last triggers, for readers who must never see half of one.

    Every trigger writes a folder of its own, and then enters it, with the number of its batch, in
    a list of published results.  A reader (see ``read_published``) sees the last one entered, so
    one that is being written, or was left behind by a trigger that failed and ran again,
    does no harm.  Results older than the last ``keep`` are emptied.
    """

    def publish(result: DataFrame, batch: int) -> None:
        spark, folder = result.sparkSession, f"{path}/results/{batch}-{uuid.uuid4().hex}"
        result.write.parquet(folder)
        entry = spark.createDataFrame([(batch, folder)], PUBLISHED)
        entry.coalesce(1).write.mode("append").parquet(f"{path}/published")
        discard(spark, *(r["folder"] for r in published(spark, path) if r["batch"] == batch - keep))

    return _writer(df, "complete", checkpoint, continuous).foreachBatch(publish).start()


def published(spark: SparkSession, path: str) -> list[Row]:
    """The list of published results, ``batch`` and ``folder``; one row for each trigger."""
    try:
        return spark.read.schema(PUBLISHED).parquet(f"{path}/published").orderBy("batch", "folder").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_published(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The last result that was published whole; no rows before the first."""
    rows = published(spark, path)
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(next(r["folder"] for r in rows if r["batch"] == rows[-1]["batch"]))


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a stopped aggregation has in its state: its keys and running values."""
    return spark.read.format("statestore").load(checkpoint).select("key.*", "value.*")


def drain(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait until a query over the available data ends; errors are raised."""
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise TimeoutError("the stream did not end in time")
    finally:
        query.stop()
    return query
