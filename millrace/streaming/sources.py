"""Streams from files, sockets, the rate generator, or a replayed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.workspace import measure, shared_dir

#: A replayed table has files of about so many bytes (as text), and this many at least.
REPLAY_BYTES = 64 << 20
REPLAY_FILES = 4


def open_stream(
    spark: SparkSession, format: str, *, schema: T.StructType | None = None, path: str | None = None, **options: object
) -> DataFrame:
    """Any streaming source, e.g. ``open_stream(spark, "socket", host=..., port=...)``."""
    reader = spark.readStream.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def stream_tables(
    spark: SparkSession, directory: str, glob: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """The Parquet files of a directory whose names match ``glob``, as a stream."""
    options: dict[str, object] = {"pathGlobFilter": glob}
    if files_per_trigger is not None:
        options["maxFilesPerTrigger"] = files_per_trigger
    return open_stream(spark, "parquet", schema=schema, path=directory, **options)


def replay_table(df: DataFrame, files: int | None = None, files_per_trigger: int = 1) -> DataFrame:
    """Simulate a stream: the table is written out in files that arrive one trigger
    after another.  Their number follows from the measured size, if it is not given."""
    if files is None:
        files = max(REPLAY_FILES, -(-measure(df)[1] // REPLAY_BYTES))
    path = shared_dir(df.sparkSession, "replay")
    df.repartition(files).write.parquet(path)
    return stream_tables(df.sparkSession, path, "*.parquet", df.schema, files_per_trigger)
