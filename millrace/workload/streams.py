"""Streams over the tables' files, and their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.streaming import (
    count_words,
    drain,
    files_sink,
    publish_complete,
    read_published,
    read_state,
    replay_table,
    split_words,
    stream_tables,
)
from millrace.workload.registry import query, table
from millrace.workspace import shared_dir

WORDS = "SELECT w AS word, count(*) AS row_count FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1"
EVENTS = ["event_id", "user_id", "event_type", "value"]


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, be it one file or a directory of files."""
    schema = table(spark, sf_dir, name).schema
    return stream_tables(spark, f"{sf_dir.rstrip('/')}/{name}.parquet*", "*.parquet", schema)


def _written(stream: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(stream.sparkSession, purpose)
    drain(files_sink(stream, path))
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


@query("word_count", WORDS)
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_words(split_words(table(spark, sf_dir, "documents"), "text"), name="row_count")


@query("stream_word_count", WORDS)
def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_words(split_words(_stream(spark, sf_dir, "documents"), "text"), name="row_count")
    path = shared_dir(spark, "word-counts")
    drain(publish_complete(counts, path))
    return read_published(spark, path, "word string, row_count bigint")


@query("stream_restart", WORDS.replace("FROM documents", "FROM conversations"))
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that stop after half of the files and go on from their state when the others are there;
    told from the state itself."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "text")
    source, state, path = (shared_dir(spark, name) for name in ("arrivals", "counting", "word-counts"))
    for half in (0, 1):
        rows.filter(F.pmod(F.xxhash64("conv_id"), F.lit(2)) == half).write.mode("append").parquet(source)
        words = split_words(stream_tables(spark, source, "*.parquet", rows.schema, files_per_trigger=2), "text")
        drain(publish_complete(count_words(words, name="row_count"), path, state))
    return read_state(spark, state).select("word", F.col("count").alias("row_count"))


@query("stream_stateless", "SELECT unnest(string_split(text, ' ')) AS word FROM conversations")
def stream_stateless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(split_words(_stream(spark, sf_dir, "conversations"), "text"), "words")


@query("stream_file_source", "SELECT event_id, user_id, event_type, value FROM events")
def stream_file_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(_stream(spark, sf_dir, "events").select(EVENTS), "events")


@query("stream_simulated_source", "SELECT event_type, count(*) AS row_count FROM events GROUP BY 1")
def stream_simulated_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replayed file by file, counted with state kept between the triggers."""
    replayed = replay_table(table(spark, sf_dir, "events").select("event_id", "event_type"))
    counts = replayed.groupBy("event_type").agg(F.count(F.lit(1)).alias("row_count"))
    path = shared_dir(spark, "event-counts")
    drain(publish_complete(counts, path))
    return read_published(spark, path, "event_type string, row_count bigint")
