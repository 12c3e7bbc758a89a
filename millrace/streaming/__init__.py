"""Structured Streaming sources, transformations and sinks."""

from millrace.streaming.sinks import (
    complete_to_files,
    console_sink,
    drain,
    files_sink,
    memory_sink,
    publish_complete,
    published,
    read_published,
    read_state,
)
from millrace.streaming.sources import open_stream, replay_table, stream_tables
from millrace.streaming.words import count_words, split_words

__all__ = [
    "complete_to_files", "console_sink", "count_words", "drain", "files_sink", "memory_sink", "open_stream",
    "publish_complete", "published", "read_published", "read_state", "replay_table", "split_words", "stream_tables",
]
