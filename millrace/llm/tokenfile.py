"""Token ids in files: one zstandard frame per document under a shared dictionary.

A store is a folder of three Parquet tables, written by Spark and so readable on any
storage:

* ``dictionary``: the dictionary's bytes, their SHA-256, and the width of an id in bytes;
* ``shards``: runs of documents in ascending order; frames end to end, and the hash of
  the dictionary they need;
* ``index``: for each document its shard, where its frame begins and ends there, its number
  of ids, and the number of ids of all documents before it.

A document is read by one lookup in the index and one slice of one shard.  The dictionary
is trained on a bounded sample of documents (``sample_docs``); it changes how small
the files are, never what they hold.

Defined cases: a null or empty text is its end id alone; null ids come first, then
ascending ids, texts under one id ordered by a hash; repeated rows are stored twice; an
empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import stage
from . import textkit as tk
from .frames import keyed, ranged
from .tokens import encoder

SHARD_BYTES = 1 << 20
STORED = (
    "part int, shard int, dictionary string, payload binary, "
    "docs array<struct<doc_id:bigint,begin:bigint,end:bigint,n_tokens:bigint,before:bigint>>"
)
ENTRY = pa.struct([(c, pa.int64()) for c in ("doc_id", "begin", "end", "n_tokens", "before")])


def _encode(path: str, cut: str, end_id: int, width: int, dictionary: bytes | None) -> Callable:
    """Documents as serialised ids, compressed if there is a dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3, dict_data=_loaded(dictionary)) if dictionary is not None else None
        for batch in batches:
            for part in tk.slices(batch.column("text")):
                texts = batch.column("text").slice(part.first, len(part)).to_pylist()
                frames, counts = [], []
                for ids in encoder(path, cut).encode(texts):
                    raw = np.append(ids, np.uint32(end_id)).astype(f"<u{width}").tobytes()
                    counts.append(len(ids) + 1)
                    frames.append(packer.compress(raw) if packer else raw)
                own = batch.slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in ("doc_id", "_k", "_h")), pa.array(counts, pa.int64()), pa.array(frames, pa.binary())],
                    names=["doc_id", "_k", "_h", "n_tokens", "frame"],
                )

    return run


@lru_cache(maxsize=4)
def _loaded(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _train(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = [f for batch in batches for f in batch.column("frame").to_pylist()]
        try:
            trained = zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
        except zstandard.ZstdError:  # too little to learn from
            trained = b""
        yield pa.RecordBatch.from_arrays([pa.array([trained], pa.binary())], names=["dictionary"])

    return run


def _shards(hash_: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        frames: list[bytes] = []
        docs: list[dict] = []
        at = 0

        def close() -> pa.RecordBatch:
            columns = [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([hash_]), pa.array([b"".join(frames)])]
            return pa.RecordBatch.from_arrays([*columns, pa.array([docs], pa.list_(ENTRY))], names=["part", "shard", "dictionary", "payload", "docs"])

        for batch in batches:
            for doc, n, frame in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame"))):
                if frames and at + len(frame) > SHARD_BYTES:
                    yield close()
                    frames, docs, at, shard = [], [], 0, shard + 1
                docs.append({"doc_id": doc, "begin": at, "end": at + len(frame), "n_tokens": n, "before": before})
                frames.append(frame)
                at += len(frame)
                before += n
        if frames:
            yield close()

    return run


def write_store(
    docs: DataFrame, folder: str, path: str, cut: str = "byte", end_id: int = 2, sample_docs: int = 2000, dictionary_bytes: int = 64 << 10
) -> None:
    """Encode ``docs`` and write the store to ``folder``."""
    base, spark = keyed(docs), docs.sparkSession
    width = 2 if encoder(path, cut).tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    coded = "doc_id bigint, _k bigint, _h bigint, n_tokens bigint, frame binary"
    share = min(1.0, 2 * sample_docs / max(1, docs.count()))
    some = base.filter(F.pmod(F.xxhash64("_k", "_h"), F.lit(1_000_003)) <= int(share * 1_000_003)).limit(sample_docs)
    raw = some.coalesce(1).mapInArrow(_encode(path, cut, end_id, width, None), coded)
    trained = raw.select("frame").mapInArrow(_train(dictionary_bytes), "dictionary binary").first()
    dictionary = bytes(trained.dictionary) if trained else b""
    hash_ = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(hash_, dictionary, width)], "hash string, bytes binary, width int").coalesce(1).write.parquet(f"{folder}/dictionary")
    # Texts, not frames, are put in order: finding the ranges would else encode all a second time.
    frames = ranged(base, "_k", "_h").mapInArrow(_encode(path, cut, end_id, width, dictionary), coded)
    shards = frames.mapInArrow(_shards(hash_), STORED)
    staged = stage(shards, "shards")
    # Where each part's ids begin: one row per task that wrote, so a few thousand at most.
    sizes = staged.select("part", F.explode("docs").alias("d")).groupBy("part").agg(F.sum("d.n_tokens").alias("n")).orderBy("part").collect()
    begins = np.cumsum([0, *(r.n for r in sizes)]).tolist()
    starts = spark.createDataFrame([(r.part, b) for r, b in zip(sizes, begins)], "part int, first bigint")
    staged.drop("docs").write.parquet(f"{folder}/shards")
    index = staged.select("part", "shard", F.explode("docs").alias("d")).join(F.broadcast(starts), "part")
    index.select("d.doc_id", "part", "shard", "d.begin", "d.end", "d.n_tokens", (F.col("d.before") + F.col("first")).alias("start")).write.parquet(f"{folder}/index")


def _digest(dictionaries: dict[str, tuple[bytes, int]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dictionary, width = dictionaries[row["dictionary"]]
                opened = zstandard.ZstdDecompressor(dict_data=_loaded(dictionary))
                crcs, kept = [], []
                for d in row["docs"]:
                    raw = opened.decompress(row["payload"][d["begin"] : d["end"]])
                    ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                    if len(ids) != d["n_tokens"]:
                        raise ValueError(f"document {d['doc_id']}: {len(ids)} ids, {d['n_tokens']} in the index")
                    crcs.append(zlib.crc32(ids.tobytes()))
                    kept.append(d)
                columns = [[d["doc_id"] for d in kept], [d["start"] for d in kept], [d["n_tokens"] for d in kept], crcs]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def _opened(spark: SparkSession, folder: str) -> dict[str, tuple[bytes, int]]:
    return {r.hash: (bytes(r.bytes), r.width) for r in spark.read.parquet(f"{folder}/dictionary").collect()}


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from its frame."""
    entry = F.struct("doc_id", "begin", "end", "n_tokens", "start")
    index = spark.read.parquet(f"{folder}/index").groupBy("part", "shard").agg(F.collect_list(entry).alias("docs"))
    shards = spark.read.parquet(f"{folder}/shards").join(index, ["part", "shard"])
    columns = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return shards.select("dictionary", "payload", "docs").mapInArrow(_digest(_opened(spark, folder)), columns)


def read_ids(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each, if the id is repeated), read by its offsets."""
    found = spark.read.parquet(f"{folder}/index").filter(F.col("doc_id") == doc_id)
    shards = spark.read.parquet(f"{folder}/shards").join(found, ["part", "shard"])
    frame = F.expr("substring(payload, int(begin) + 1, int(end - begin))")
    out, known = [], _opened(spark, folder)
    for row in shards.select("dictionary", frame.alias("frame"), "start").orderBy("start").collect():
        dictionary, width = known[row.dictionary]
        raw = zstandard.ZstdDecompressor(dict_data=_loaded(dictionary)).decompress(bytes(row.frame))
        out.append(np.frombuffer(raw, f"<u{width}").tolist())
    return out
