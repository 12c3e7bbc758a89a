"""SimHash fingerprints, and all fingerprints within a Hamming radius.

Terms are runs of ``shingle`` words (the whole text if it is shorter), weighted by one plus
the logarithm of their count.  Each term's hash votes on every bit of the fingerprint with its
weight.  Likeness is the cosine that the share of differing bits stands for, not below 0.

Fingerprints within radius r are found with permuted block tables: the bits are cut into
r + 2 blocks; whatever r bits differ, two blocks are equal; so there is one table for each
pair of blocks, keyed by their bits.  A pair is confirmed on all bits, in blocks of bounded
size inside the tasks, which give only the links that join components.

Defined cases: a null or empty text has no terms, and its fingerprint has no bit set; ids
are ordered with null first, texts under one id by a hash; the next document of the last is the
first; a repeated row counts as one more document; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from . import textkit as tk
from .components import components
from .frames import LEAST, keyed, partitions
from .near import runs

BITS = 128
BLOCK = 1024
MARKED = (
    "doc_id bigint, _k bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, part int, first boolean, own string"
)
U64 = np.uint64


def fingerprint(text: bytes, shingle: int) -> int:
    (part,) = tk.slices(pa.array([text], pa.large_binary()))
    words = part.words()[3]
    if not len(words):
        return 0
    terms, counts = np.unique(tk.window_hash(words, min(shingle, len(words))), return_counts=True)
    wide = np.stack([tk.mix(terms + U64(1)), tk.mix(terms ^ U64(0x5851F42D4C957F2D))], axis=1)
    bits = np.unpackbits(wide.view(np.uint8), axis=1).astype(np.float32)
    weights = (1 + np.log(counts)).astype(np.float32)
    votes = weights @ (2 * bits - 1)
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def likeness(a: int, b: int) -> float:
    return max(0.0, float(np.cos(np.pi * (a ^ b).bit_count() / BITS)))


def _row(doc: tuple, following: tuple, shingle: int) -> tuple:
    """Results of one document, given the next one: (doc_id, k, text, fingerprint)."""
    text, other = doc[2], following[2]
    cut = len(text) // 3
    edited = (text[: len(text) - cut] + other[:cut]).encode()
    mark = fingerprint(edited, shingle)
    own = [f"{x:0{BITS // 4}x}" for x in (doc[3], mark)]
    return (doc[0], doc[1], len(text), hashlib.sha256(edited).hexdigest(), *own, likeness(doc[3], mark), likeness(doc[3], following[3]))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(), pa.string()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 11, kinds)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in MARKED.split(", ")])


def _mark(shingle: int) -> Callable:
    """Walks a sorted partition; its first and last documents also go out whole, since
    the one before the first, and the one after the last, are in other partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            rows: list[tuple] = []
            for doc, k, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "_k", "text"))):
                now = (doc, k, text, fingerprint(text.encode(), shingle))
                if last is None:
                    rows.append((doc, k, *[None] * 6, part, True, text))
                else:
                    rows.append((*_row(last, now, shingle), None, None, None))
                last = now
            yield _batch(rows)
        if last is not None:
            yield _batch([(last[0], last[1], *[None] * 6, part, False, last[2])])

    return run


def _meet(shingle: int) -> Callable:
    """The last document of a partition and the first of the next, as adjacent rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in runs(batches, ["pair"]):
            a, b = ((r["doc_id"], r["_k"], r["own"], fingerprint(r["own"].encode(), shingle)) for r in pair.to_pylist())
            yield _batch([(*_row(a, b, shingle), None, None, None)])

    return run


def fingerprints(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """Per document its fingerprint, that of its text with the last third of the characters
    replaced by the beginning of the next document, and how alike these are."""
    spark, base = docs.sparkSession, keyed(docs)
    order = [F.col("_k").desc(), F.col("_h").desc()]
    spread = base.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    marked = stage(spread.select("doc_id", "_k", "text").mapInArrow(_mark(shingle), MARKED), "marked")
    edges = marked.filter("part is not null")
    # One number per partition that holds rows: bounded by the number of partitions.
    parts = [r.part for r in edges.filter("first").select("part").orderBy("part").collect()]
    pairs = [(p, False, i) for i, p in enumerate(parts)] + [(p, True, (i - 1) % len(parts)) for i, p in enumerate(parts)]
    numbered = edges.join(F.broadcast(spark.createDataFrame(pairs, "part int, first boolean, pair int")), ["part", "first"])
    met = (
        numbered.repartition(max(1, min(len(parts), partitions(spark))), "pair")
        .sortWithinPartitions("pair", "first")
        .select("pair", "doc_id", "_k", "own")
        .mapInArrow(_meet(shingle), MARKED)
    )
    return marked.filter("part is null").unionAll(met).drop("part", "first", "own")


def _tables(radius: int) -> Callable:
    n_blocks = radius + 2
    edges = [BITS * i // n_blocks for i in range(n_blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes = [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("fingerprint").to_pylist()):
                value = int(text, 16)
                for t, (a, b) in enumerate(combinations(masks, 2)):
                    own = (value & (a | b)).to_bytes(BITS // 8, "big") + bytes([t])
                    keys.append(int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "big", signed=True))
                    nodes.append(node)
            marks = np.repeat(np.array(batch.column("fingerprint").to_pylist(), object), n_blocks * (n_blocks - 1) // 2)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(nodes, pa.int64()), pa.array(marks, pa.string())], names=["key", "node", "fingerprint"])

    return run


def _within(radius: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["key", "ci", "cj"]):
            if group.num_rows < 2:
                continue
            node = group.column("node").to_numpy()
            wide = np.frombuffer(bytes.fromhex("".join(group.column("fingerprint").to_pylist())), np.uint8).reshape(-1, BITS // 8)
            wide = np.ascontiguousarray(wide).view(U64)
            label, links = np.arange(len(node)), []
            for i in range(len(node) - 1):
                far = np.bitwise_count(wide[i + 1 :] ^ wide[i]).sum(axis=1)
                for j in (i + 1 + np.flatnonzero((far <= radius) & (label[i + 1 :] != label[i]))).tolist():
                    if label[j] != label[i]:
                        links.append((node[i], node[j]))
                        label[label == label[j]] = label[i]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

    return run


def within_radius(marks: DataFrame, radius: int = 3) -> DataFrame:
    """(fingerprint, group): distinct fingerprints, and the least id of a document that
    is reached over steps of at most ``radius`` bits."""
    distinct = marks.groupBy("fingerprint").agg(F.min("_k").alias("least")).withColumn("node", F.xxhash64("fingerprint"))
    distinct = stage(distinct, "fingerprints")
    rows = distinct.select("node", "fingerprint").mapInArrow(_tables(radius), "key bigint, node bigint, fingerprint string")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own, other = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.col("j")
    grid = (
        rows.join(sizes, "key")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", other).alias("ci"), F.greatest("own", other).alias("cj"), "node", "fingerprint")
    )
    sorted_ = grid.repartition("key", "ci", "cj").sortWithinPartitions("key", "ci", "cj", "node")
    labels = components(stage(sorted_.mapInArrow(_within(radius), "a bigint, b bigint"), "links"))
    named = distinct.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("least").alias("group"))
    return named.join(least, "label").select("fingerprint", "group")


def report(docs: DataFrame, shingle: int = 5, radius: int = 3) -> DataFrame:
    """``fingerprints`` with near_group: the least id within steps of ``radius`` bits."""
    marks = fingerprints(docs, shingle)
    groups = within_radius(marks, radius)
    near = F.when(F.col("group") != LEAST, F.col("group")).alias("near_group")
    return marks.join(groups, "fingerprint").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", near
    )
