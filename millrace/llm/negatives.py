"""Hard negatives: scores by Strassen products of integer tiles, kept in mergeable heaps.

Rows become vectors of ``floor(256 * x)``.  Anchors are the rows whose id is divisible by
``Mining.every``; they are dealt to groups, and groups meet every tile of rows.  One group's
anchors times one tile's rows is a matrix of scores, computed in 64-bit integers by Strassen's
recursion: both sides are padded with zeros to even sizes, seven half-size products and
integer additions replace eight products, and small products are plain ones.  Integer
arithmetic is exact (and, beyond 64 bits, exact modulo 2^64), so the recursion changes nothing.

Two passes, for the window of a negative depends on a positive's score:

1. Each anchor's heap of its best ``positives`` rows with its label.  A task keeps one heap an
   anchor over all tiles that it sees; heaps of different tasks merge by taking the best again.
2. Each anchor and positive's heap of the best ``negatives`` rows with another label whose
   score lies in the window, merged likewise.

Groups hold ``GROUP`` anchors at most and tiles ``TILE`` rows, so memory does not grow with the
table; an anchor group is shipped to as many tasks as share its tiles, and every tile to each
group.  The number of score computations is that of the stated searches: anchors times rows.

Defined cases: rows without id, label or vector, or with a null or non-finite component take
no part; a shorter vector is continued by zeros, so an empty one scores 0; components beyond
64 bits after scaling take the nearest value; an anchor's positives and negatives are rows
with another id; repeated rows are rows like any other, each with results and places of
its own; an empty table, or one without anchors, gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage
from .frames import partitions

#: Anchors of a group and rows of a tile.
GROUP, TILE = 8192, 4096
#: Anchors and rows whose scores are held at once.
BLOCK = 1024
#: Products with a side up to this length are plain ones.
LEAF = 8


@dataclass(frozen=True)
class Mining:
    """Which rows are anchors, how many positives and negatives they get, and the window of a
    negative's score in hundredths of the positive's."""

    every: int = 50
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b)[:m, :n]
    i, j, h = m // 2, n // 2, k // 2
    a11, a12, a21, a22 = a[:i, :h], a[:i, h:], a[i:, :h], a[i:, h:]
    b11, b12, b21, b22 = b[:h, :j], b[:h, j:], b[h:, :j], b[h:, j:]
    both = strassen(a11 + a22, b11 + b22)
    lower = strassen(a21 + a22, b11)
    right = strassen(a11, b12 - b22)
    left = strassen(a22, b21 - b11)
    upper = strassen(a11 + a12, b22)
    out = np.empty((m, n), np.int64)
    out[:i, :j] = both + left - upper + strassen(a12 - a22, b21 + b22)
    out[:i, j:] = right + upper
    out[i:, :j] = lower + left
    out[i:, j:] = both - lower + right + strassen(a21 - a11, b11 + b12)
    return out


def best_first(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of each owner's first ``most`` entries: higher scores first, then smaller ids."""
    order = np.lexsort((ids, ~score, owner))
    own = owner[order]
    begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(begins, np.diff(np.r_[begins, len(own)]))
    return order[rank < most]


class Heaps:
    """The best entries of each owner so far, and the score that a full heap asks for."""

    def __init__(self, owners: int, most: int):
        self.most = most
        self.owner, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(owners, np.iinfo(np.int64).min)

    def merge(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(owner):
            return
        owner, score, ids = (np.concatenate(x) for x in ((self.owner, owner), (self.score, score), (self.ids, ids)))
        keep = best_first(owner, score, ids, self.most)
        self.owner, self.score, self.ids = owner[keep], score[keep], ids[keep]
        last = np.flatnonzero(np.r_[self.owner[1:] != self.owner[:-1], True])
        size = np.diff(np.r_[-1, last])
        full = last[size == self.most]
        self.least[self.owner[full]] = self.score[full]


def rows_of(vectors: DataFrame) -> DataFrame:
    """vec_id, label (moved for every seventh id) and scaled vector of the rows that take part."""
    own = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.col("embedding").alias("vec")
    ).filter("vec_id is not null and label is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform("vec", lambda x: F.floor(x.cast("double") * 256.0).cast("bigint"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return own.filter(F.coalesce(finite, F.lit(False))).select("vec_id", moved.alias("label"), scaled.alias("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal width from lists of any length, continued by zeros."""
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    width = int(lengths.max()) if len(lengths) else 0
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _tiles(most: int, extra: list[str]) -> Callable:
    """Runs of up to ``most`` rows (within one group, if rows have one) as one row of bytes:
    ids, labels, vectors, and further whole-number list columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group, count = 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held, count
            if held:
                table = pa.Table.from_batches(held)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_table(table)
                yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["g", "tile"])
                held, count = [], 0

        for batch in batches:
            groups = batch.column("g").to_numpy() if "g" in batch.schema.names else np.zeros(batch.num_rows, np.int32)
            own = batch.select(["vec_id", "label", "vec", *extra])
            at = 0
            while at < batch.num_rows:
                if count and groups[at] != group:
                    yield from close()
                group = int(groups[at])
                same = int(np.argmax(np.r_[groups[at:] != group, True]))
                n = min(same, most - count)
                held.append(own.slice(at, n))
                at, count = at + n, count + n
                if count == most:
                    yield from close()
        yield from close()

    return run


def _open(tile: bytes) -> pa.Table:
    return pa.ipc.open_stream(tile).read_all().combine_chunks()


def _blocks(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Scores of all rows of ``a`` with all of ``b``, block by block, with the block's place."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    for j in range(0, len(b), BLOCK):
        right = np.ascontiguousarray(b[j : j + BLOCK].T)
        for i in range(0, len(a), BLOCK):
            yield i, j, strassen(a[i : i + BLOCK], right)


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def _search(found: Callable, result: Callable) -> Callable:
    """Over rows (g, anchors, tile), sorted by g: fold every tile of a group into its heaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors, state = None, None, None
        for batch in batches:
            for g, s, tile, rows in zip(*(batch.column(c) for c in ("g", "anchor_no", "anchors", "tile"))):
                if (g.as_py(), s.as_py()) != key:
                    if state is not None:
                        yield result(anchors, state)
                    key, anchors, state = (g.as_py(), s.as_py()), _open(tile.as_buffer()), {}
                    state["left"] = _matrix(_column(anchors, "vec"))
                table = _open(rows.as_buffer())
                found(anchors, state, table, _blocks(state["left"], _matrix(_column(table, "vec"))))
        if state is not None:
            yield result(anchors, state)

    return run


def _positives(conf: Mining) -> tuple[Callable, Callable]:
    def found(anchors: pa.Table, state: dict, rows: pa.Table, blocks: Iterator) -> None:
        own, own_label = (anchors.column(c).to_numpy() for c in ("vec_id", "label"))
        ids, label = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
        heaps = state.setdefault("heaps", Heaps(len(own), conf.positives))
        for i, j, score in blocks:
            a, b = slice(i, i + BLOCK), slice(j, j + BLOCK)
            fit = (score >= heaps.least[a, None]) & (own_label[a, None] == label[b]) & (own[a, None] != ids[b])
            x, y = np.nonzero(fit)
            heaps.merge(x + i, score[x, y], ids[j + y])

    def result(anchors: pa.Table, state: dict) -> pa.RecordBatch:
        heaps = state["heaps"]
        columns = [anchors.column("a").to_numpy()[heaps.owner], heaps.ids, heaps.score]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "positive_id", "positive_score"])

    return found, result


def window(score: int, conf: Mining) -> tuple[int, int]:
    """Least and largest score of a negative, in whole numbers."""
    return -(-conf.low * score // 100), conf.high * score // 100


def _negatives(conf: Mining) -> tuple[Callable, Callable]:
    def found(anchors: pa.Table, state: dict, rows: pa.Table, blocks: Iterator) -> None:
        own_label = anchors.column("label").to_numpy()
        if "heaps" not in state:
            scores = [s or [] for s in anchors.column("positive_scores").to_pylist()]
            state["bounds"] = np.full((len(own_label), conf.positives, 2), (1, 0), np.int64)
            for n, some in enumerate(scores):
                for k, s in enumerate(some):
                    state["bounds"][n, k] = window(s, conf)
            state["heaps"] = [Heaps(len(own_label), conf.negatives) for _ in range(conf.positives)]
        ids, label = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
        lowest, highest = (np.array([least(x) for x in state["bounds"]]) for least in (_lowest, _highest))
        for i, j, score in blocks:
            a, b = slice(i, i + BLOCK), slice(j, j + BLOCK)
            x, y = np.nonzero((score >= lowest[a, None]) & (score <= highest[a, None]) & (own_label[a, None] != label[b]))
            s, other = score[x, y], ids[j + y]
            x += i
            for k, heaps in enumerate(state["heaps"]):
                low, high = state["bounds"][x, k, 0], state["bounds"][x, k, 1]
                fit = (s >= low) & (s <= high) & (s >= heaps.least[x])
                heaps.merge(x[fit], s[fit], other[fit])

    def result(anchors: pa.Table, state: dict) -> pa.RecordBatch:
        a = anchors.column("a").to_numpy()
        columns: list[list] = [[], [], [], []]
        for k, heaps in enumerate(state["heaps"]):
            for column, values in zip(columns, (a[heaps.owner], np.full(len(heaps.owner), k), heaps.ids, heaps.score)):
                column.append(values)
        arrays = [pa.array(np.concatenate(c), pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "k", "negative_id", "negative_score"])

    return found, result


def _lowest(bounds: np.ndarray) -> int:
    open_ = bounds[bounds[:, 0] <= bounds[:, 1]]
    return int(open_[:, 0].min()) if len(open_) else 1


def _highest(bounds: np.ndarray) -> int:
    open_ = bounds[bounds[:, 0] <= bounds[:, 1]]
    return int(open_[:, 1].max()) if len(open_) else 0


def _met(anchors: DataFrame, groups: int, tiles: DataFrame, extra: list[str], shares: int) -> DataFrame:
    """Every anchor group with every tile of rows; a group's tiles are shared by tasks."""
    own = anchors.repartition(groups, "g").sortWithinPartitions("g").mapInArrow(_tiles(GROUP, extra), "g int, tile binary")
    own = own.select("g", F.xxhash64("tile").alias("anchor_no"), F.col("tile").alias("anchors"))
    own = own.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    other = tiles.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return own.join(other, ["g", "s"]).sortWithinPartitions("g", "anchor_no").select("g", "anchor_no", "anchors", "tile")


def mine(vectors: DataFrame, conf: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = rows_of(vectors)
    spark = vectors.sparkSession
    chosen = rows.filter(F.col("vec_id") % conf.every == 0)
    groups = max(1, ceil(chosen.count() / GROUP))
    anchors = chosen.repartition(groups).select(
        F.monotonically_increasing_id().alias("a"), F.spark_partition_id().alias("g"), "vec_id", "label", "vec"
    )
    anchors = stage(anchors, "anchors")
    tiles = stage(rows.mapInArrow(_tiles(TILE, []), "g int, tile binary").select("tile"), "tiles")
    shares = max(1, min(partitions(spark) // groups, tiles.count()))
    tiles = tiles.select(F.pmod(F.xxhash64("tile"), F.lit(shares)).cast("int").alias("s"), "tile")

    found, result = _positives(conf)
    partial = _met(anchors, groups, tiles, ["a"], shares).mapInArrow(_search(found, result), "a bigint, positive_id bigint, positive_score bigint")
    heap = _first(partial, ["a"], "positive_score", "positive_id", conf.positives)
    entry = F.struct(F.col("place"), F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    positives = heap.groupBy("a").agg(F.sort_array(F.collect_list(entry)).alias("p"))
    held = stage(anchors.join(positives, "a"), "positives")

    found, result = _negatives(conf)
    asked = held.select("a", "g", "vec_id", "label", "vec", F.col("p.score").alias("positive_scores"))
    partial = _met(asked, groups, tiles, ["a", "positive_scores"], shares).mapInArrow(
        _search(found, result), "a bigint, k bigint, negative_id bigint, negative_score bigint"
    )
    heap = _first(partial, ["a", "k"], "negative_score", "negative_id", conf.negatives)
    named = heap.join(held.select("a", F.col("vec_id").alias("anchor_id"), F.posexplode("p").alias("k", "p")), ["a", "k"])
    return named.select(
        "anchor_id", F.col("p.id").alias("positive_id"), F.col("place").alias("rank"), "negative_id",
        F.col("p.score").alias("positive_score"), "negative_score",
    )


def _first(partial: DataFrame, owner: list[str], score: str, ids: str, most: int) -> DataFrame:
    """Merge heaps: the first ``most`` entries of each owner, with their place from 1."""
    order: list[Column] = [F.col(score).desc(), F.col(ids)]
    placed = partial.withColumn("place", F.row_number().over(Window.partitionBy(*owner).orderBy(*order)))
    return placed.filter(F.col("place") <= most)
