"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact sets.

1. A document's set is its distinct word shingles.  Documents with equal sets are one
   class and go on as one row.
2. Bands of the class's signature are bucket keys.  In every bucket each member is
   paired with the least member: a star, however large the bucket.
3. Pairs are compared batch by batch of the signature.  With a uniform prior, the
   similarity after m matches in n is Beta(m + 1, n - m + 1); a pair goes as soon as its
   chance of reaching the threshold is under ``miss``.
4. Survivors are confirmed on their full sets, and confirmed links joined to components.
5. Buckets that still hold several components are compared all against all inside the
   tasks, in blocks of bounded size, across components only; what survives the same
   pruning is confirmed on the spot, and a link makes two components one for the rest of
   the block.  So pairs are never written, and a block gives fewer links than members.

Defined cases: a null or empty text has no shingles and is linked with nothing; a text
with fewer words than a shingle is one shingle; null ids come before all others, and a
component that holds one has a null id; repeated rows share class and component; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from . import textkit as tk
from .components import components
from .frames import LEAST, keyed

BATCH = 16
#: Members of a bucket that meet in one task, in the all-against-all step.
BLOCK = 512
U64 = np.uint64


@dataclass(frozen=True)
class Near:
    """Shingle length in words, threshold as a fraction ``num / den``, signature length,
    the chance to lose a pair at the threshold in banding, and that of one comparison."""

    shingle: int = 5
    num: int = 80
    den: int = 100
    hashes: int = 128
    band_miss: float = 1e-6
    miss: float = 1e-6

    @cached_property
    def rows(self) -> int:
        """Hashes in a band: as many as the allowed loss permits."""
        t = self.num / self.den
        fine = [r for r in range(1, 9) if (1 - t**r) ** (self.hashes // r) <= self.band_miss]
        return max(fine, default=1)

    @cached_property
    def least_matches(self) -> list[int]:
        """For each number of batches compared, the fewest matches that keep a pair."""
        t, out = self.num / self.den, []
        for n in range(BATCH, self.hashes + 1, BATCH):
            total, m = 0.0, -1
            while total < self.miss:
                m += 1
                total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            out.append(m)
        return out


def shingle_sets(part: tk.Slice, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a slice."""
    _, _, rows, words = part.words(lower=True)
    windows, out = tk.window_hash(words, size), []
    for i in range(len(part)):
        a, b = int(rows[i]), int(rows[i + 1])
        if b - a >= size:
            out.append(np.unique(windows[a : b - size + 1]))
        elif b > a:
            out.append(tk.window_hash(words[a:b], b - a))
        else:
            out.append(np.zeros(0, U64))
    return out


def _families(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(0, 2**63, n, dtype=U64) * U64(2) + U64(1), rng.integers(0, 2**63, n, dtype=U64)


def signature(values: np.ndarray, hashes: int) -> np.ndarray:
    """16 bits of the least hash under each of ``hashes`` functions."""
    factors, shifts = _families(hashes)
    best = np.full(hashes, 2**64 - 1, U64)
    for at in range(0, len(values), 4096):
        some = values[at : at + 4096, None]
        np.minimum(best, ((some ^ shifts) * factors).min(axis=0), out=best)
    return (tk.mix(best) & U64(0xFFFF)).astype(np.uint16)


SIGNED = "doc_id bigint, _k bigint, _h bigint, n bigint, s1 bigint, s2 bigint, sig binary"


def _sign(conf: Near) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, sig = [], [], [], []
            for part in tk.slices(batch.column("text")):
                for values in shingle_sets(part, conf.shingle):
                    n.append(len(values))
                    s1.append(tk.mix(values + U64(1)).sum(dtype=U64))
                    s2.append(tk.mix(values ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64))
                    sig.append(signature(values, conf.hashes).tobytes() if len(values) else None)
            hashes = [tk.signed(np.array(s, U64)) for s in (s1, s2)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "_k", "_h")), pa.array(n, pa.int64()), *hashes, pa.array(sig, pa.binary())],
                names=["doc_id", "_k", "_h", "n", "s1", "s2", "sig"],
            )

    return run


def _bands(conf: Near) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_bands = conf.hashes // conf.rows
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            sigs = _matrix(batch.column("sig"), conf.hashes)[:, : n_bands * conf.rows]
            keys = np.zeros((len(node), n_bands), U64)
            for r in range(conf.rows):
                keys = tk.mix(keys * U64(0x9E3779B97F4A7C15) + sigs[:, r :: conf.rows].astype(U64) + U64(1))
            keys = tk.mix(keys + np.arange(n_bands, dtype=U64))
            yield pa.RecordBatch.from_arrays(
                [tk.signed(keys.ravel()), pa.array(np.repeat(node, n_bands))], names=["key", "node"]
            )

    return run


def _matrix(sigs: pa.Array, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.to_pylist()), np.uint16).reshape(-1, hashes)


def alive(a: np.ndarray, b: np.ndarray, conf: Near) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (signatures) survive the sequential comparison."""
    left = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for i, least in enumerate(conf.least_matches):
        at = slice(i * BATCH, (i + 1) * BATCH)
        matches[left] += (a[left, at] == b[left, at]).sum(axis=1)
        left = left[matches[left] >= least]
        if not len(left):
            break
    return left


def _prune(conf: Near) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_matrix(batch.column(c), conf.hashes) for c in ("sig", "pivot_sig"))
                yield batch.select(["a", "b"]).take(pa.array(alive(a, b, conf)))

    return run


def _similar(x: np.ndarray, y: np.ndarray, conf: Near) -> bool:
    if not conf.den * min(len(x), len(y)) >= conf.num * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return conf.den * shared >= conf.num * (len(x) + len(y) - shared)


def _confirm(conf: Near) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for name in ("ta", "tb"):
                sets.append([s for part in tk.slices(batch.column(name)) for s in shingle_sets(part, conf.shingle)])
            linked = []
            for x, y in zip(*sets):
                linked.append(_similar(x, y, conf))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows that agree in ``names``, whole, from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy() for n in names]
        cut = np.zeros(batch.num_rows, bool)
        for c in columns:
            cut[1:] |= c[1:] != c[:-1]
        fresh = bool(held) and any(held[-1].column(n)[-1].as_py() != c[0] for n, c in zip(names, columns))
        bounds = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if held and (i or fresh):
                yield held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _across(conf: Near) -> Callable:
    """Confirmed links of a block between different components, each pair of components
    joined at most once: what survives the pruning is checked on full sets at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["key", "ci", "cj"]):
            node, label = group.column("node").to_numpy(), group.column("label").to_numpy().copy()
            sigs, text = _matrix(group.column("sig"), conf.hashes), group.column("text")
            sets: dict[int, np.ndarray] = {}

            def full(i: int) -> np.ndarray:
                if i not in sets:
                    (sets[i],) = (s for part in tk.slices(text.slice(i, 1)) for s in shingle_sets(part, conf.shingle))
                return sets[i]

            links: list[tuple[int, int]] = []
            for i in range(len(node) - 1):
                other = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
                if not len(other):
                    continue
                near = other[alive(np.broadcast_to(sigs[i], (len(other), conf.hashes)), sigs[other], conf)]
                for j in near.tolist():
                    if label[j] != label[i] and _similar(full(i), full(j), conf):
                        links.append((node[i], node[j]))
                        label[label == label[j]] = label[i]
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _linked(pairs: DataFrame, reps: DataFrame, base: DataFrame, conf: Near) -> DataFrame:
    """Those of ``pairs`` (a, b: classes) whose full sets are similar enough, staged."""
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    place = lambda c: reps.select(F.col("node").alias(c), F.col("_k").alias(f"k{c}"), F.col("_h").alias(f"h{c}"))
    placed = stage(pairs.join(place("a"), "a").join(place("b"), "b"), "pairs")
    text = base.select("_k", "_h", "text")
    for c in "ab":
        own = text.toDF(f"k{c}", f"h{c}", f"t{c}")
        placed = placed.join(own, [f"k{c}", f"h{c}"])
    return stage(placed.select("a", "b", "ta", "tb").mapInArrow(_confirm(conf), "a bigint, b bigint"), "confirmed")


def _grouped(docs: DataFrame, conf: Near) -> DataFrame:
    """Every document with its key and the least key its component holds, as ``least, least_h``."""
    base = keyed(docs)
    every = stage(base.mapInArrow(_sign(conf), SIGNED), "signatures")
    reps = (
        every.filter("n > 0")
        .groupBy("s1", "s2")
        .agg(F.min(F.struct("_k", "_h", "sig")).alias("r"))
        .select(F.col("s1").alias("node"), "r._k", "r._h", "r.sig")
    )
    reps = stage(reps, "classes")
    bands = reps.select("node", "sig").mapInArrow(_bands(conf), "key bigint, node bigint")
    pivots = bands.groupBy("key").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stage(bands.join(pivots, "key"), "buckets")
    stars = members.filter("node > b").select(F.col("node").alias("a"), "b").distinct()
    signed = (
        stars.join(reps.select(F.col("node").alias("a"), "sig"), "a")
        .join(reps.select(F.col("node").alias("b"), F.col("sig").alias("pivot_sig")), "b")
        .mapInArrow(_prune(conf), "a bigint, b bigint")
    )
    first = _linked(signed, reps, base, conf)
    labels = components(first)
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own, other = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.col("j")
    grid = (
        labelled.join(open_.select("key"), "key", "left_semi")
        .withColumn("blocks", blocks)
        .select("key", "node", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
        .select("key", "node", "label", F.least("own", other).alias("ci"), F.greatest("own", other).alias("cj"))
        .join(reps.select("node", "sig", "_k", "_h"), "node")
        .join(base.select("_k", "_h", "text"), ["_k", "_h"])
        .select("key", "ci", "cj", "node", "label", "sig", "text")
    )
    across = (
        grid.repartition("key", "ci", "cj")
        .sortWithinPartitions("key", "ci", "cj", "node")
        .mapInArrow(_across(conf), "a bigint, b bigint")
    )
    final = components(first.unionAll(stage(across, "confirmed")))
    own = F.struct("_k", "_h")
    least = (
        reps.join(final, "node")
        .groupBy("label")
        .agg(F.min(own).alias("least"))
        .join(final, "label")
        .select(F.col("node").alias("s1"), "least")
    )
    alone = reps.select(F.col("node").alias("s1"), own.alias("rep"))
    joined = every.drop("sig").join(alone, "s1", "left").join(least, "s1", "left")
    head = F.coalesce("least", "rep", own)
    return joined.select("doc_id", "_k", "_h", "n", head["_k"].alias("least"), head["_h"].alias("least_h"))


def near_duplicates(docs: DataFrame, conf: Near = Near()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id it can reach), kept."""
    component = F.when(F.col("least") != LEAST, F.col("least")).alias("component_id")
    found = _grouped(docs, conf).select("doc_id", F.col("n").alias("n_shingles"), component)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, conf: Near = Near()) -> DataFrame:
    """One row of each component, unchanged: of the least id, and under one id of the least
    hash of the text.  Of rows that agree in both any one stays."""
    own = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c: own[i] for i, c in enumerate(docs.columns)}
    key = F.coalesce(F.col(at["doc_id"]).cast("bigint"), F.lit(LEAST))
    inner = docs.toDF(*own).withColumns({"_k": key, "_h": F.xxhash64(F.coalesce(F.col(at["text"]), F.lit("")))})
    kept = _grouped(docs, conf).filter("_k = least and _h = least_h").select("_k", "_h")
    left = inner.join(kept, ["_k", "_h"], "left_semi")
    return left.dropDuplicates(["_k", "_h"]).select(*own).toDF(*docs.columns)
