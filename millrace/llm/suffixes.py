"""Byte strings that occur twice, found with suffix arrays built by linear grouping.

A window of ``width`` bytes is owned by its *anchor*, the least hashed gram in it, so equal
windows have equal anchors.  Of what a window holds beside the gram, half lies on one side of
it; gram and half together are the window's *core*.  Windows in a row with the same core in
the same place are one context of text.  Contexts that are equal as a whole (128-bit hashes)
repeat in every window.  Where one core has several different contexts, one of each goes to a
block, and the block's suffix array brings equal windows together, where they are compared
byte by byte.

The suffix array is built by grouping: suffixes are grouped by their longest
Lyndon prefix, groups are taken in descending order, every member finds the nearest earlier
suffix of a smaller group (its previous-smaller pointer), and the suffixes so pointed at are
moved behind their group, those with most pointers last.  A second pass emits the order of
each group along the same pointers; nothing is renamed and there is no recursion.  As all
contexts of a block hold the same core, it counts as a single symbol, and the bytes on both
sides of it are taken in chunks, counted from the core, of one symbol each.

Cores with more contexts than a block holds are spread over pairs of blocks, so that any
two contexts meet in one task of bounded size.

Defined cases: a null or empty text has no bytes; null ids, and different texts under
one id, are documents of their own; a row repeated with id and text is one document, listed
twice; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from . import textkit as tk
from .frames import keyed
from .near import runs

#: Contexts of one core (each shorter than two windows) in a block; two blocks meet in a task.
BLOCK = 1024
#: Bytes that make one symbol of a suffix array.
CHUNK = 8
ANCHORS = "g bigint, _k bigint, _h bigint, pos int, lo int, hi int, c1 bigint, c2 bigint"
CONTEXTS = "g bigint, n bigint, blocks int, _k bigint, _h bigint, lo int, at int, body binary"
KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Suffixes of ``symbols`` (all at least 1) in order; the end counts as least."""
    text = [*symbols, 0]
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    group, ends, before = [0] * n, [0] * (n + 1), [-1] * n
    place = [0] * n
    for i, s in enumerate(order):
        place[s] = i
        group[s] = i if not i or text[order[i - 1]] != text[s] else group[order[i - 1]]
        ends[group[s]] = i + 1
    top = n
    while top:
        start = group[order[top - 1]]
        pointed: dict[int, int] = {}
        for s in sorted(order[start:top]) if top - start > 1 else order[start:top]:
            j = s - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[s] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if len(pointed) == 1:
            moves = [list(pointed)]
        else:
            by_count: dict[int, list[int]] = {}
            for j, times in pointed.items():
                by_count.setdefault(times, []).append(j)
            moves = [by_count[times] for times in sorted(by_count, reverse=True)]
        for same in moves:
            tails: dict[int, int] = {}
            for j in same:
                old = group[j]
                tail = tails.get(old, ends[old]) - 1
                tails[old] = tail
                other, at = order[tail], place[j]
                order[tail], order[at] = j, other
                place[j], place[other] = tail, at
            for j in same:
                group[j] = tails[group[j]] if place[j] >= tails.get(group[j], n) else group[j]
            for old, tail in tails.items():
                if tail != old:
                    ends[tail], ends[old] = ends[old], tail
        top = start
    out, heads, placed = [-1] * n, {}, [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            at = heads.get(g, g)
            out[at], heads[g], placed[s] = s, at + 1, True
            s = before[s]
    return out[1:]


def _gram(width: int) -> int:
    return width // 3


def _half(width: int) -> int:
    return (width - _gram(width) + 1) // 2


def _core(width: int) -> int:
    return _gram(width) + _half(width)


def _anchors(width: int) -> Callable:
    gram, half, core = _gram(width), _half(width), _core(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h = (batch.column(c).to_numpy() for c in ("_k", "_h"))
            for part in tk.slices(batch.column("text")):
                rows, n = part.offsets, len(part.data) - width + 1
                at = np.flatnonzero(tk.inside(rows, width, n))
                if not len(at):
                    continue
                sums = tk.prefix_sums(part.data)
                starts = np.arange(len(part.data) - gram + 1)
                grams = tk.span_hash(sums, starts, starts + gram)
                least = tk.minimizers(grams, width - gram + 1)[at]
                left = at <= least - half
                least = np.where(left, least - half, least)
                first = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (left[1:] != left[:-1])])
                lo, hi, pos = at[first], at[np.r_[first[1:], len(at)] - 1], least[first]
                row = tk.repeat_rows(rows, lo)
                g = tk.mix(tk.span_hash(sums, pos, pos + core) + left[first].astype(tk.U64))
                place = ((pos - lo).astype(tk.U64) << tk.U64(32)) + (hi - lo).astype(tk.U64)
                c1 = tk.mix(tk.span_hash(sums, lo, hi + width) ^ tk.mix(place + tk.U64(1)))
                c2 = _second(part.data, lo, hi + width)
                columns = [tk.signed(g), pa.array(k[part.first + row]), pa.array(h[part.first + row])]
                columns += [pa.array((x - rows[row]).astype(np.int32)) for x in (pos, lo, hi)]
                yield pa.RecordBatch.from_arrays([*columns, tk.signed(c1), tk.signed(c2)], names=[c.split()[0] for c in ANCHORS.split(", ")])

    return run


def _second(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """An independent 64-bit hash of byte ranges."""
    whole = data.tobytes()
    digests = (hashlib.blake2b(whole[a:b], digest_size=8).digest() for a, b in zip(starts.tolist(), ends.tolist()))
    return np.frombuffer(b"".join(digests), np.uint64)


def _contexts(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, k, h, wanted in zip(*(batch.column(c) for c in ("text", "_k", "_h", "wanted"))):
                raw, k, h = text.as_py().encode(), k.as_py(), h.as_py()
                for w in wanted.as_py():
                    body = raw[w["lo"] : w["hi"] + width]
                    out.append((w["g"], w["n"], w["blocks"], k, h, w["lo"], w["pos"] - w["lo"], body))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in CONTEXTS.split(", ")])

    return run


def repeated_windows(bodies: Sequence[bytes], places: Sequence[int], width: int) -> list[list[int]]:
    """For each context the starts of its windows that another place of the block repeats.
    Every body holds the same core at its place, and every window of it holds the core."""
    core, chunk = _core(width), CHUNK
    numbers: dict[bytes, int] = defaultdict(lambda: len(numbers) + 3)
    symbols: list[int] = []
    owner: list[tuple[int, int]] = []
    for i, (body, at) in enumerate(zip(bodies, places)):
        behind = at + core
        symbols += [numbers[body[a : a + chunk]] for a in range(at % chunk, at, chunk)]
        symbols.append(2)
        symbols += [numbers[body[a : a + chunk]] for a in range(behind, len(body) - chunk + 1, chunk)]
        symbols.append(1)
        owner += [(i, c) for c in range(at % chunk, at + 1, chunk)]
        owner += [(-1, 0)] * (len(symbols) - len(owner))
    out: list[list[int]] = [[] for _ in bodies]
    together: list[tuple[int, int]] = []
    sure = b""
    for s in suffix_array(symbols):
        i, c = owner[s]
        if i < 0:
            continue
        # the whole chunks that all windows beginning in the chunk before c have in common
        behind = places[i] + core
        own = bodies[i][c : behind + max(c - chunk + 1 + width - behind, 0) // chunk * chunk]
        if own != sure:
            _compare(together, bodies, width, out)
            together, sure = [], own
        together.append((i, c))
    _compare(together, bodies, width, out)
    return out


def _compare(together: list[tuple[int, int]], bodies: Sequence[bytes], width: int, out: list[list[int]]) -> None:
    """Of suffixes that begin alike, mark the windows beginning in the chunk before that are equal."""
    if len(together) < 2:
        return
    for back in range(CHUNK):
        own = [(i, c - back) for i, c in together if 0 <= c - back <= len(bodies[i]) - width]
        windows = [bodies[i][a : a + width] for i, a in own]
        times = Counter(windows)
        for (i, a), window in zip(own, windows):
            if times[window] > 1:
                out[i].append(a)


def _sorted_out(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["g", "ci", "cj"]):
            rows = list({(r["_k"], r["_h"], r["lo"]): r for r in group.to_pylist()}.values())
            if len(rows) < 2 or all(r["n"] > 1 for r in rows):
                continue
            found = repeated_windows([r["body"] for r in rows], [r["at"] for r in rows], width)
            spans = []
            for r, starts in zip(rows, found):
                places = np.sort(np.array(starts, np.int64))
                if len(places):
                    cut = np.flatnonzero(np.r_[True, np.diff(places) > 1])
                    ends = places[np.r_[cut[1:], len(places)] - 1] + width
                    spans += [(r["_k"], r["_h"], r["lo"] + a, r["lo"] + b) for a, b in zip(places[cut].tolist(), ends.tolist())]
            if spans:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*spans), kinds)], names=["_k", "_h", "a", "b"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for part in tk.slices(batch.column("text")):
            for i in range(len(part)):
                text = part.text(i)
                own = tk.list_column(batch.column("spans"), part.first + i)
                n_removed = n_spans = 0
                if own is not None:
                    steps = np.zeros(len(text) + 1, np.int32)
                    np.add.at(steps, own.field("a").to_numpy(), 1)
                    np.add.at(steps, own.field("b").to_numpy(), -1)
                    gone = np.cumsum(steps[:-1]) > 0
                    n_removed = int(gone.sum())
                    n_spans = int(np.count_nonzero(np.diff(np.r_[0, gone.astype(np.int8)]) > 0))
                    text = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((int(part.offsets[i + 1] - part.offsets[i]), n_removed, n_spans, hashlib.sha256(text).hexdigest(), text))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=[c.split()[0] for c in KEPT.split(", ")])


def remove_repeated_bytes(docs: DataFrame, width: int = 400) -> DataFrame:
    """One row per document: its bytes, how many lie in a string of ``width`` bytes that also
    starts elsewhere, in how many runs, and the rest with its SHA-256."""
    base = keyed(docs)
    rows = base.select("text", "_k", "_h").mapInArrow(_anchors(width), ANCHORS)
    place = F.struct(F.xxhash64("_k", "_h", "lo").alias("id"), "_k", "_h", "pos", "lo", "hi")
    classes = rows.groupBy("g", "c1", "c2").agg(F.min(place).alias("r"), F.max(place["id"]).alias("last"))
    classes = classes.withColumn("n", F.when(F.col("r.id") < F.col("last"), 2).otherwise(1).cast("bigint"))
    classes = stage(classes.drop("last"), "classes")
    twice = rows.join(classes.filter("n > 1").select("g", "c1", "c2"), ["g", "c1", "c2"], "left_semi")
    whole = twice.select("_k", "_h", F.col("lo").alias("a"), (F.col("hi") + width).alias("b"))
    several = classes.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least")).filter("size > 1 and least = 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    wanted = classes.join(several.select("g", blocks), "g").select("g", "n", "blocks", "r.*").drop("id")
    wanted = wanted.groupBy("_k", "_h").agg(F.collect_list(F.struct("g", "n", "blocks", "pos", "lo", "hi")).alias("wanted"))
    texts = base.select("doc_id", "text", "_k", "_h")
    found = texts.join(wanted, ["_k", "_h"]).mapInArrow(_contexts(width), CONTEXTS)
    own, other = F.pmod(F.xxhash64("_k", "_h", "lo"), F.col("blocks")).cast("int"), F.col("j")
    grid = found.withColumn("own", own).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grid = grid.select("g", F.least("own", other).alias("ci"), F.greatest("own", other).alias("cj"), "n", "_k", "_h", "lo", "at", "body")
    parted = (
        grid.repartition("g", "ci", "cj")
        .sortWithinPartitions("g", "ci", "cj", "_k", "_h", "lo")
        .mapInArrow(_sorted_out(width), "_k bigint, _h bigint, a int, b int")
    )
    spans = whole.unionAll(parted).groupBy("_k", "_h").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    return texts.join(spans, ["_k", "_h"], "left").select("doc_id", "text", "spans").mapInArrow(_cut, KEPT)
