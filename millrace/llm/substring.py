"""Removal of repeated word windows by relative Lempel-Ziv parsing.

Every document is factored against the text that comes before it.  The reference is
indexed by *anchors*: the least hashed gram of every window (its minimizer), so that any
two equal windows share an anchor at the same distance.  The index is one sorted run of
all anchors, dealt in blocks over the cluster; each document meets every block that
holds one of its anchors, and learns for each anchor the occurrence just before it.

Parsing walks a document's anchors from left to right.  As grams are longer than the
gaps between them, consecutive anchors whose earlier occurrences lie on one diagonal of
one document are a verbatim copy; the greedy factor is the longest such run.  Only the occurrence
just before in the index is followed, so a factor ends where that one changes, though another
earlier text may go on; factors are not the longest over all references.  A factor of
at least one window is a duplicate span.  Windows that straddle factor boundaries, and
the originals, are checked exactly: those with a repeated anchor that no factor covers are
compared by 128-bit hashes, and all but the first of each are removed.  A window inside a
factor has an earlier equal one, and so on down to one that is in no factor; hence the
first occurrence of every repeated window takes part in that check.

Defined cases: a null text has no words; a null id comes before all others; texts under
one id are ordered by a hash of the text, and repeated rows are one document; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .frames import keyed, ranged

ANCHORS = "g bigint, _k bigint, _h bigint, pos int"
REFS = "_k bigint, _h bigint, pos int, rpos int, rk bigint, rh bigint"
WINDOWS = "g bigint, _k bigint, _h bigint, pos int, w1 array<bigint>, w2 array<bigint>"
KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_words_sha256 string"


def _gram(window: int) -> int:
    return window // 2 + 1


def _anchors(window: int) -> Callable:
    gram = _gram(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h = (batch.column(c).to_numpy() for c in ("_k", "_h"))
            for part in tk.slices(batch.column("text")):
                _, _, rows, words = part.words()
                valid = tk.inside(rows, window, len(words) - window + 1)
                if not valid.any():
                    continue
                grams = tk.window_hash(words, gram)
                least = tk.minimizers(grams, window - gram + 1)[: len(valid)][valid]
                places = least[np.r_[True, least[1:] != least[:-1]]]
                row = tk.repeat_rows(rows, places)
                yield pa.RecordBatch.from_arrays(
                    [
                        tk.signed(grams[places]),
                        pa.array(k[part.first + row]),
                        pa.array(h[part.first + row]),
                        pa.array((places - rows[row]).astype(np.int32)),
                    ],
                    names=["g", "_k", "_h", "pos"],
                )

    return run


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted anchors: each repeated one with the occurrence before it, or -1.

    A run at either edge of the partition may go on beyond it; its head counts as
    repeated, and the exact check decides."""
    last: list | None = None  # g, k, h, pos of the row before, and whether it is still to be told
    opened = False
    for batch in batches:
        if not batch.num_rows:
            continue
        g, k, h, pos = (batch.column(i).to_numpy() for i in range(4))
        if last is not None:
            g, k, h, pos = (np.r_[np.array([v], a.dtype), a] for v, a in zip(last[:4], (g, k, h, pos)))
        fresh = np.r_[True, (g[1:] != g[:-1]) | (k[1:] != k[:-1]) | (h[1:] != h[:-1]) | (pos[1:] != pos[:-1])]
        g, k, h, pos = g[fresh], k[fresh], h[fresh], pos[fresh]
        same = np.r_[False, g[1:] == g[:-1]]  # has one before it
        known = last is not None
        tell = same.copy()
        tell[:-1] |= same[1:]
        if not opened:
            tell[0] = True
            opened = True
        if known and last[4]:
            tell[0] = False  # told already
        rpos = np.where(same, np.r_[0, pos[:-1]], -1).astype(np.int32)
        rk, rh = np.r_[0, k[:-1]], np.r_[0, h[:-1]]
        told_last = bool(tell[-1]) or (len(g) == 1 and known and last[4])
        last = [g[-1], k[-1], h[-1], pos[-1], told_last]
        out = [k[tell], h[tell], pos[tell], rpos[tell], rk[tell], rh[tell]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["_k", "_h", "pos", "rpos", "rk", "rh"])
    if last is not None and not last[4]:
        out = [np.array([v], t) for v, t in zip((last[1], last[2], last[3], -1, 0, 0), "q q i i q q".split())]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["_k", "_h", "pos", "rpos", "rk", "rh"])


def _fields(refs: pa.Array) -> list[np.ndarray]:
    return [a.to_numpy() for a in refs.flatten()]


def factors(refs: pa.Array, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy factors of one document, as starts and ends in words."""
    pos, rpos, rk, rh = _fields(refs)
    known = rpos >= 0
    pos, rpos, rk, rh = pos[known], rpos[known], rk[known], rh[known]
    if not len(pos):
        return pos, pos
    cut = np.r_[
        True,
        (rk[1:] != rk[:-1]) | (rh[1:] != rh[:-1]) | (np.diff(pos) != np.diff(rpos)) | (np.diff(pos) > gram),
    ]
    first = np.flatnonzero(cut)
    starts, ends = pos[first], pos[np.r_[first[1:], len(pos)] - 1] + gram
    long = ends - starts >= window
    return starts[long], ends[long]


def _cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def _boundary(window: int) -> Callable:
    gram = _gram(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h, refs = batch.column("_k").to_numpy(), batch.column("_h").to_numpy(), batch.column("refs")
            for part in tk.slices(batch.column("text")):
                _, _, rows, words = part.words()
                n = len(words) - window + 1
                if n < 1:
                    continue
                grams = tk.window_hash(words, gram)
                least = tk.minimizers(grams, window - gram + 1)[:n]
                open_ = np.zeros(n, bool)
                for i in range(len(part)):
                    own = tk.list_column(refs, part.first + i)
                    a, b = rows[i], rows[i + 1] - window + 1
                    if own is None or b <= a:
                        continue
                    repeated = np.zeros(rows[i + 1] - a, bool)
                    repeated[own.field("pos").to_numpy()] = True
                    starts, ends = factors(own, gram, window)
                    open_[a:b] = repeated[least[a:b] - a] & ~_cover(b - a, starts, ends - window + 1)
                at = np.flatnonzero(open_)
                if not len(at):
                    continue
                cut = np.r_[True, (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]])]
                head = np.flatnonzero(cut)
                lists = pa.array(np.r_[head, len(at)].astype(np.int32))
                row = tk.repeat_rows(rows, at[head])
                yield pa.RecordBatch.from_arrays(
                    [
                        tk.signed(grams[least[at[head]]]),
                        pa.array(k[part.first + row]),
                        pa.array(h[part.first + row]),
                        pa.array((at[head] - rows[row]).astype(np.int32)),
                        pa.ListArray.from_arrays(lists, tk.signed(tk.window_hash(words, window, 1)[at])),
                        pa.ListArray.from_arrays(lists, tk.signed(tk.window_hash(words, window, 2)[at])),
                    ],
                    names=["g", "_k", "_h", "pos", "w1", "w2"],
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by anchor those whose anchor another row has too; rows at the
    edges of the partition stay, for their run may go on beyond it."""
    held, held_shared = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        g = whole.column("g").to_numpy()
        same = g[1:] == g[:-1]
        shared = np.r_[held_shared, same]
        shared[:-1] |= same
        held, held_shared = whole.slice(len(g) - 1), bool(shared[-1])
        yield whole.filter(pa.array(shared)).slice(0, int(shared[:-1].sum()))
    if held is not None:
        yield held


def _cut(window: int) -> Callable:
    gram = _gram(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, later = batch.column("refs"), batch.column("later")
            out: list[list] = [[], [], [], []]
            for part in tk.slices(batch.column("text")):
                word_starts, _, rows, _ = part.words()
                for i in range(len(part)):
                    text, n = part.text(i), int(rows[i + 1] - rows[i])
                    gone = np.zeros(n, bool)
                    own = tk.list_column(refs, part.first + i)
                    if own is not None:
                        gone |= _cover(n, *factors(own, gram, window))
                    own = tk.list_column(later, part.first + i)
                    if own is not None:
                        places = own.to_numpy()
                        gone |= _cover(n, places, places + window)
                    split, kept = text.split(), text
                    if gone.any():
                        split = [split[j] for j in np.flatnonzero(~gone)]
                        bounds = np.r_[word_starts[rows[i] : rows[i + 1]] - part.offsets[i], len(text)]
                        keep = np.repeat(np.r_[True, ~gone], np.diff(np.r_[0, bounds]))
                        kept = np.frombuffer(text, np.uint8)[keep].tobytes()
                    for column, value in zip(
                        out, (n, int(gone.sum()), kept, hashlib.sha256(b" ".join(split)).hexdigest())
                    ):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.binary()).cast(pa.string()),
                    pa.array(out[3], pa.string()),
                    batch.column("rest"),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_text", "kept_words_sha256", "rest"],
            )

    return run


def _removed(docs: DataFrame, window: int, rest: Column) -> DataFrame:
    """``remove_repeats`` with a column ``rest`` that goes along."""
    base = keyed(docs, rest.alias("rest"))
    anchors = base.select("text", "_k", "_h").mapInArrow(_anchors(window), ANCHORS)
    links = ranged(anchors, "g", "_k", "_h", "pos").mapInArrow(_link, REFS)
    refs = links.groupBy("_k", "_h").agg(
        F.sort_array(F.collect_list(F.struct("pos", "rpos", "rk", "rh"))).alias("refs")
    )
    parsed = base.join(refs, ["_k", "_h"], "left").select("doc_id", "text", "rest", "_k", "_h", "refs")
    boundary = ranged(parsed.mapInArrow(_boundary(window), WINDOWS), "g", "_k", "_h", "pos")
    both = F.explode(F.arrays_zip(F.sequence(F.lit(0), F.size("w1") - 1).alias("i"), "w1", "w2")).alias("w")
    windows = (
        boundary.mapInArrow(_shared, WINDOWS)
        .select("_k", "_h", "pos", both)
        .select("w.w1", "w.w2", "_k", "_h", (F.col("pos") + F.col("w.i")).alias("pos"))
    )
    at = F.struct("_k", "_h", "pos")
    first = windows.groupBy("w1", "w2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = (
        windows.join(first.drop("n"), ["w1", "w2"])
        .filter(F.col("first") < at)
        .groupBy("_k", "_h")
        .agg(F.collect_list("pos").alias("later"))
    )
    kind = dict(base.dtypes)["rest"]
    return (
        parsed.join(later, ["_k", "_h"], "left")
        .select("doc_id", "text", "rest", "refs", "later")
        .mapInArrow(_cut(window), f"{KEPT}, rest {kind}")
    )


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """One row per document: word counts, the text without repeated windows (the white
    space around kept words stays), and the SHA-256 of the kept words joined by spaces.

    A word goes if a window of ``window`` words that covers it also starts earlier."""
    return _removed(docs, window, F.lit(True)).drop("rest")


def drop_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """The rows and columns of ``docs``; texts that lost words and their n_chars are rewritten."""
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rest = F.struct(*(F.col(c).alias(n) for c, n in place.items() if c != "text"), F.col("text").isNull().alias("void"))
    found, changed = _removed(docs, window, rest), F.col("n_removed") > 0
    new = {c: F.col(f"rest.{n}") for c, n in place.items() if c != "text"}
    new["text"] = F.when(~F.col("rest.void"), F.col("kept_text"))
    if "n_chars" in place:
        length = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, length).otherwise(new["n_chars"])
    return found.select(*(new[c].alias(c) for c in docs.columns))
