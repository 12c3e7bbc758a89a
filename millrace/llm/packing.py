"""Vector bin packing of token sequences by the dot-product heuristic.

An item has a size in three dimensions: tokens, segments (one) and loss-bearing tokens.  A
bin has a limit in each.  The bin being filled takes, of all items that fit, the one whose
size has the largest dot product with the room that is left, each dimension weighted by its
total demand; so scarce dimensions count most.  Documents longer than a bin give full bins
first.  A bin that no item fills is topped up by cutting one more, and the last bin
of a task is cut into powers of two, which need no padding.

All tokens but the first of a piece bear loss; no mask or role is read.  With the default limits
the limit of loss follows from that of tokens; only a lower one binds.

Each task packs its own documents in groups of bounded size, so nothing is shuffled, and
only the last bin of a task can be short.  A sequence's id holds the partition and a running
number; it depends on how the input is split into tasks, and a task run again gives the same.

Defined cases: a null or empty text is its end token alone; rows with a null or a
repeated id are documents like any other; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .tokens import encoder

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, loss_tokens bigint"
)
#: Tokens that a task holds before it packs them.
GROUP_TOKENS = 1 << 20
#: Documents that may wait in one group.
GROUP_ITEMS = 4096


@dataclass(frozen=True)
class Limits:
    """Of one sequence: tokens, segments, and tokens that bear loss."""

    tokens: int = 2048
    segments: int = 512
    loss: int = 2047


@dataclass
class Piece:
    """A run of one document's tokens.  Its first token is predicted from nothing, so it
    bears no loss."""

    item: int
    start: int
    length: int

    @property
    def loss(self) -> int:
        return self.length - 1


def dot_product_bins(lengths: np.ndarray, limits: Limits) -> tuple[list[list[Piece]], list[list[Piece]]]:
    """Whole items of given lengths as (full bins, bins with room)."""
    full, short = [], []
    rest: list[Piece] = []
    for i, n in enumerate(lengths.tolist()):
        whole = n // limits.tokens if limits.loss >= limits.tokens - 1 else 0
        full += [[Piece(i, j * limits.tokens, limits.tokens)] for j in range(whole)]
        if n % limits.tokens or not whole:
            rest.append(Piece(i, whole * limits.tokens, n - whole * limits.tokens))
    size = np.array([(p.length, 1, p.loss) for p in rest], float).reshape(-1, 3)
    most = np.array([limits.tokens, limits.segments, limits.loss], float)
    share = size / most
    weights = share.sum(axis=0)
    order = np.argsort(-share.max(axis=1), kind="stable") if len(rest) else np.zeros(0, int)
    rest, size, share = [rest[i] for i in order], size[order], share[order] * weights / max(1e-9, weights.max())
    free = np.ones(len(rest), bool)
    left = len(rest)
    while left:
        room, bin_ = most.copy(), []
        while True:
            fits = free & (size <= room).all(axis=1)
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, share @ (room / most), -1.0)))
            bin_.append(rest[best])
            room -= size[best]
            free[best] = False
            left -= 1
        if not bin_:  # over the limit of loss alone
            best = int(np.flatnonzero(free)[0])
            piece, cut = rest[best], min(limits.tokens, limits.loss + 1)
            bin_, rest[best] = [Piece(piece.item, piece.start, cut)], Piece(piece.item, piece.start + cut, piece.length - cut)
            size[best] -= (cut, 0, cut)
            room -= (cut, 1, cut - 1)
        (full if not room[0] else short).append(bin_)
    return full, short


def top_up(bins: list[list[Piece]], limits: Limits) -> tuple[list[list[Piece]], list[list[Piece]]]:
    """Fill bins with room by cutting pieces out of the emptiest ones."""
    bins = sorted(bins, key=lambda b: -sum(p.length for p in b))
    done: list[list[Piece]] = []
    lo, hi = 0, len(bins) - 1
    while lo < hi:
        bin_, give = bins[lo], bins[hi]
        room = limits.tokens - sum(p.length for p in bin_)
        spare = limits.loss - sum(p.loss for p in bin_)
        if not room or len(bin_) >= limits.segments or spare < 0:
            done.append(bin_)
            lo += 1
            continue
        piece = give[-1]
        cut = min(piece.length, room, spare + 1)
        bin_.append(Piece(piece.item, piece.start, cut))
        if cut == piece.length:
            give.pop()
            hi -= not give
        else:
            give[-1] = Piece(piece.item, piece.start + cut, piece.length - cut)
    return done, [b for b in bins[lo : hi + 1] if b]


def in_powers(bin_: list[Piece], limits: Limits) -> Iterator[list[Piece]]:
    """A short bin as bins whose lengths are powers of two."""
    queue = list(reversed(bin_))
    left = sum(p.length for p in queue)
    while left:
        want = 1 << (left.bit_length() - 1)
        own: list[Piece] = []
        while want:
            piece = queue.pop()
            cut = min(piece.length, want)
            own.append(Piece(piece.item, piece.start, cut))
            if cut < piece.length:
                queue.append(Piece(piece.item, piece.start + cut, piece.length - cut))
            want -= cut
            left -= cut
        yield own


def _pack(path: str, cut: str, end_id: int, limits: Limits) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        held = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, waiting, held
            full, short = dot_product_bins(np.array([len(ids) for _, ids, _ in waiting], np.int64), limits)
            more, short = top_up(short, limits)
            bins = full + more
            keep: list[tuple] = []
            for bin_ in short:
                if last:
                    bins += in_powers(bin_, limits)
                else:
                    keep += [(waiting[p.item], p) for p in bin_]
            rows = []
            for bin_ in bins:
                at = 0
                for p in bin_:
                    doc, ids, (start, total) = waiting[p.item]
                    own = ids[p.start : p.start + p.length]
                    rows.append((doc, start + p.start, p.length, zlib.crc32(own.astype("<u4").tobytes()), total, sequence, at, p.loss))
                    at += p.length
                sequence += 1
            waiting = [(doc, ids[p.start : p.start + p.length], (start + p.start, total)) for (doc, ids, (start, total)), p in keep]
            held = sum(len(ids) for _, ids, _ in waiting)
            names = [f.split()[0] for f in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 8)], names=names)

        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for part in tk.slices(batch.column("text")):
                texts = batch.column("text").slice(part.first, len(part)).to_pylist()
                for i, ids in enumerate(encoder(path, cut).encode(texts)):
                    ids = np.append(ids, np.uint32(end_id))
                    waiting.append((docs[part.first + i], ids, (0, len(ids))))
                    held += len(ids)
                    if held >= GROUP_TOKENS or len(waiting) >= GROUP_ITEMS:
                        yield from flush(False)
        if waiting:
            yield from flush(True)

    return run


def pack(docs: DataFrame, path: str, cut: str = "word", end_id: int = 1, limits: Limits = Limits()) -> DataFrame:
    """One row per piece: its document and place there, its sequence and place there, the
    CRC-32 of its ids as little-endian 32-bit integers, and its loss-bearing tokens."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return plain.mapInArrow(_pack(path, cut, end_id, limits), PIECES)
