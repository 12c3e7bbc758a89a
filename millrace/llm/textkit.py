"""Vectorised text primitives for Arrow batches: words, hashes of windows, minimizers.

All functions work on a slice of documents laid end to end as bytes, so that their cost
per byte is a few array operations.  Hashes depend on the text alone, never on the
process, the batch or the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once; one longer document is a slice of its own.
SLICE_BYTES = 1 << 20
#: Bits of a minimizer's key that hold its place in the slice.
PLACE_BITS = U64(28)
PLACE_MASK = U64((1 << 28) - 1)

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_TABLE = np.random.Generator(np.random.PCG64(20250)).integers(1, 2**64, 256, dtype=U64, endpoint=False) | U64(1)
_STEP = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS[kind]
    if len(have) < n:
        step = U64(_STEP) if kind == "up" else U64(pow(_STEP, -1, 1 << 64))
        size = max(n, 2 * len(have))
        steps = np.full(size, step, U64)
        steps[0] = 1
        have = _POWERS[kind] = np.multiply.accumulate(steps)
    return have[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` reads the hash of any byte range."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_TABLE[data] * _powers("up", len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, equal for equal bytes wherever they lie."""
    down = _powers("down", len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


class Slice:
    """Consecutive rows of a batch: their bytes end to end, and where each begins."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def words(self, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, the first word of each row (one more at the
        end), and the words' hashes; ``lower`` folds A-Z first."""
        data = self.data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        black = ~_WHITE[data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        begin, end = black.copy(), black.copy()
        begin[1:] &= ~black[:-1] | edge[1:n]
        end[:-1] &= ~black[1:] | edge[1:n]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        rows = np.searchsorted(starts, self.offsets)
        return starts, ends, rows, span_hash(prefix_sums(data), starts, ends)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a column of strings without nulls into slices of about ``limit`` bytes."""
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = raw[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        stop = min(max(stop, at + 1), len(column))
        own = offsets[at : stop + 1]
        yield Slice(at, data[own[0] : own[-1]], own - own[0])
        at = stop


def window_hash(items: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``width`` consecutive items, by doubling; windows that run over a
    row's end are the caller's to drop."""
    factor = U64((0x2545F4914F6CDD1D + 2 * seed * 0x9E3779B97F4A7C15) & (2**64 - 1) | 1)
    if len(items) < width:
        return np.zeros(0, U64)

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = (a ^ (a >> U64(29))) * factor + b
        return x ^ (x >> U64(32))

    power, size, out, covered = items, 1, None, 0
    while True:
        if width & size:
            if out is None:
                out = power
            else:
                n = min(len(out), len(power) - covered)
                out = join(out[:n], power[covered : covered + n])
            covered += size
        if covered == width:
            return mix(out[: len(items) - width + 1] + U64(width))
        power = join(power[:-size], power[size:])
        size *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` grams the place of its least gram, leftmost if tied.

    The choice depends on what the window holds and on nothing around it, so equal
    windows choose the same gram at the same distance."""
    place = np.arange(len(grams), dtype=U64)
    keys = (grams >> PLACE_BITS << PLACE_BITS) | place
    return (sliding_min(keys, width) & PLACE_MASK).astype(np.int64)


def inside(rows: np.ndarray, width: int, count: int) -> np.ndarray:
    """Which of ``count`` windows of ``width`` items lie inside one row."""
    ok = np.zeros(max(count, 0), bool)
    steps = np.zeros(len(ok) + 1, np.int32)
    long = rows[1:] - rows[:-1] >= width
    np.add.at(steps, rows[:-1][long], 1)
    np.add.at(steps, rows[1:][long] - width + 1, -1)
    if len(ok):
        ok[:] = np.cumsum(steps[:-1]) > 0
    return ok


def repeat_rows(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The row that each place belongs to."""
    return np.searchsorted(rows, places, "right") - 1


def signed(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's bigint."""
    return pa.array(values.view(np.int64))


def list_column(column: pa.Array, i: int) -> pa.Array | None:
    """The values of row ``i`` of a list column, None for null."""
    return column[i].values if column[i].is_valid else None
