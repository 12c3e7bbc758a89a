"""Alignment of two tokenizers' ids by inverted bitmaps of linked pairs.

Both tokenizers' tokens are runs of the text's bytes.  Places where a token of each ends cut them
into groups, and every pair of one A and one B token of a group is a link.  How typical a
pair is, is the number of documents that hold it linked.

1. Tasks encode documents and turn links into postings: for every pair of ids a compressed bitmap
   of the documents that hold it.  Documents are numbered within *segments* of bounded size,
   which serve as the bitmaps' containers: a few documents are a sorted array of 16-bit numbers,
   many a plain bitmap.  How often a document holds the pair is kept bit by bit, in one
   bitmap for each binary digit (multiplicity planes).  The bitmaps of a segment's slices
   are OR-merged, the planes together give the documents (OR, then popcount) and the links
   (popcounts weighted by the digit).
2. A pair's count is the sum of its segments' popcounts, added up before and after the shuffle,
   so that no bitmap of a frequent pair is ever gathered.
3. Counts go back to the segments, where each posting adds its pair's score to its documents.

Nearly all texts are sequences of chunks (a blank and what follows it, or a line end) that both
tokenizers treat alike wherever they stand; what is known of a chunk is kept in a bounded table.
Texts where white space meets white space, and those with a chunk whose bytes the second
tokenizer does not give back, are encoded as a whole.

Defined cases: a text that is null, empty, or not given back byte by byte by both tokenizers
has no tokens, so zeros and an empty hash; rows with a null or repeated id are documents
like any other, each counted; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage
from . import textkit as tk
from .near import runs
from .tokens import CUTS

#: Documents and links of a segment.  A bitmap has one bit for each document.
SEGMENT_DOCS, SEGMENT_LINKS = 8192, 1 << 22
#: Chunks remembered by a worker; then the table starts anew.
REMEMBERED = 500_000
#: A chunk with more links is aligned as part of its text.
MOST_LINKS = 4096
#: Of a pair ``a << SHIFT | b``.
SHIFT = 16
PLACE = 16
HEAD = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
STAGED = "seg bigint, code bigint, docs bigint, links bigint, planes array<binary>, head binary"
REPORT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


class Aligner:
    """Both tokenizers, and what is known of chunks."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        from .transducer import byte_of

        byte = byte_of()
        added = {i for i in self.a.get_added_tokens_decoder()}
        self.bytes_a = {i: bytes(byte[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items() if i not in added}
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.width_a, self.width_b = np.zeros(1 << SHIFT, np.int64), np.array([len(p) for p in self.bytes_b], np.int64)
        for i, own in self.bytes_a.items():
            self.width_a[i] = len(own)
        #: A line end is no part of any piece: what follows it is encoded as if a text began.
        self.lead = self.b.encode("\n")
        self.forget()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.said: list[str | None] = []
        self.sizes = np.zeros((1024, 4), np.int64)
        self.flat, self.used = np.zeros(4096, np.int64), 0
        self.starts = np.zeros(1024, np.int64)

    def groups(self, a: list[int], b: list[int], whole: bytes) -> tuple[str, int, list[int], Counter] | None:
        """The groups in writing, how many, their links' pairs (repeated, as far as they are few)
        and the pairs of large groups with their numbers.  None if bytes are not given back."""
        of_a, of_b = self.bytes_a, self.bytes_b
        if b"".join(of_a[x] for x in a) != whole or b"".join(of_b[x] for x in b) != whole:
            return None
        said, few, many = [], [], Counter()
        i = j = first_a = first_b = end_a = end_b = 0
        while i < len(a) or j < len(b):
            if end_a <= end_b:
                end_a += len(of_a[a[i]])
                i += 1
            else:
                end_b += len(of_b[b[j]])
                j += 1
            if end_a == end_b:
                own_a, own_b = a[first_a:i], b[first_b:j]
                said.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}")
                if len(own_a) * len(own_b) <= 256:
                    few += [x << SHIFT | y for x in own_a for y in own_b]
                else:
                    times = Counter(own_b)
                    for x, n in Counter(own_a).items():
                        for y, m in times.items():
                            many[x << SHIFT | y] += n * m
                first_a, first_b = i, j
        return ";".join(said), len(said), few, many

    def _learn(self, chunks: list[str]) -> None:
        """Align new chunks side by side.  Those that are not given back byte by byte, or whose links
        are many, are remembered as such."""
        found = self.a.encode(chunks, is_pretokenized=True, add_special_tokens=False)
        ids_a, n_a = np.array(found.ids, np.int64), np.bincount(np.array(found.word_ids, np.int64), minlength=len(chunks))
        lead, others = self.lead, self.b.encode(["\n" + c for c in chunks], num_threads=1)
        others = [b[len(lead) :] if b[: len(lead)] == lead else [] for b in others]
        n_b = np.array([len(b) for b in others], np.int64)
        ids_b = np.fromiter(chain.from_iterable(others), np.int64, int(n_b.sum()))
        raw = [c.encode() for c in chunks]
        good = self._given_back(raw, (ids_a, n_a, self.bytes_a), (ids_b, n_b, self.bytes_b))
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        size = np.array([len(r) for r in raw], np.int64) * good
        owner, said, pairs, n_pairs, n_groups = self._aligned(ids_a, ids_b, np.cumsum(size))
        first, n = len(self.said), len(chunks)
        while first + n > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, (2 * len(self.starts), 4))
        while self.used + len(pairs) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        links = np.bincount(owner, n_pairs, minlength=n).astype(np.int64)
        groups = np.bincount(owner, n_groups, minlength=n).astype(np.int64)
        self.flat[self.used : self.used + len(pairs)] = pairs
        self.starts[first : first + n] = self.used + np.cumsum(links) - links
        self.sizes[first : first + n] = np.stack([n_a, n_b, groups, links], axis=1)
        self.used += len(pairs)
        few = good & (links <= MOST_LINKS)
        self.said += [text if fine else None for text, fine in zip(said, few.tolist())]
        self.known.update(zip(chunks, range(first, first + n)))

    @staticmethod
    def _given_back(raw: list[bytes], *sides: tuple) -> np.ndarray:
        """Which chunks both tokenizers give back."""
        whole, fit = b"".join(raw), np.ones(len(raw), bool)
        for ids, n, table in sides:
            parts = [table[i] for i in ids.tolist()]
            lengths = np.array([len(p) for p in parts], np.int64)
            ends = np.r_[0, np.cumsum(lengths)][np.cumsum(n)]
            want = np.cumsum([len(r) for r in raw])
            if np.array_equal(ends, want) and b"".join(parts) == whole:
                continue
            at = np.r_[0, np.cumsum(n)].tolist()
            fit &= [b"".join(parts[i:j]) == r for i, j, r in zip(at, at[1:], raw)]
        return fit

    def _aligned(self, ids_a: np.ndarray, ids_b: np.ndarray, bounds: np.ndarray) -> tuple:
        """Groups of chunks laid end to end; ``bounds`` are the chunks' ends in bytes.  Of every
        group its chunk, of every chunk its groups in writing, all pairs, pairs of each group, ones."""
        end_a, end_b = np.cumsum(self.width_a[ids_a]), np.cumsum(self.width_b[ids_b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        n_a, n_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        each = n_b[of_a]
        place = np.repeat((np.cumsum(n_b) - n_b)[of_a] - np.cumsum(each) + each, each) + np.arange(int(each.sum()))
        pairs = np.repeat(ids_a, each) << SHIFT | ids_b[place]
        # In writing: the tokens of a group, A before B, with what stands after each.
        order = np.argsort(np.r_[2 * of_a, 2 * of_b + 1], kind="stable")
        group = np.r_[of_a, of_b][order]
        last_a, last = np.zeros(len(order), bool), np.zeros(len(order), bool)
        ends = np.cumsum(n_a + n_b)
        last_a[ends - n_b - 1], last[ends - 1] = True, True
        owner = np.searchsorted(bounds, cuts)
        closes = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, bool)
        after = np.where(last_a, 1, np.where(last, np.where(closes[group], 3, 2), 0))
        words = [str(i) for i in np.r_[ids_a, ids_b][order].tolist()]
        signs = [(",", "|", ";", "")[k] for k in after.tolist()]
        text = "".join(chain.from_iterable(zip(words, signs)))
        sizes = np.array([len(w) for w in words], np.int64) + (after < 3)
        at = np.r_[0, np.cumsum(np.bincount(owner[group], sizes, minlength=len(bounds)))].astype(np.int64).tolist()
        return owner, [text[i:j] for i, j in zip(at, at[1:])], pairs, n_a * n_b, np.ones(len(cuts))

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[np.ndarray], list[Counter]]:
        """Of every text the sizes (tokens of A and B, groups, links), the groups' hash, its pairs
        (one for each link) and pairs with numbers."""
        if len(self.known) > REMEMBERED:
            self.forget()
        cuts = [CUTS["byte"](" " + t) if t else None for t in texts]
        cuts = [[c for c in cut if c] if cut else None for cut in cuts]
        new = list(dict.fromkeys(c for cut in cuts if cut for c in cut if c not in self.known))
        if new:
            self._learn(new)
        sizes = np.zeros((len(texts), 4), np.int64)
        hashes, pairs, numbered = [], [], []
        for i, (text, cut) in enumerate(zip(texts, cuts)):
            few, many, said = np.zeros(0, np.int64), Counter(), None
            if cut is not None:
                which = [self.known[c] for c in cut]
                parts = [self.said[k] for k in which]
                if None not in parts:
                    said = ";".join(parts)
                    which = np.array(which)
                    own = self.sizes[which]
                    sizes[i] = own.sum(axis=0)
                    lengths = own[:, 3]
                    shift = np.repeat(self.starts[which] - np.cumsum(lengths) + lengths, lengths)
                    few = self.flat[shift + np.arange(len(shift))]
            if said is None and text:
                a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
                fit = self.groups(a, b, (" " + text).encode())
                if fit is not None:
                    said, n, pairs_few, many = fit
                    few = np.array(pairs_few, np.int64)
                    sizes[i] = (len(a), len(b), n, len(few) + sum(many.values()))
            hashes.append(hashlib.sha256(said.encode()).hexdigest() if said else "")
            pairs.append(few)
            numbered.append(many)
        return sizes, hashes, pairs, numbered


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def merged(keys: np.ndarray, numbered: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    times, keys = np.diff(np.r_[first, len(keys)]), keys[first]
    if numbered:
        more = np.array(numbered, np.int64)
        keys, times = np.r_[keys, more[:, 0]], np.r_[times, more[:, 1]]
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, times = keys[first], np.add.reduceat(times, first)
    return keys, times


def compress(keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """Postings of a segment: for each pair its bitmaps, one a binary digit of ``times``."""
    codes, place = keys >> PLACE, keys & ((1 << PLACE) - 1)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(codes)]))
    most = np.maximum.reduceat(times, first) if len(first) else np.zeros(0, np.int64)
    depth = np.array([int(m).bit_length() for m in most.tolist()], np.int64)
    base = np.cumsum(depth) - depth
    own, entries = [], []
    for digit in range(int(depth.max()) if len(depth) else 0):
        some = np.flatnonzero(times >> digit & 1)
        own.append(base[row[some]] + digit)
        entries.append(place[some])
    plane = np.concatenate(own) if own else np.zeros(0, np.int64)
    entry = np.concatenate(entries) if entries else np.zeros(0, np.int64)
    order = np.argsort(plane, kind="stable")
    plane, entry = plane[order], entry[order]
    counts = np.bincount(plane, minlength=int(depth.sum()))
    bitmap = SEGMENT_DOCS // 8
    dense = 2 * counts >= bitmap
    sizes = np.where(dense, bitmap, 2 * counts)
    offsets = np.r_[0, np.cumsum(sizes)]
    body = np.zeros(int(offsets[-1]), np.uint8)
    begins = np.cumsum(counts) - counts
    sparse = ~dense[plane]
    at = (offsets[plane] + 2 * (np.arange(len(plane)) - begins[plane]))[sparse]
    body[at], body[at + 1] = entry[sparse] & 255, entry[sparse] >> 8
    for p in np.flatnonzero(dense).tolist():
        bits = np.zeros(8 * bitmap, bool)
        bits[entry[begins[p] : begins[p] + counts[p]]] = True
        body[offsets[p] : offsets[p + 1]] = np.packbits(bits, bitorder="little")
    binary = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(body)])
    lists = pa.ListArray.from_arrays(pa.array(np.r_[base, depth.sum()], pa.int32()), binary)
    return pa.RecordBatch.from_arrays([pa.array(codes[first]), lists], names=["code", "planes"])


def expand(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, document and digit of every bit of compressed bitmaps."""
    depth = planes.value_lengths().to_numpy()
    row_of = np.repeat(np.arange(len(planes)), depth)
    digit_of = np.arange(len(row_of)) - np.repeat(np.cumsum(depth) - depth, depth)
    binary = planes.flatten()
    raw = np.frombuffer(binary.buffers()[1], np.int32)[binary.offset : binary.offset + len(binary) + 1].astype(np.int64)
    buffer = binary.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    sizes = np.diff(raw)
    dense = sizes == SEGMENT_DOCS // 8
    n = np.where(dense, 0, sizes // 2)
    plane = np.repeat(np.arange(len(sizes)), n)
    at = np.repeat(raw[:-1] - 2 * (np.cumsum(n) - n), n) + 2 * np.arange(len(plane))
    entry = data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8
    planes_, entries = [plane], [entry]
    for p in np.flatnonzero(dense).tolist():
        bits = np.flatnonzero(np.unpackbits(data[raw[p] : raw[p + 1]], bitorder="little"))
        planes_.append(np.full(len(bits), p))
        entries.append(bits)
    plane, entry = np.concatenate(planes_), np.concatenate(entries)
    return row_of[plane], entry, digit_of[plane]


def popcounts(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Of every row the bits set in the union of its bitmaps, and those of all weighted by digit."""
    row, entry, digit = expand(planes)
    union = np.unique(row << PLACE | entry) >> PLACE
    links = np.zeros(len(planes), np.int64)
    np.add.at(links, row, 1 << digit)
    return np.bincount(union, minlength=len(planes)).astype(np.int64), links


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _index(path_a: str, path_b: str) -> Callable:
    """Segments of a task's documents: one row with the documents (its code is -1), and one
    for each pair with its bitmaps and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = aligner(path_a, path_b)
        segment = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        sizes: list[np.ndarray] = []
        hashes: list[str] = []
        keys: list[np.ndarray] = []
        numbered: list[tuple[int, int]] = []
        held = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal segment, ids, sizes, hashes, keys, numbered, held
            if not ids:
                return
            columns = [pa.array(ids, pa.int64()), *(pa.array(c) for c in np.concatenate(sizes).T), pa.array(hashes)]
            head = _packed(pa.table(columns, names=[*HEAD, "groups_sha256"]))
            empty = pa.array([[]], pa.list_(pa.binary()))
            names = [c.split()[0] for c in STAGED.split(", ")]
            fixed = [pa.array([segment]), pa.array([-1]), pa.array([0]), pa.array([0]), empty, pa.array([head])]
            yield pa.RecordBatch.from_arrays(fixed, names=names)
            rows = compress(*merged(np.concatenate(keys), numbered))
            n = rows.num_rows
            counts = [pa.array(c) for c in popcounts(rows.column("planes"))]
            fixed = [pa.array(np.full(n, segment)), rows.column("code"), *counts, rows.column("planes"), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(fixed, names=names)
            segment += 1
            ids, sizes, hashes, keys, numbered, held = [], [], [], [], [], 0

        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for part in tk.slices(batch.column("text")):
                texts = batch.column("text").slice(part.first, len(part)).to_pylist()
                size, own_hashes, pairs, many = machine.align(texts)
                for i in range(len(texts)):
                    place = len(ids)
                    ids.append(docs[part.first + i])
                    sizes.append(size[i : i + 1])
                    hashes.append(own_hashes[i])
                    keys.append(pairs[i] << PLACE | place)
                    numbered += [(code << PLACE | place, n) for code, n in many[i].items()]
                    held += len(pairs[i]) + len(many[i])
                    if len(ids) == SEGMENT_DOCS or held >= SEGMENT_LINKS:
                        yield from close()
        yield from close()

    return run


def index(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The staged postings of all segments."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return stage(plain.mapInArrow(_index(path_a, path_b), STAGED), "postings")


def pair_counts(postings: DataFrame) -> DataFrame:
    """a, b, docs (that hold the pair linked), links, and whether no pair of ``a`` has more docs."""
    pairs = postings.filter("code >= 0").groupBy("code").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    pairs = pairs.select(F.shiftright("code", SHIFT).alias("a"), F.col("code").bitwiseAND((1 << SHIFT) - 1).alias("b"), "docs", "links")
    return pairs.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add every pair's score to its documents, segment by segment.  A pair has two rows, one with
    its count and one with its bitmaps."""
    for group in runs(batches, ["seg"]):
        code, docs = group.column("code").to_numpy(), group.column("docs").to_numpy()
        best = group.column("best").to_numpy(zero_copy_only=False)
        head = group.column("head")[int(np.flatnonzero(code == -1)[0])].as_buffer()
        table = pa.ipc.open_stream(head).read_all().combine_chunks()
        counted, held = np.flatnonzero((code >= 0) & (docs > 0)), np.flatnonzero((code >= 0) & (docs == 0))
        if not np.array_equal(code[counted], code[held]):
            raise ValueError("postings and counts of a segment differ")
        count_sum, n_best = (np.zeros(len(table), np.int64) for _ in range(2))
        row, entry, digit = expand(group.column("planes").take(pa.array(held)))
        times = np.int64(1) << digit
        np.add.at(count_sum, entry, docs[counted][row] * times)
        np.add.at(n_best, entry, best[counted][row] * times)
        columns = [*(table.column(c) for c in HEAD), pa.array(n_best), pa.array(count_sum), table.column("groups_sha256")]
        names = [c.split()[0] for c in REPORT.split(", ")]
        yield from pa.table(columns, names=names).combine_chunks().to_batches()


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: its tokens, groups and links, how many links are to the id most often
    linked with their A id, the sum of its links' counts, and a hash of the groups."""
    postings = index(docs, path_a, path_b)
    pairs = pair_counts(postings).select(F.expr(f"shiftleft(a, {SHIFT}) | b").alias("code"), "docs", "best")
    nothing, no_head = F.array().cast("array<binary>"), F.lit(None).cast("binary")
    counts = postings.filter("code >= 0").select("seg", "code").join(pairs, "code")
    counts = counts.select("seg", "code", "docs", "best", nothing.alias("planes"), no_head.alias("head"))
    bitmaps = postings.select("seg", "code", F.lit(0).cast("bigint").alias("docs"), F.lit(False).alias("best"), "planes", "head")
    met = counts.unionAll(bitmaps).repartition("seg").sortWithinPartitions("seg", "code")
    return met.mapInArrow(_scored, REPORT)
