"""SentencePiece encoding and decoding with Unigram scores.

The vocabulary comes from a model file: pieces, log scores, kinds, and how white space is
marked.  Pieces are looked up in a double-array trie, which finds all pieces that begin at
a place in one walk over the bytes.  Viterbi takes the segmentation of the largest sum of
scores; of equal ones, that whose last piece begins first.  A character that no piece covers
costs ten less than the least score and becomes its bytes, if the model has byte pieces, else
the unknown id (once for a run of them).

The method takes the scores of the file as they are.  Those of a BPE file are negative merge
ranks, no log probabilities: the result is then the best path over ranks, neither the file's
own encoding nor a Unigram segmentation trained on a corpus.

Apart from runs of the white-space mark no piece holds the mark behind its first character,
so the best segmentation of a text is that of its words laid end to end.  Words met before
are taken from a bounded table in the worker; new words of equal length go through the trie
and Viterbi side by side, as arrays.  If a model has pieces that cross words, whole texts
are segmented instead.

Decoding lays pieces end to end, turns runs of byte pieces back into text (broken UTF-8
becomes U+FFFD), the mark into a blank, and drops the blank put before the text.

Defined cases: a null or empty text has no ids; the mark itself in a text reads as a
blank, as in the public library; rows with null or repeated ids are documents like any
other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

MARK = "▁"
WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_COST = 10.0
REMEMBERED = 400_000
#: Words of one length segmented side by side, and the bytes up to which words are.
ABREAST = 8192
LONGEST = 96
ENCODED = "doc_id bigint, n_ids bigint, n_byte_ids bigint, ids_crc32 bigint, decoded_sha256 string, round_trip boolean"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(tag & 7)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class DoubleArray:
    """A trie in two arrays: the child of node s by byte c is base[s] + c + 1, if check of it is s."""

    #: Slots before the end that are searched for room; older gaps stay empty.
    LOOK_BACK = 64

    def __init__(self, keys: dict[bytes, int]):
        ordered = sorted(keys)
        self.base, self.check, self.value = [0], [-1], [-1]
        self._free = 1
        todo = [(0, 0, len(ordered), 0)]
        while todo:
            node, lo, hi, depth = todo.pop()
            if lo < hi and len(ordered[lo]) == depth:
                self.value[node] = keys[ordered[lo]]
                lo += 1
            groups: list[tuple[int, int, int]] = []
            while lo < hi:
                end, byte = lo, ordered[lo][depth]
                while end < hi and ordered[end][depth] == byte:
                    end += 1
                groups.append((byte + 1, lo, end))
                lo = end
            if groups:
                base = self._place([g[0] for g in groups])
                self.base[node] = base
                for code, a, b in groups:
                    self.check[base + code] = node
                for code, a, b in groups:
                    todo.append((base + code, a, b, depth + 1))

    def _place(self, codes: list[int]) -> int:
        while self._free < len(self.check) and self.check[self._free] >= 0:
            self._free += 1
        alone = len(codes) == 1 and self._free >= codes[0]
        base = (self._free if alone else max(codes[0], len(self.check) - self.LOOK_BACK)) - codes[0]
        while True:
            need = base + codes[-1] + 1 - len(self.check)
            if need > 0:
                self.base += [0] * need
                self.check += [-1] * need
                self.value += [-1] * need
            if all(self.check[base + c] < 0 and base + c for c in codes):
                return base
            base += 1

    def prefixes(self, data: bytes, at: int) -> Iterator[tuple[int, int]]:
        """(end, value) of every key that begins at ``at``, shortest first."""
        base, check, value, node = self.base, self.check, self.value, 0
        for end in range(at, len(data)):
            child = base[node] + data[end] + 1
            if child >= len(check) or check[child] != node:
                return
            node = child
            if value[node] >= 0:
                yield end + 1, value[node]


class Unigram:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = file.read()
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.prefix, self.squeeze = True, True
        for number, value in _fields(model):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append(own.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, NORMAL))
            elif number == 3:
                own = dict(_fields(value))
                self.prefix, self.squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        usable = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER)]
        self.trie = DoubleArray({self.pieces[i].encode(): i for i in usable})
        plain = [self.scores[i] for i in usable if self.kinds[i] == NORMAL]
        self.worst = min(plain) - UNKNOWN_COST
        best = max(plain)
        for i in usable:
            if self.kinds[i] == USER:
                self.scores[i] = len(self.pieces[i].encode()) * best - 0.1
        self.by_words = not any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) for p in (self.pieces[i] for i in usable))
        self.known: dict[str, tuple[int, ...]] = {}
        self.nodes = [np.array(x, np.int64) for x in (self.trie.base, self.trie.check, self.trie.value)]
        self.cost = np.array(self.scores)

    def viterbi(self, text: str) -> tuple[int, ...]:
        """Ids of the best segmentation of ``text``, marks included."""
        data = text.encode()
        n, worst, scores = len(data), self.worst, self.scores
        best: list[float | None] = [None] * (n + 1)
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            here, lead = best[at], data[at]
            step = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            single = False
            for end, piece in self.trie.prefixes(data, at):
                score = here + scores[piece]
                if best[end] is None or score > best[end]:
                    best[end], back[end] = score, (at, piece)
                single |= end == at + step
            if not single:
                end, score = at + step, here + worst
                if best[end] is None or score > best[end]:
                    best[end], back[end] = score, (at, -1)
            at += step
        out: list[int] = []
        while n:
            start, piece = back[n]
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out += [self.bytes[b] for b in reversed(data[start:n])]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
            n = start
        return tuple(reversed(out))

    def abreast(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """What ``viterbi`` gives for each of ``words``, which are all of one length."""
        n, count = len(words[0]), len(words)
        data = np.frombuffer(b"".join(words), np.uint8).reshape(count, n).T.astype(np.int64)
        base, check, value = self.nodes
        best = np.full((n + 1, count), -np.inf)
        start = np.zeros((n + 1, count), np.int64)
        piece = np.full((n + 1, count), -1, np.int64)
        best[0] = 0.0

        def offer(who: np.ndarray, ends: np.ndarray | int, scores: np.ndarray, at: int, ids: np.ndarray | int) -> None:
            better = scores > best[ends, who]
            who = who[better]
            ends = ends[better] if isinstance(ends, np.ndarray) else ends
            best[ends, who], start[ends, who] = scores[better], at
            piece[ends, who] = ids[better] if isinstance(ids, np.ndarray) else ids

        for at in range(n):
            lead = data[at]
            begins = np.flatnonzero((lead & 0xC0) != 0x80)
            if not len(begins):
                continue
            step = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
            single = np.zeros(count, bool)
            who, node = begins, np.zeros(len(begins), np.int64)
            for end in range(at + 1, n + 1):
                child = base[node] + data[end - 1, who] + 1
                child[child >= len(check)] = 0
                on = check[child] == node
                who, node = who[on], child[on]
                if not len(who):
                    break
                ids = value[node]
                ended = ids >= 0
                own, ids = who[ended], ids[ended]
                offer(own, end, best[at, own] + self.cost[ids], at, ids)
                single[own[step[own] == end - at]] = True
            bare = begins[~single[begins]]
            offer(bare, at + step[bare], best[at, bare] + self.worst, at, -1)
        taken, ends, who = [], np.full(count, n), np.arange(count)
        while ends.any():
            taken.append(np.where(ends > 0, np.where(piece[ends, who] >= 0, piece[ends, who], -1 - ends), -1))
            ends = np.where(ends > 0, start[ends, who], 0)
        steps = np.array(taken)[::-1].T
        bare, first = (steps < -1).any(1).tolist(), (steps == -1).sum(1).tolist()
        paths = zip(words, steps.tolist(), bare, first)
        return [self._spelled(word, path[a:]) if odd else tuple(path[a:]) for word, path, odd, a in paths]

    def _spelled(self, word: bytes, path: list[int]) -> tuple[int, ...]:
        """Ids of a path in which a number below -1 is where a bare character ends."""
        out: list[int] = []
        for i in path:
            if i >= 0:
                out.append(i)
            elif self.bytes:
                begin = end = -1 - i
                while begin == end or word[begin] & 0xC0 == 0x80:
                    begin -= 1
                out += [self.bytes[b] for b in word[begin:end]]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return tuple(out)

    def marked(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return (MARK if self.prefix else "") + text.replace(" ", MARK) if text else ""

    def learn(self, texts: list[str]) -> None:
        """Segment the words of ``texts`` that the table of words lacks."""
        new = {w for text in texts for w in WORDS.findall(self.marked(text))}.difference(self.known) if self.by_words else ()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for word in new:
            raw = word.encode()
            if len(raw) <= LONGEST:
                by_size.setdefault(len(raw), []).append((word, raw))
        for same in by_size.values():
            for a in range(0, len(same), ABREAST):
                part = same[a : a + ABREAST]
                self.known.update(zip([w for w, _ in part], self.abreast([raw for _, raw in part])))

    def encode(self, text: str) -> list[int]:
        marked = self.marked(text)
        if not self.by_words:
            return list(self.viterbi(marked))
        out: list[int] = []
        known = self.known
        for word in WORDS.findall(marked):
            ids = known.get(word)
            if ids is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                ids = known[word] = self.viterbi(word)
            if not self.bytes and out and ids and out[-1] == ids[0] == self.unknown:
                ids = ids[1:]
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        out: list[str] = []
        run = bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                run.append(byte)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            if self.kinds[i] != CONTROL:
                out.append(" ⁇ " if i == self.unknown else self.pieces[i].replace(MARK, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def model(path: str) -> Unigram:
    """This worker's model; its trie and table of words live on between tasks."""
    return Unigram(path)


def _encode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        bytes_ = np.array(sorted(own.byte_of), np.uint32)
        for batch in batches:
            rows = []
            for part in tk.slices(batch.column("text")):
                texts = batch.column("text").slice(part.first, len(part)).to_pylist()
                own.learn(texts)
                for text in texts:
                    ids = own.encode(text)
                    array, back = np.array(ids, "<u4"), own.decode(ids)
                    n_bytes = int(np.isin(array, bytes_).sum())
                    rows.append((len(ids), n_bytes, zlib.crc32(array.tobytes()), hashlib.sha256(back.encode()).hexdigest(), back == text))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=[c.split()[0] for c in ENCODED.split(", ")])

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: how many ids, how many of them bytes, the CRC-32 of the ids as
    little-endian 32-bit integers, the SHA-256 of the decoded text, and whether it is the text."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return plain.mapInArrow(_encode(path), ENCODED)
