"""A byte-pair tokenizer compiled to deterministic transducers that count tokens.

Two machines run one after the other over whole texts:

* ``Splitter`` reads characters and marks where the vocabulary's own pattern begins a new
  word.  It has five states, so what a stretch of text does to them is one of a few dozen
  *maps*.  All maps are numbered, a table composes them, and a parallel prefix scan (within
  chunks side by side, then over the chunks by doubling) gives the state before every character.
* ``Counter`` reads the words' bytes; the last byte of a word is a symbol of its own and leads
  back to the start.  Each transition carries by how many tokens the count of the text read so
  far changes.

How merging becomes finite: the tokens of a text are those of a shorter prefix and one
token more, where the last two tokens stay apart when they are encoded together; exactly one
token does that at every place.  So a state holds, for each of the last places from which
a token could still be under way, the place in the tree of tokens, the token that ended there,
and how many tokens have been counted since.  Tokens have a largest length, so the number of
states is finite.  There are far more than any text meets; they are numbered when they are
first met, and all are dropped when the table is full.

Chunks of the byte stream run side by side.  A chunk that begins inside a long word has a
map that is known for one entry state only, at first a guess from the bytes just before.  Maps
compose from left to right: where the exit of a chunk is not the entry of the next, the
next map is extended by that entry, until all agree.  Counts add up as prefix sums.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

#: Cells of the transition table, and the bytes that one lane reads.
CELLS, CHUNK = 1 << 24, 512
#: How far into the next chunk a lane may go to end at a word's end, and how many bytes
#: before a chunk suggest its entry state.
REACH, BEFORE = 64, 32
NO_TOKEN = -1
#: The contractions that the pattern takes before anything else.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
END = "</w>"
SPACE, LETTER, NUMBER, OTHER, SHORT, LONG = range(6)
#: Below this the normaliser looks at single characters only.
SINGLE = 0x300


class Full(Exception):
    """The transition table has no room for another state."""


def byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as they are and the others, in order,
    as the characters from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Splitter:
    """Word starts of normalised text by composed maps of five states."""

    FRESH, WORD, SIGNS, ONE_MORE, TWO_MORE = range(5)

    def __init__(self, tokenizer: Tokenizer):
        self.normalizer, self.split = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.kinds = np.full(0x110000, 255, np.uint8)
        lower = [self.normalizer.normalize_str(chr(c)) for c in range(SINGLE)]
        self.plain = np.array([len(s) == 1 for s in lower])
        self.lower = np.array([ord(s) if len(s) == 1 else 0 for s in lower], np.uint32)
        self._compose()

    def _step(self, state: int, kind: int) -> tuple[int, bool]:
        """The next state, and whether a word begins with this character."""
        if state == self.TWO_MORE:
            return self.ONE_MORE, False
        if state == self.ONE_MORE:
            return self.FRESH, False
        if kind == SPACE:
            return self.FRESH, False
        if kind == LETTER:
            return self.WORD, state != self.WORD
        if kind == NUMBER:
            return self.FRESH, True
        if state == self.SIGNS:
            return self.SIGNS, False
        return {OTHER: self.SIGNS, SHORT: self.ONE_MORE, LONG: self.TWO_MORE}[kind], True

    def _compose(self) -> None:
        """Number all maps that texts can have, and tabulate their composition."""
        steps = [tuple(self._step(s, k)[0] for s in range(5)) for k in range(6)]
        known = {tuple(range(5)): 0}
        queue = list(known)
        for m in queue:
            for step in steps:
                more = tuple(step[s] for s in m)
                if more not in known:
                    known[more] = len(known)
                    queue.append(more)
        self.maps = np.array(queue, np.uint8)
        self.of_kind = np.array([known[s] for s in steps], np.uint16)
        self.then = np.array([[known[tuple(b[s] for s in a)] for b in queue] for a in queue], np.uint16)
        self.starts = np.array([[self._step(s, k)[1] for k in range(6)] for s in range(5)])

    def kind(self, codes: np.ndarray) -> np.ndarray:
        """The class of every character, asked of the vocabulary's pattern once for each."""
        kinds = self.kinds[codes]
        if (kinds == 255).any():
            for c in np.unique(codes[kinds == 255]).tolist():
                x, sign = (len(self.split.pre_tokenize_str(s + chr(c))) for s in "x!")
                joined = self.split.pre_tokenize_str("x" + chr(c))[0][1][1] == 2
                if joined:
                    self.kinds[c] = LETTER
                elif x == 1:
                    self.kinds[c] = SPACE
                else:
                    self.kinds[c] = OTHER if sign == 1 else NUMBER
            kinds = self.kinds[codes]
        return kinds

    def word_starts(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which characters begin a word, and which belong to one."""
        kinds = self.kind(codes)
        quote = np.flatnonzero(codes == ord("'"))
        if len(quote):
            ahead = np.concatenate([codes, np.zeros(2, codes.dtype)])
            one, two = ahead[quote + 1], ahead[quote + 2]
            for c in CONTRACTIONS:
                fit = one == ord(c[1])
                if len(c) == 3:
                    fit &= two == ord(c[2])
                kinds[quote[fit]] = SHORT if len(c) == 2 else LONG
        n = len(codes)
        rows = -(-n // 128)
        maps = np.zeros(rows * 128, np.uint16)
        maps[:n] = self.of_kind[kinds]
        prefix = np.empty((128, rows), np.uint16)
        table, width = self.then.ravel(), self.then.shape[1]
        columns = np.ascontiguousarray(maps.reshape(rows, 128).T)
        prefix[0] = columns[0]
        for i in range(1, 128):
            prefix[i] = table[prefix[i - 1].astype(np.int32) * width + columns[i]]
        total = prefix[127].copy()
        step = 1
        while step < rows:
            total[step:] = self.then[total[:-step], total[step:]]
            step *= 2
        entry = np.zeros(rows, np.uint8)
        entry[1:] = self.maps[total[:-1], self.FRESH]
        before = np.empty((128, rows), np.uint8)
        before[0] = entry
        flat = self.maps.ravel()
        before[1:] = flat[prefix[:-1].astype(np.int32) * 5 + entry]
        state = np.ascontiguousarray(before.T).ravel()[:n]
        return self.starts.ravel()[state * np.uint8(6) + kinds], kinds != SPACE


class Counter:
    """The transducer over the symbols 0 to 255 (a byte) and 256 to 511 (a word's last byte)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte = byte_of()

        def symbols(token: str) -> tuple[int, ...]:
            last = token.endswith(END)
            own = [byte[c] for c in (token[: -len(END)] if last else token)]
            return (*own[:-1], own[-1] + 256) if last else tuple(own)

        self.symbols = {i: symbols(t) for t, i in model["vocab"].items() if t.removesuffix(END) and all(c in byte for c in t.removesuffix(END))}
        self.child: dict[int, int] = {}
        self.token, self.inner = [NO_TOKEN], [True]
        for i, own in self.symbols.items():
            node = 0
            for s in own:
                self.inner[node] = True
                after = self.child.get(node << 9 | s)
                if after is None:
                    after = self.child[node << 9 | s] = len(self.token)
                    self.token.append(NO_TOKEN)
                    self.inner.append(False)
                node = after
            self.token[node] = i
        ids = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.single = {s[0]: i for i, s in self.symbols.items() if len(s) == 1}
        self.forget()

    def forget(self) -> None:
        """Drop all states and what was derived for them."""
        self.apart: dict[tuple[int, int], bool] = {}
        self.states: list[tuple] = [((0, NO_TOKEN, 0),)]
        self.number = {self.states[0]: 0}
        self.codes = np.zeros(512, np.int32)
        self.symbol_of: list[int] = [-1]
        self._resize(32, 256)

    def _resize(self, width: int, rows: int) -> None:
        if width * rows > CELLS:
            raise Full
        old = getattr(self, "table", None)
        self.table = np.full((rows, width), -1, np.int32)
        if old is not None and len(self.states) > 1:
            self.table[: len(old), : old.shape[1]] = old

    def encode(self, symbols: tuple[int, ...]) -> list[int]:
        """The tokens of one short run of symbols, merge by merge."""
        ids = [self.single[s] for s in symbols]
        while len(ids) > 1:
            best = min(((self.merges[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges), default=None)
            if best is None:
                break
            (_, new), i = best
            ids[i : i + 2] = [new]
        return ids

    def stays_apart(self, last: int, token: int) -> bool:
        found = self.apart.get((last, token))
        if found is None:
            before = self.symbols[last] if last != NO_TOKEN else ()
            want = [last, token] if last != NO_TOKEN else [token]
            found = self.apart[last, token] = self.encode(before + self.symbols[token]) == want
        return found

    def _add(self, state: int, symbol: int) -> int:
        """Compile one transition: the next state and the change of the count."""
        found, since, more = None, 0, []
        for node, last, counted in self.states[state]:
            after = self.child.get(node << 9 | symbol)
            if after is None:
                continue
            token = self.token[after]
            if found is None and token != NO_TOKEN and self.stays_apart(last, token):
                found, since = token, counted
            if self.inner[after]:
                more.append((after, last, counted))
        change = 1 - since
        if symbol >= 256:
            return change + 128
        key = (*((node, last, counted + change) for node, last, counted in more), (0, found, 0))
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
            if number == len(self.table):
                self._resize(self.table.shape[1], 2 * number)
        return number << 8 | (change + 128)

    def _code(self, symbols: np.ndarray) -> np.ndarray:
        """Columns of the table, given out to symbols as they are met."""
        codes = self.codes[symbols]
        if not codes.all():
            for s in np.unique(symbols[codes == 0]).tolist():
                self.codes[s] = len(self.symbol_of)
                self.symbol_of.append(s)
            while len(self.symbol_of) > self.table.shape[1]:
                self._resize(2 * self.table.shape[1], len(self.table))
            codes = self.codes[symbols]
        return codes

    def _run(self, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, entries: np.ndarray, out: np.ndarray | None) -> np.ndarray:
        """Run lanes side by side; returns their exits, writes the changes of the count."""
        order = np.argsort(begins - ends, kind="stable")
        begins, lengths, state = begins[order], (ends - begins)[order], entries[order].astype(np.int64)
        width = self.table.shape[1]
        flat = self.table.ravel()
        active = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), "left")
        for t, n in enumerate(active.tolist()):
            at = begins[:n] + t
            cell = state[:n] * width + codes[at]
            found = flat[cell]
            if found.min() < 0:
                for c in np.unique(cell[found < 0]).tolist():
                    value = self._add(c // width, self.symbol_of[c % width])
                    flat = self.table.ravel()
                    flat[c] = value
                found = flat[cell]
            state[:n] = found >> 8
            if out is not None:
                out[at] = (found & 255) - 128
        exits = np.empty_like(state)
        exits[order] = state
        return exits

    def changes(self, symbols: np.ndarray) -> np.ndarray:
        """By how much each symbol changes the count; ``symbols`` ends with a word's end."""
        try:
            return self._changes(self._code(symbols), symbols)
        except Full:
            self.forget()
        try:
            return self._changes(self._code(symbols), symbols)
        except Full:
            self.forget()
        middle = len(symbols) // 2
        last = np.flatnonzero(symbols[middle:-1] >= 256)
        first = np.flatnonzero(symbols[:middle] >= 256)
        if not len(last) and not len(first):
            return self._alone(symbols)
        cut = middle + int(last[0]) + 1 if len(last) else int(first[-1]) + 1
        return np.concatenate([self.changes(symbols[:cut]), self.changes(symbols[cut:])])

    def _alone(self, symbols: np.ndarray) -> np.ndarray:
        """One word with more states than the table holds: state by state."""
        out, state, self_states = np.empty(len(symbols), np.int64), 0, len(self.states)
        for i, s in enumerate(symbols.tolist()):
            if len(self.states) > self_states + 10_000:
                kept = self.states[state]
                self.forget()
                state = 0
                if kept != self.states[0]:
                    self.number[kept] = state = 1
                    self.states.append(kept)
            value = self._add(state, s)
            state, out[i] = value >> 8, (value & 255) - 128
        self.forget()
        return out

    def _changes(self, codes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        n = len(symbols)
        out = np.empty(n, np.int16)
        if not n:
            return out
        after = np.flatnonzero(symbols >= 256) + 1
        marks = np.arange(0, n, CHUNK)
        near = after[np.minimum(np.searchsorted(after, marks), len(after) - 1)]
        near[0] = 0
        begins = np.where((near - marks <= REACH) & (near >= marks), near, marks)
        begins = np.unique(begins[begins < n])
        ends = np.r_[begins[1:], n]
        inside = np.zeros(len(begins), bool)
        inside[1:] = symbols[begins[1:] - 1] < 256
        entries = np.zeros(len(begins), np.int64)
        if inside.any():
            at = begins[inside]
            entries[inside] = self._run(codes, np.maximum(at - BEFORE, 0), at, np.zeros(len(at), np.int64), None)
        exits = self._run(codes, begins, ends, entries, out)
        while True:
            wrong = np.flatnonzero(inside[1:] & (entries[1:] != exits[:-1])) + 1
            if not len(wrong):
                return out
            entries[wrong] = exits[wrong - 1]
            exits[wrong] = self._run(codes, begins[wrong], ends[wrong], entries[wrong], out)


class TokenCounter:
    """Token counts of texts, as the library gives them."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self.splitter, self.counter = Splitter(tokenizer), Counter(path)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def _normal(self, text: str) -> str:
        return self.splitter.normalizer.normalize_str(text)

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of every text."""
        counts = np.zeros(len(texts), np.int64)
        if self.special:
            for i, text in enumerate(texts):
                if "<|" in text:
                    parts = self.special.split(text)
                    counts[i] = len(parts) - 1
                    texts[i] = " ".join(parts)
        own, codes = self._codes(texts)
        begins, black = self.splitter.word_starts(codes)
        last = black.copy()
        last[:-1] &= ~black[1:] | begins[1:]
        raw = np.frombuffer(codes.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        if len(raw) == len(codes):
            first = np.arange(len(raw) + 1)
        else:
            first = np.r_[np.flatnonzero((raw & 0xC0) != 0x80), len(raw)]
        symbols = raw.astype(np.uint16)
        symbols[first[1:][last] - 1] += 256
        if len(raw) != len(codes):
            black = np.repeat(black, np.diff(first))
        changes = np.zeros(len(raw) + 1, np.int64)
        changes[1:][black] = self.counter.changes(symbols[black])
        total = np.cumsum(changes)
        return counts + np.diff(total[first[own]])

    def _codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Normalised texts end to end as code points, a blank after each; their bounds."""
        codes = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le"), np.uint32)
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        known = codes < SINGLE
        simple = known & self.splitter.plain[np.where(known, codes, 0)]
        if simple.all():
            return bounds, self.splitter.lower[codes]
        odd = np.add.reduceat(~simple, bounds[:-1]) > 0
        lower = np.where(simple, self.splitter.lower[np.where(simple, codes, 0)], 32)
        parts = []
        for i, text in enumerate(texts):
            if odd[i]:
                parts.append(np.frombuffer((self._normal(text) + " ").encode("utf-32-le"), np.uint32))
            else:
                parts.append(lower[bounds[i] : bounds[i + 1]])
        return np.cumsum([0, *map(len, parts)]), np.concatenate(parts)


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """This worker's machines; states met once serve all its tasks."""
    return TokenCounter(path)
