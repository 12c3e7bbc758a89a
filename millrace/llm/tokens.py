"""Token ids of whole texts with the tokenizers library, one library call per new chunk.

Both vocabularies split text before they merge, so the ids of a text are those of its
chunks laid end to end, as long as no chunk boundary lies inside what the vocabulary's
own pattern keeps together.  Texts for which that is not certain go to the library whole.
The ids of chunks seen before come from a bounded table in the worker process.  New chunks of
printable ASCII and Latin-1 letters are taken apart by the vocabulary's own pattern, and only parts
not seen before go to the library's merges; other new chunks go through all of the library.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
from tokenizers import Tokenizer

#: Distinct chunks, and distinct parts, remembered by a worker; then that table starts anew.
REMEMBERED, PARTS_REMEMBERED = 600_000, 300_000
#: New chunks taken apart in one go.
TOGETHER = 1000
_MARK = "\x1f"
_SEPARATORS = re.compile("[\x1c-\x1f]")
_DOUBLE = re.compile(r"\s\s")


def _at_spaces(text: str) -> list[str] | None:
    """Chunks for byte-level vocabularies: cut before every lone blank and around every
    lone line end.  None if white space meets white space: the pattern looks ahead there."""
    if _MARK in text or _DOUBLE.search(text):
        return None
    return text.replace(" ", _MARK + " ").replace("\n", f"{_MARK}\n{_MARK}").split(_MARK)


def _at_white_space(text: str) -> list[str] | None:
    """Chunks for vocabularies that drop white space.  None if the text has separators that
    count as white space here but not there."""
    return None if _SEPARATORS.search(text) else text.split()


#: How a vocabulary's texts may be cut, by the kind named in the query.
CUTS: dict[str, Callable[[str], list[str] | None]] = {"byte": _at_spaces, "word": _at_white_space}

_ENDINGS, _LATIN = "'(?:s|t|re|ve|m|ll|d)", "À-ÖØ-öø-ÿ"
#: Chunks of printable ASCII and Latin-1 letters, and the vocabulary's pattern as far as it concerns them
#: and a mark between them.
PLAIN = {"byte": re.compile(f" ?[!-~{_LATIN}]+"), "word": re.compile(f"[!-~{_LATIN}]+")}
PARTS = {
    "byte": re.compile(f"{_ENDINGS}| ?[A-Za-z{_LATIN}]+| ?[0-9]+| ?[^ {_MARK}A-Za-z0-9{_LATIN}]+|{_MARK}"),
    "word": re.compile(f"{_ENDINGS}|[a-z{_LATIN}]+|[0-9]|[^{_MARK}a-z0-9{_LATIN}]+|{_MARK}"),
}
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
#: Byte-level vocabularies write the bytes that cannot be printed as letters from U+0100 on.
_BYTE_LEVEL = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_BLANK = chr(_BYTE_LEVEL[0x20])


class Table:
    """Strings seen before and their ids; the first one has none."""

    def __init__(self, first: str) -> None:
        self.place = {first: 0}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, np.uint32), 0

    def __len__(self) -> int:
        return len(self.place)

    def add(self, strings: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Remember new strings whose ids, laid end to end, have these lengths."""
        first, n = len(self), len(self) + len(strings)
        while n > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.lengths[first:n] = lengths
        self.starts[first:n] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.place.update(zip(strings, range(first, n)))

    def find(self, groups: Iterable[list[str]], learn: Callable[[list[str]], None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places of all strings of ``groups``, their ids end to end, and where those of each
        string end.  A group is looked up as it comes; what was not seen before is learnt at once."""
        found, new, seen = [np.zeros(0, np.int64)], [], self.place.get
        for group in groups:
            which = np.fromiter(map(seen, group, repeat(-1)), np.int64, len(group))
            new += [group[i] for i in np.flatnonzero(which < 0).tolist()]
            found.append(which)
        which = np.concatenate(found)
        if new:
            learn(list(dict.fromkeys(new)))
            which[which < 0] = np.fromiter(map(self.place.__getitem__, new), np.int64, len(new))
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return which, self.flat[np.repeat(self.starts[which] - ends + lengths, lengths) + np.arange(total)], ends


class Encoder:
    def __init__(self, path: str, cut: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.cut, self.plain, self.apart = CUTS[cut], PLAIN[cut], PARTS[cut]
        self.lower, self.model = cut == "word", self.tokenizer.model
        self.known, self.parts = Table(""), Table(_MARK)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None

    def _merge(self, parts: list[str]) -> None:
        """Learn parts, as the library's model merges their byte-level forms."""
        ids, lengths, merge = array("I"), array("q"), self.model.tokenize
        for part in parts:
            found = merge(part.replace(" ", _BLANK) if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_LEVEL))
            lengths.append(len(found))
            ids.extend([t.id for t in found])
        self.parts.add(parts, np.frombuffer(ids, np.uint32), np.frombuffer(lengths, np.int64))

    def _apart(self, chunks: list[str]) -> Iterator[list[str]]:
        """The parts of some plain chunks at a time, with a mark after every chunk."""
        for at in range(0, len(chunks), TOGETHER):
            text = _MARK.join([*chunks[at : at + TOGETHER], ""])
            yield self.apart.findall(text.lower() if self.lower else text)

    def _learn(self, chunks: list[str]) -> None:
        plain = list(filter(self.plain.fullmatch, chunks))
        if len(self.parts) > PARTS_REMEMBERED:
            self.parts = Table(_MARK)
        which, ids, ends = self.parts.find(self._apart(plain), self._merge)
        self.known.add(plain, ids, np.diff(ends[which == 0], prepend=0))
        if len(plain) < len(chunks):
            other = [c for c in chunks if not self.plain.fullmatch(c)]
            found = self.tokenizer.encode(other, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            own = np.array(found.word_ids, np.int64) if len(ids) else np.zeros(0, np.int64)
            self.known.add(other, ids, np.bincount(own, minlength=len(other)))

    def _cut(self, texts: list[str], sizes: list[int | None]) -> Iterator[list[str]]:
        """The chunks of every text that may be cut, and in ``sizes`` their number, or None."""
        for text in texts:
            cut = None if self.special and self.special.search(text) else self.cut(text)
            sizes.append(None if cut is None else len(cut))
            if cut is not None:
                yield cut

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        if len(self.known) > REMEMBERED:
            self.known = Table("")
        sizes: list[int | None] = []
        _, ids, ends = self.known.find(self._cut(texts, sizes), self._learn)
        out, at, begin = [], 0, 0
        for text, size in zip(texts, sizes):
            if size is None:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            at += size
            end = int(ends[at - 1]) if at else 0
            out.append(ids[begin:end])
            begin = end
        return out


@lru_cache(maxsize=4)
def encoder(path: str, cut: str) -> Encoder:
    """This worker's encoder; its table of chunks lives on between tasks."""
    return Encoder(path, cut)
