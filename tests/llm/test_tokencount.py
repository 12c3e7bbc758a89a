from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import textkit, tokencount, transducer
from millrace.llm.frames import vocabulary
from millrace.llm.transducer import Counter, TokenCounter

from .conftest import corpus
from .test_tokens import ODD

PATH = vocabulary("word_bpe_49k.json")
SIGNS = "ab st'revmlld'S .,'!!\n\t\x0b 1२Ⅷé1Σ́😀İßﬁ漢字か゚ｶﾞAZ<|>{}_-=~ 　\x85\x1c​ͅ"


@pytest.fixture(scope="module")
def machine():
    return TokenCounter(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    out = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    out += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 80))) for _ in range(n // 4)]
    out += [" ".join(rng.choice(["don't", "''s", "'re", "'rest", "we'll", "a'l", "x", "!'ve", "THE", "<|endoftext|>"]) for _ in range(rng.randint(0, 9))) for _ in range(n // 2)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 0x300), rng.randrange(0x300, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(12)) for _ in range(n // 4)]
    return out


def test_counts_are_the_library_s(machine, library):
    some = ODD + [t or "" for _, t in corpus(3)] + texts(1, 4000)
    for at in range(0, len(some), 500):
        got = machine.count(list(some[at : at + 500])).tolist()
        want = [len(e.ids) for e in library.encode_batch(some[at : at + 500], add_special_tokens=False)]
        assert got == want, [repr(t) for t, a, b in zip(some[at:], got, want) if a != b][:3]


def test_words_longer_than_chunks(machine, library, monkeypatch):
    monkeypatch.setattr(transducer, "CHUNK", 16)
    monkeypatch.setattr(transducer, "REACH", 4)
    monkeypatch.setattr(transducer, "BEFORE", 2)
    rng = random.Random(5)
    some = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 3000))) + " x" for _ in range(20)]
    some += ["a" * 5000, "ab" * 3000, "the" * 2000, "é" * 999, "'" * 700 + "s", "漢字" * 400, "!?" * 900]
    assert machine.count(list(some)).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in some]


def test_a_full_table_starts_anew(library, monkeypatch):
    monkeypatch.setattr(transducer, "CELLS", 1 << 14)
    machine = TokenCounter(PATH)
    some = [t or "" for _, t in corpus(4)] + ["".join(random.Random(2).choice("abcdefghijklm") for _ in range(4000))]
    assert machine.count(list(some)).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in some]


def test_maps_compose_like_single_steps(machine):
    splitter = machine.splitter
    rng = np.random.default_rng(4)
    for n in (1, 127, 128, 129, 1000, 5000):
        text = "".join(np.array(list("ab's'rel !1"))[rng.integers(0, 11, n)])
        starts, _ = splitter.word_starts(np.frombuffer(text.encode("utf-32-le"), np.uint32))
        want = {a for _, (a, _) in splitter.split.pre_tokenize_str(text)}
        assert set(np.flatnonzero(starts).tolist()) == want


def test_one_transition_for_every_place():
    """The tokens of a prefix and one more, told by pairs alone, are what merging gives."""
    counter = Counter(PATH)
    rng = random.Random(6)
    for _ in range(300):
        word = tuple(rng.choice(b"aeinorst") for _ in range(rng.randint(1, 14)))
        state, count = 0, 0
        for i, s in enumerate(word):
            value = counter._add(state, s)
            state, count = value >> 8, count + (value & 255) - 128
            assert count == len(counter.encode(word[: i + 1]))


def test_query_on_odd_rows(spark, table, library, monkeypatch):
    rows = corpus(12) + [(7000 + i, t) for i, t in enumerate(ODD)] + [(9, "long words here " * 90_000), (10, "x" * 30_000)]
    docs = table(rows).withColumnRenamed("lang", "n_tokens").withColumnRenamed("source", "n_bytes")
    found = tokencount.count_tokens(docs, PATH)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted((tuple(r)[:3] for r in found.collect()), key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in found.collect())
    assert tokencount.count_tokens(docs.filter("false"), PATH).count() == 0


def test_long_texts_in_parts(library, monkeypatch):
    text = "some <|endoftext|> words, that's all; " * 50
    pieces = list(tokencount.parts(text, 100))
    assert "".join(pieces) == text and len(pieces) > 10
    machine = TokenCounter(PATH)
    assert sum(int(machine.count([p])[0]) for p in pieces) == len(library.encode(text, add_special_tokens=False).ids)
    assert textkit.SLICE_BYTES < 2_000_000
