from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing, tokenfile
from millrace.llm.frames import vocabulary
from millrace.llm.tokens import Encoder
from millrace.workspace import shared_dir

from .conftest import corpus

ODD = [
    "", " ", "\n", "a", " a", "a ", "a\n", "\na", "a\nb", "a \nb", "a\n b", "a  b", "a\n\nb", "x\ty", "don't they'll I'VE",
    "<|endoftext|>", "a<|endoftext|> b", "ÀÉ ß́ ﬁ Σς ΣΣ", "\x1f", "a\x1fb", "a b  c", "漢字 かな", "1234 5,678.9!!", "😀 a😀",
    "́x ́y", "\r\n", "a\rb", "a ́b", "\x85a b\x85", "tail \n", "İstanbul ǅ",
]


@pytest.mark.parametrize("name,cut", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_chunks_give_the_library_ids(name, cut):
    rng = random.Random(1)
    texts = ODD + [t or "" for _, t in corpus(3)]
    texts += ["".join(rng.choice("ab .,'\n\t é1Σ́ 😀") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    library = Tokenizer.from_file(vocabulary(name))
    own = Encoder(vocabulary(name), cut)
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        for text, ids in zip(some, own.encode(some)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name,cut", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_new_words_around_known_parts_are_not_merged_anew(name, cut):
    """Chunks that differ only in what surrounds a word cost no call of the library."""
    plain = [f"{a}wor{i}ld{b}" for i in range(9) for a in ("", "(", "'") for b in ("", ".", ",", "'s", "'RE", "s'", '."', "-x")]
    odd = ["".join(chr(c) for c in range(33, 127)), "''s'", "x'sfoo", "..'s", "I'LL", "a1b22c", "_a_", "A.B,C", "'", "'t", "1'd2", "Éa'Sÿ", "×a÷é"]
    odd += ["".join(chr(c) for c in range(0xC0, 0x100))]
    text = " ".join([*plain, *odd, *reversed(odd)])
    library, own = Tokenizer.from_file(vocabulary(name)), Encoder(vocabulary(name), cut)
    assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    parts = len(own.parts)
    assert own.encode([" (wor1ld-x wor2ld's ('wor3ld."])[0].tolist() == library.encode(" (wor1ld-x wor2ld's ('wor3ld.", add_special_tokens=False).ids
    assert 0 < parts and len(own.parts) <= parts + 3 < len(own.known)


def test_store_round_trip(spark, table):
    rows = [r for r in corpus(8) if r[0] is not None] + [(9000 + i, t) for i, t in enumerate(ODD)]
    folder = shared_dir(spark, "tokens-test")
    tokenfile.write_store(table(rows), folder, vocabulary("byte_bpe_50k.json"), end_id=2)
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    found = sorted(tokenfile.read_store(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted(i for i, _ in rows)
    texts, start = {}, 0
    for i, t in rows:
        texts.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    for r in found:
        crcs = {zlib.crc32(np.array(x, "<u4").tobytes()): len(x) for x in texts[r.doc_id]}
        assert r.start == start and crcs[r.ids_crc32] == r.n_tokens
        start += r.n_tokens
    for i in (9008, 1000):
        assert tokenfile.read_ids(spark, folder, i) == texts[i]


def test_empty_store(spark, table):
    folder = shared_dir(spark, "tokens-test")
    tokenfile.write_store(table([(1, "x")]).filter("doc_id = 0"), folder, vocabulary("byte_bpe_50k.json"))
    assert tokenfile.read_store(spark, folder).count() == 0


def test_pieces_cover_all_ids_in_full_sequences(table):
    rows = [(i, t) for i, t in corpus(9) if i is not None and (i, t) != (3, "other text under id 3")][:-1]
    rows += [(20000 + i, "long text " * 3000) for i in range(3)]
    found = packing.pack(table(rows), vocabulary("word_bpe_49k.json")).collect()
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted((p for p in found if p.doc_id == i), key=lambda p: p.start):
            own = ids[p.start : p.start + p.length]
            assert p.start == at and p.length == len(own) and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    sequences = {}
    for p in sorted(found, key=lambda p: p.offset):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sequences.values())


@pytest.mark.parametrize("limits", [packing.Limits(64, 4, 63), packing.Limits(64, 100, 40), packing.Limits(64, 2, 50)])
def test_all_limits_hold(limits):
    lengths = np.random.default_rng(3).integers(1, 90, 300)
    full, short = packing.dot_product_bins(lengths, limits)
    more, short = packing.top_up(short, limits)
    last = [b for bin_ in short for b in packing.in_powers(bin_, limits)]
    bins = full + more + last
    for b in bins:
        assert sum(p.length for p in b) <= limits.tokens and len(b) <= limits.segments and sum(p.loss for p in b) <= limits.loss
    seen = sorted((p.item, p.start, p.length) for b in bins for p in b)
    for i, n in enumerate(lengths):
        at = 0
        for item, start, length in seen:
            if item == i:
                assert start == at
                at += length
        assert at == n


@pytest.mark.parametrize("name,cut", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_chunks_and_parts_are_looked_up_together(name, cut, monkeypatch):
    """Texts of one call share the look-up and the merges of new parts, whatever lies between them."""
    monkeypatch.setattr("millrace.llm.tokens.TOGETHER", 3)
    library, own = Tokenizer.from_file(vocabulary(name)), Encoder(vocabulary(name), cut)
    calls = []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda chunks: (calls.append(len(chunks)), learn(chunks)))
    texts = ["", "a  b\x1f", "neu ä,b 'x'", "<|endoftext|>", "", "漢字 neu, ä", "\n", " ".join(f"w{i}'s" for i in range(20)), "a  b\x1f"]
    for _ in range(2):
        assert [i.tolist() for i in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(calls) == 1
    assert own.encode([]) == []
