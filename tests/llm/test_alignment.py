from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.llm.frames import vocabulary
from millrace.llm.transducer import byte_of

from .conftest import corpus
from .test_tokens import ODD

PATHS = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
MORE = ["▁", "a▁b", "<s> </s> <unk> <0x0A>", "x<|endoftext|>y", "a\r\nb;\r c", "tail ", " lead", "\nlead", "aaaaaaaaaaaa" * 40, "漢字かな交じり文", "a\x00b", "end\n"]


def brute(rows):
    """Groups, links and counts of whole texts, read literally."""
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    byte, of_a = byte_of(), {i: t for t, i in a.get_vocab().items()}
    docs, held = [], defaultdict(set)
    for n, (i, text) in enumerate(rows):
        groups = []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            raw = [bytes(byte[c] for c in of_a[x]) for x in ids[0]], []
            for x in ids[1]:
                piece = b.id_to_piece(x)
                raw[1].append(bytes([int(piece[3:5], 16)]) if b.is_byte(x) else piece.replace("▁", " ").encode())
            if b"".join(raw[0]) == b"".join(raw[1]) == (" " + text).encode():
                ends = [np.cumsum([0, *map(len, r)]) for r in raw]
                cuts = sorted(set(ends[0]) & set(ends[1]))
                groups = [[[], []] for _ in cuts[1:]]
                for side, (own, end) in enumerate(zip(ids, ends)):
                    for x, at in zip(own, np.searchsorted(cuts, end[:-1], "right")):
                        groups[at - 1][side].append(x)
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        for pair in links:
            held[pair].add(n)
        said = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        docs.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), links, said))
    best = defaultdict(int)
    for (x, _), some in held.items():
        best[x] = max(best[x], len(some))
    out = []
    for i, n_a, n_b, n_groups, links, said in docs:
        n_best = sum(n for p, n in links.items() if len(held[p]) == best[p[0]])
        count_sum = sum(n * len(held[p]) for p, n in links.items())
        out.append((i, n_a, n_b, n_groups, sum(links.values()), n_best, count_sum, hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return out, {p: len(s) for p, s in held.items()}


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


def rows_of(seed):
    rng = random.Random(seed)
    rows = corpus(seed, 50) + [(5000 + i, t) for i, t in enumerate(ODD + MORE)]
    return rows + [(6000 + i, "".join(rng.choice("ab .,'\n\t é1Σ́😀▁") for _ in range(rng.randint(1, 40)))) for i in range(300)]


@pytest.mark.parametrize("seed,limits", [(1, (8192, 1 << 22)), (2, (16, 1 << 22)), (3, (8192, 300))])
def test_against_brute_force(spark, table, seed, limits, monkeypatch):
    monkeypatch.setattr(alignment, "SEGMENT_DOCS", limits[0])
    monkeypatch.setattr(alignment, "SEGMENT_LINKS", limits[1])
    rows = rows_of(seed)
    found = alignment.align(table(rows).withColumnRenamed("lang", "seg").withColumnRenamed("source", "code"), *PATHS)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, held = brute(rows)
    assert sum(r[1] for r in want) > 1000
    assert in_order(found.collect()) == in_order(want)
    pairs = alignment.pair_counts(alignment.index(table(rows), *PATHS))
    assert {(r.a, r.b): r.docs for r in pairs.collect()} == held


def test_texts_of_millions_of_characters(spark, table):
    rows = [(1, "many words, one text; " * 60_000), (2, "x" * 20_000), (3, "tail words"), (3, None)]
    assert in_order(alignment.align(table(rows), *PATHS).collect()) == in_order(brute(rows)[0])


def test_no_documents(table):
    assert alignment.align(table([(1, "x")]).filter("doc_id = 0"), *PATHS).count() == 0


def test_bitmaps_give_back_what_went_in(monkeypatch):
    monkeypatch.setattr(alignment, "SEGMENT_DOCS", 256)
    rng = np.random.default_rng(2)
    for density in (3, 200, 5000):
        keys = np.sort(rng.integers(0, 9, density) << 16 | rng.integers(0, 256, density))
        numbered = [(5 << 16 | 7, 1000), (11 << 16 | 255, 2)]
        keys, times = alignment.merged(keys, numbered)
        rows = alignment.compress(keys, times)
        row, entry, digit = alignment.expand(rows.column("planes"))
        code = rows.column("code").to_numpy()
        back = Counter()
        for c, e, d in zip(code[row], entry, digit):
            back[int(c << 16 | e)] += 1 << int(d)
        assert back == dict(zip(keys.tolist(), times.tolist()))
        docs, links = alignment.popcounts(rows.column("planes"))
        for c, n, m in zip(code, docs, links):
            assert (n, m) == ((keys >> 16 == c).sum(), times[keys >> 16 == c].sum())
