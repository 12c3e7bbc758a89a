from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from millrace.llm.suffixes import remove_repeated_bytes, suffix_array

from .conftest import corpus


def test_suffix_array_against_sorting():
    rng = random.Random(1)
    cases = [[], [1], [1] * 50, [1, 2] * 20, [2, 1] * 20, [1, 2, 1] * 15, [3, 2, 1], [1, 2, 3]]
    cases += [[rng.randint(1, rng.choice([2, 3, 9])) for _ in range(rng.randint(1, 60))] for _ in range(1500)]
    for text in cases:
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:]), text


def brute(rows, width):
    docs = sorted({(-1 if i is None else i, t or "") for i, t in rows})
    raw = {d: d[1].encode() for d in docs}
    times = Counter(b[i : i + width] for b in raw.values() for i in range(len(b) - width + 1))
    out = {}
    for d, b in raw.items():
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if times[b[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted([(i, *out[(-1 if i is None else i, t or "")]) for i, t in rows], key=str)


@pytest.mark.parametrize("seed,width", [(1, 40), (2, 120), (3, 400), (4, 11), (5, 63)])
def test_against_brute_force(table, seed, width, monkeypatch):
    if seed == 1:
        monkeypatch.setattr("millrace.llm.suffixes.BLOCK", 3)
    rows = corpus(seed, 50) + [(900 + i, f"{i} " * i + "the same boilerplate of some length everywhere " * 2 + f" {i * i}" * 20) for i in range(12)]
    found = remove_repeated_bytes(table(rows), width).drop("kept").collect()
    assert sorted([tuple(r) for r in found], key=str) == brute(rows, width)


def test_empty_table(table):
    assert remove_repeated_bytes(table([(1, "x")]).filter("doc_id = 0")).count() == 0
