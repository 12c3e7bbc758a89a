from __future__ import annotations

import re
from math import comb

import numpy as np
import pytest

from millrace.llm import near
from millrace.llm.components import components

from .conftest import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, conf):
    def lower(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")

    sets = []
    for _, t in rows:
        w, k = WORD.findall(lower(t)), conf.shingle
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and conf.den * len(sets[i] & sets[j]) >= conf.num * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), 10**9), -1 if d is None else d)
    out = [(d, len(sets[i]), None if least[root(i)] < 0 else least[root(i)]) for i, (d, _) in enumerate(rows)]
    return sorted([(*r, r[0] == r[2]) for r in out], key=str)


def chain(n):
    words = [f"c{i}" for i in range(80)]
    out = []
    for i in range(n):
        words = words[1:] + [f"d{i}"]
        out.append((5000 + i, " ".join(words)))
    return out


@pytest.mark.parametrize("seed,conf", [(1, near.Near(3, 85, 100)), (2, near.Near(5, 80, 100))])
def test_against_brute_force(table, seed, conf, monkeypatch):
    rows = corpus(seed, 90) + chain(25)
    rows += [(7000 + i, " ".join(f"h{(j * 7) % 50 if j % 11 else (j + i) % 300}" for j in range(120))) for i in range(30)]
    found = near.near_duplicates(table(rows), conf)
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute(rows, conf)


def test_empty_table(table):
    assert near.near_duplicates(table([(1, "x")]).filter("doc_id = 0")).count() == 0


def test_components_of_chain_and_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(40)] + [(7, 7), (300, 301), (301, 300)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(61)}, 100: 100, **{200 + i: 100 for i in range(40)}, 300: 300, 301: 300}


def test_pruning_bound_is_the_posterior():
    conf = near.Near(3, 85, 100, miss=1e-4)
    for i, least in enumerate(conf.least_matches):
        n = (i + 1) * near.BATCH
        tail = lambda m: sum(comb(n + 1, x) * 0.85**x * 0.15 ** (n + 1 - x) for x in range(m + 1))
        assert tail(least) >= 1e-4 and (least == 0 or tail(least - 1) < 1e-4)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    b = np.r_[a[:3400], rng.integers(0, 2**63, 600, dtype=np.uint64)]
    same = (near.signature(a, 128) == near.signature(b, 128)).mean()
    assert abs(same - 3400 / 4600) < 0.13


def test_one_row_of_each_component(table):
    text = " ".join(f"w{i}" for i in range(200))
    near_text, other, third = text + " more", "quite another text of its own", "a third one that nobody repeats"
    rows = [(5, text), (5, text), (5, near_text), (9, text), (None, other), (None, other), (None, other + ""), (None, third), (7, other), (8, ""), (8, "")]
    kept = sorted(((r.doc_id, r.text) for r in near.keep_one(table(rows), near.Near(5, 80, 100)).collect()), key=str)
    assert len(kept) == 4 and kept[1][0] == 8
    assert kept[0][0] == 5 and kept[0][1] in (text, near_text)
    assert set(kept[2:]) == {(None, third), (None, other)}
    same = [(None, text), (None, near_text), (None, text)]
    assert near.keep_one(table(same), near.Near(5, 80, 100)).count() == 1
