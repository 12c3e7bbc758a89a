from __future__ import annotations

import hashlib

import pytest

from millrace.llm.substring import remove_repeats

from .conftest import corpus


def brute(rows, window):
    docs = sorted({(-1 if i is None else i, t or "") for i, t in rows})
    split = {d: d[1].encode().split() for d in docs}
    seen, gone = set(), {d: set() for d in docs}
    for d in docs:
        ws = split[d]
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            if key in seen:
                gone[d].update(range(i, i + window))
            seen.add(key)
    out = []
    for i, t in rows:
        d = (-1 if i is None else i, t or "")
        kept = [w for j, w in enumerate(split[d]) if j not in gone[d]]
        out.append((i, len(split[d]), len(gone[d]), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,window", [(1, 20), (2, 20), (3, 50), (4, 6)])
def test_against_brute_force(table, seed, window):
    rows = [r for r in corpus(seed) if r != (3, "other text under id 3")]
    found = remove_repeats(table(rows), window).drop("kept_text").collect()
    assert sorted([tuple(r) for r in found], key=str) == brute(rows, window)


def test_white_space_around_kept_words_stays(table):
    body = " ".join(f"a{i}" for i in range(30))
    rows = [(1, body), (2, "new\n\nstart " + body + "\tthe end\n")]
    kept = {r.doc_id: r.kept_text for r in remove_repeats(table(rows), 20).collect()}
    assert kept == {1: body, 2: "new\n\nstart the end\n"}


def test_empty_table(table):
    assert remove_repeats(table([(1, "x")]).filter("doc_id = 0")).count() == 0
