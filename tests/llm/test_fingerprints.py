from __future__ import annotations

import hashlib
import random

from millrace.llm import fingerprints as fp

from .conftest import corpus


def test_edited_texts_and_groups(table):
    rows = [r for r in corpus(6) if r != (3, "other text under id 3")][:-1]
    rows += [(3000 + i, " ".join(f"n{j}" for j in range(900)) + f" end{i}") for i in range(6)]
    found = {r.doc_id: r for r in fp.report(table(rows), radius=3).collect()}
    docs = sorted(((-(2**63) if i is None else i, i, t or "") for i, t in rows), reverse=True)
    assert len(found) == len(docs)
    marks = [fp.fingerprint(t.encode(), 5) for *_, t in docs]
    for n, (_, i, t) in enumerate(docs):
        other, cut = docs[(n + 1) % len(docs)][2], len(t) // 3
        edited = t[: len(t) - cut] + other[:cut]
        r = found[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert int(r.fingerprint, 16) == marks[n] and int(r.edited_fingerprint, 16) == fp.fingerprint(edited.encode(), 5)
        assert r.near_next == fp.likeness(marks[n], marks[(n + 1) % len(docs)]) and 0 <= r.near_edited <= 1
        seen, todo = {n}, [n]
        while todo:
            a = todo.pop()
            new = [b for b in range(len(docs)) if b not in seen and (marks[a] ^ marks[b]).bit_count() <= 3]
            seen.update(new)
            todo += new
        least = min(docs[b][0] for b in seen)
        assert r.near_group == (None if least == -(2**63) else least)


def test_all_pairs_within_the_radius(spark, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK", 4)
    rng, marks = random.Random(3), []
    for _ in range(40):
        seed = rng.getrandbits(128)
        marks += [seed] + [seed ^ sum(1 << b for b in rng.sample(range(128), rng.randint(1, 5))) for _ in range(6)]
    rows = [(f"{m:032x}", i) for i, m in enumerate(marks)]
    found = {r.fingerprint: r.group for r in fp.within_radius(spark.createDataFrame(rows, "fingerprint string, _k long"), 3).collect()}
    label = list(range(len(marks)))
    for _ in marks:
        for i, a in enumerate(marks):
            label[i] = min(label[j] for j, b in enumerate(marks) if (a ^ b).bit_count() <= 3)
    assert all(found[f"{m:032x}"] == label[i] for i, m in enumerate(marks))


def test_one_row_and_empty_table(table):
    (row,) = fp.report(table([(5, "abc def")])).collect()
    assert row.doc_id == 5 and row.near_next == 1.0
    assert fp.report(table([(1, "x")]).filter("doc_id = 0")).count() == 0
