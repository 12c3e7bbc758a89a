from __future__ import annotations

import re

from millrace.llm import quality

from .conftest import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    n = len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, again, len(marked), n < 50 or 100 * len(marked) > 50 * n


def test_base_measures(table):
    rows = [*corpus(5), (2000, "a # b\nx\nx\n\n\n x\n" + "ü*|> " * 60)]
    found = quality.judge(table(rows)).collect()
    own = sorted(((r.doc_id, *[r[c] for c in quality.BASE], r.base_failed) for r in found), key=str)
    assert own == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert all(not r.kept for r in found if r.base_failed)


def test_junk_goes_and_prose_stays(table):
    prose = " ".join(f"{'word' + chr(97 + i % 26)}{i}" for i in range(120)) + "."
    rows = [
        (1, prose),
        (2, prose.replace(" ", " | ")),
        (3, prose.replace(" ", "### ")),
        (4, " ".join(str(i * 1000) for i in range(100))),
        (5, prose.replace(" ", "!! ")),
    ]
    found = {r.doc_id: r.kept for r in quality.judge(table(rows)).collect()}
    assert found == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_order_does_not_change_the_verdict(table):
    docs = table(corpus(6))
    back = quality.judge(docs, tuple(reversed(quality.RULES))).drop("rejected_by")
    assert sorted(map(str, quality.judge(docs).drop("rejected_by").collect())) == sorted(map(str, back.collect()))


def test_order_prefers_rejections_per_cost(table):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(200)]

    def slow(doc):
        return sum(range(20000)) > 0 and b"w1" in doc.text

    rules = [quality.Rule("never", lambda d: False), quality.Rule("slow", slow), quality.Rule("quick", lambda d: b"w1" in d.text)]
    assert [r.name for r in quality.fit_order(table(rows), rules)][0] == "quick"


def test_keep_good_returns_whole_rows(table):
    docs = table(corpus(7)).withColumn("kept", docs_extra()).withColumn("n_words", docs_extra())
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids
    assert kept.filter("kept != 'extra'").count() == 0


def docs_extra():
    from pyspark.sql import functions as F

    return F.lit("extra")


def test_empty_table(table):
    empty = table([(1, "x")]).filter("doc_id = 0")
    assert quality.judge(empty).count() == 0 and quality.keep_good(empty).count() == 0
