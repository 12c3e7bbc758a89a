from __future__ import annotations

import corpus_pipeline
from millrace.llm import near, packing, quality, substring

from .conftest import corpus
from .test_lines import brute as brute_lines
from .test_near import brute as brute_near
from .test_substring import brute as brute_substring


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_each_stage_against_brute_force(spark, table):
    rows = [(i, t) for i, t in corpus(21, 80) if i is not None and (i, t) != (3, "other text under id 3")][:-1]
    rows = [(i, (t or "").translate(str.maketrans("0123456789", "abcdefghij"))) for i, t in rows]
    docs = table(rows)
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert len(rows) > 10
        out = step(spark, docs, "")
        assert out.columns == docs.columns
        got = rows_of(out)
        if name == "quality rules":
            good = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
            assert got == sorted((i, t) for i, t in rows if i in good)
        elif name == "line dedup":
            gone = {r[0]: set(r[3]) for r in brute_lines(rows)}
            keep = lambda i, t: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])
            assert got == sorted((i, keep(i, t)) for i, t in rows)
        elif name == "MinHash near-dedup":
            kept = {r[0] for r in brute_near(rows, near.Near()) if r[3]}
            assert got == sorted((i, t) for i, t in rows if i in kept)
        else:
            left = {r[0]: r[1] - r[2] for r in brute_substring(rows, 50)}
            assert {i: len(t.split()) for i, t in got} == left
            assert all(r.n_chars == len(r.text) for r in out.collect())
        rows, docs = got, table(got)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0


def test_columns_and_nulls_survive(spark, table):
    docs = table([(1, None), (2, "x y"), (None, "z")]).withColumnRenamed("source", "rest")
    for _, step in corpus_pipeline.STAGES[1:-1]:
        out = step(spark, docs, "")
        assert out.dtypes == docs.dtypes and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
