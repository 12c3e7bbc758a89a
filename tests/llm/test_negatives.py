from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from millrace.llm import negatives
from millrace.llm.negatives import Heaps, Mining, strassen

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
)


def brute(rows, conf=Mining()):
    """The contract read literally, over (vec_id, embedding, label)."""
    own = []
    for i, x, label in rows:
        if i is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        x = [math.floor(256 * float(np.float32(v))) for v in x]
        own.append((i, x, int(math.fmod(label + 1, 10)) if i % 7 == 0 else label))
    score = lambda x, y: sum(a * b for a, b in zip(x, y))
    out = []
    for i, x, label in own:
        if i % conf.every:
            continue
        ranked = sorted((-score(x, y), j, other) for j, y, other in own if j != i)
        for p, j, _ in [r for r in ranked if r[2] == label][: conf.positives]:
            fit = [r for r in ranked if r[2] != label and conf.low * -p <= 100 * -r[0] <= conf.high * -p]
            out += [(i, j, n + 1, r[1], -p, -r[0]) for n, r in enumerate(fit[: conf.negatives])]
    return sorted(out)


def found(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert df.columns == names
    return sorted(tuple(r) for r in df.collect())


def vectors(seed, n, width=12, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (4, width))
    kind = rng.integers(0, 4, n)
    x = centres[kind] + rng.normal(0, 0.6, (n, width))
    return [(int(i), [float(np.float32(v)) for v in x[i]], int(rng.integers(0, 10)) if i % 3 else int(kind[i])) for i in range(n)]


@pytest.mark.parametrize("shape", [(1, 1, 1), (40, 64, 33), (17, 9, 65), (100, 3, 100), (64, 0, 8), (130, 70, 129)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (k, n))
    assert np.array_equal(strassen(a, b), a @ b)
    huge = rng.integers(-(2**62), 2**62, (m, k))
    assert np.array_equal(strassen(huge, b), huge @ b)


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(3)
    owner, score, ids = rng.integers(0, 6, 400), rng.integers(0, 12, 400), rng.permutation(400)
    want = {o: sorted((-s, i) for w, s, i in zip(owner, score, ids) if w == o)[:4] for o in range(6)}
    for parts in (1, 7, 50):
        heaps = Heaps(6, 4)
        for some in np.array_split(rng.permutation(400), parts):
            heaps.merge(owner[some], score[some], ids[some])
        got = {o: [(-s, i) for w, s, i in zip(heaps.owner, heaps.score, heaps.ids) if w == o] for o in range(6)}
        assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    rows = vectors(seed, 700)
    want = brute(rows)
    assert len(want) > 50
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(negatives.mine(table.repartition(5))) == want
    conf = Mining(every=7, positives=2, negatives=4, low=20, high=110)
    assert found(negatives.mine(table, conf)) == brute(rows, conf)


def test_small_groups_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP", 4)
    rows = vectors(5, 600, 7)
    assert found(negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_ties_by_smaller_id(spark):
    rows = [(i, [(1.0, 0.8, 0.6)[i % 3]], 1 if i % 5 < 2 else 2) for i in range(101)]
    want = brute(rows)
    assert want and found(negatives.mine(spark.createDataFrame(rows, SCHEMA))) == want


def test_odd_rows_take_no_part_and_columns_do_not_clash(spark):
    rows = vectors(9, 300, 5)
    odd = [
        (None, [1.0] * 5, 1), (400, None, 1), (401, [1.0] * 5, None), (450, [1.0, None, 1.0, 1.0, 1.0], 2),
        (402, [float("nan")] * 5, 1), (500, [float("inf")] * 5, 1), (403, [], 1), (404, [0.5, 0.5], 3), (550, [], 2),
    ]
    want = brute(rows + odd)
    wide = T.StructType([*SCHEMA.fields, T.StructField("g", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("tile", T.BinaryType())])
    table = spark.createDataFrame([(*r, 1, "x", b"y") for r in rows + odd], wide)
    assert found(negatives.mine(table)) == want


def test_repeated_rows_have_places_of_their_own(spark):
    rows = vectors(4, 200, 6)
    assert found(negatives.mine(spark.createDataFrame(rows + rows[:60], SCHEMA))) == brute(rows + rows[:60])


def test_no_rows(spark):
    for rows in ([], [(1, [1.0], 1), (2, [1.0], 2)], [(50, [1.0], 1)]):
        assert found(negatives.mine(spark.createDataFrame(rows, SCHEMA))) == []
