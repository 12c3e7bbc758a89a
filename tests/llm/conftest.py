from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def table(spark):
    """A documents table from (doc_id, text) pairs."""

    def make(rows):
        full = [(i, t, None if i is None else "en", "src0", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


def corpus(seed: int, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Invented texts with shared passages, near and exact copies, junk and odd cases."""
    rng = random.Random(seed)
    words = [f"w{i}" if i % 5 else f"É{i}," for i in range(400)]
    some = lambda k: [rng.choice(words) for _ in range(k)]
    passages = [some(rng.choice([8, 15, 25, 60, 130])) for _ in range(8)]
    rows: list[tuple[int | None, str | None]] = []
    for i in range(n):
        kind = rng.random()
        parts = some(rng.randint(0, 90))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(parts))
            parts[at:at] = rng.choice(passages)
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "\t", "  "]) for w in parts)
        if kind < 0.15 and rows:
            text = rows[rng.randrange(len(rows))][1] or ""
        elif kind < 0.3 and rows:
            near = (rows[rng.randrange(len(rows))][1] or "a b").split(" ")
            near[rng.randrange(len(near))] = "changed"
            text = " ".join(near)
        elif kind < 0.35:
            text = "la la di " * rng.randint(1, 150)
        rows.append((i * 3, text))
    return [*rows, (1000, None), (1001, ""), (1002, " \n "), (1003, "one"), (None, "no id " * 30), rows[0], (3, "other text under id 3")]
