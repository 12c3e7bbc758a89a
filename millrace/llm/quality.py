"""Quality rules as a short-circuit cascade.

Every rule turns a document away on its own, so their order changes what the cascade
costs, never what it keeps.  A bounded sample (``sample_docs`` rows chosen by a hash of the
document) gives each rule's cost per byte and which documents it rejects; rules are then
ordered greedily by rejections per second among the documents that the rules before them
let pass.  In the cascade a rule sees only the rows that are still alive.

The base measures are taken of every document: n_words, word_chars (code points in words),
n_symbols (``# * $ % & | < >``), n_dup_lines (lines with a word, equal to an earlier line)
and n_repeat_words (words in 3-word windows found twice or more).

Defined cases: a null or empty text has no words and fails the base; repeated rows and null
ids are judged like any other row; an empty table gives no rows; other columns are
ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, kept boolean, rejected_by string"


@dataclass(frozen=True)
class Doc:
    """One document as rules see it: its bytes, its words and its base measures."""

    text: bytes
    words: list[bytes]
    base: dict[str, int]


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Doc], bool]


def _letters(doc: Doc) -> bool:
    bare = sum(not any(c > 127 or chr(c).isalpha() for c in w) for w in doc.words)
    return 5 * bare > 2 * len(doc.words)


def _line_share(test: Callable[[bytes], bool], share: float) -> Callable[[Doc], bool]:
    def rejects(doc: Doc) -> bool:
        lines = [x for x in (line.strip() for line in doc.text.split(b"\n")) if x]
        return len(lines) > 2 and sum(map(test, lines)) > share * len(lines)

    return rejects


def _shouts(doc: Doc) -> bool:
    return 2 * sum(w.endswith((b"!!", b"??")) for w in doc.words) > len(doc.words)


def _digits(doc: Doc) -> bool:
    left = doc.text.translate(None, b"0123456789" + WHITE)
    return 2 * len(left) < len(doc.text.translate(None, WHITE))


def _controls(doc: Doc) -> bool:
    bad = bytes(c for c in range(32) if c not in WHITE) + b"\x7f"
    broken = len(doc.text) - len(doc.text.translate(None, bad)) + doc.text.count("�".encode())
    return 50 * broken > len(doc.text)


#: Shares of clean prose lie far from all of these bounds.
RULES = (
    Rule("many_symbols", lambda d: 10 * d.base["n_symbols"] > len(d.words)),
    Rule("word_length", lambda d: not 2 * len(d.words) <= d.base["word_chars"] <= 20 * len(d.words)),
    Rule("repeated_lines", lambda d: 2 * d.base["n_dup_lines"] > d.text.count(b"\n") + 1),
    Rule("few_letters", _letters),
    Rule("cut_off_lines", _line_share(lambda x: x.endswith((b"...", "…".encode())), 0.5)),
    Rule("bullet_lines", _line_share(lambda x: x.startswith((b"- ", b"* ", "•".encode())), 0.9)),
    Rule("shouting", _shouts),
    Rule("few_words_repeated", lambda d: len(d.words) >= 200 and 20 * len(set(d.words)) < len(d.words)),
    Rule("mostly_digits", _digits),
    Rule("broken_characters", _controls),
)


def _measure(part: tk.Slice) -> Iterator[Doc]:
    """The documents of a slice with their base measures."""
    _, _, rows, hashes = part.words()
    windows = tk.window_hash(hashes, 3)
    for i in range(len(part)):
        text = part.text(i)
        a, b = int(rows[i]), int(rows[i + 1])
        n_repeat = 0
        if b - a >= 3:
            own = windows[a : b - 2]
            _, place, times = np.unique(own, return_inverse=True, return_counts=True)
            twice = np.flatnonzero(times[place] > 1)
            if len(twice):
                marked = np.zeros(b - a, bool)
                for d in range(3):
                    marked[twice + d] = True
                n_repeat = int(marked.sum())
        lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
        solid = np.frombuffer(text.translate(None, WHITE), np.uint8)
        base = {
            "n_words": b - a,
            "word_chars": int(np.count_nonzero((solid & 0xC0) != 0x80)),
            "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
            "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": n_repeat,
        }
        yield Doc(text, text.split(), base)


def base_fails(base: dict[str, int], least_words: int = 50) -> bool:
    return base["n_words"] < least_words or 100 * base["n_repeat_words"] > 50 * base["n_words"]


def _probe(rules: Sequence[Rule]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, masks = [0.0] * len(rules), []
        for batch in batches:
            for part in tk.slices(batch.column("text")):
                for doc in _measure(part):
                    if base_fails(doc.base):
                        continue
                    mask = 0
                    for i, rule in enumerate(rules):
                        began = time.perf_counter()
                        mask |= rule.rejects(doc) << i
                        spent[i] += time.perf_counter() - began
                    masks.append(mask)
        yield pa.RecordBatch.from_arrays(
            [pa.array([masks], pa.list_(pa.int64())), pa.array([spent], pa.list_(pa.float64()))],
            names=["masks", "spent"],
        )

    return run


def fit_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_docs: int = 2000) -> list[Rule]:
    """Rules in the order of the cascade, from a sample of at most ``sample_docs`` rows.

    Only two arrays come back: a bit mask per sampled row and the seconds per rule."""
    share = min(1.0, 2 * sample_docs / max(1, docs.count()))
    chance = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1)
    sample = docs.filter(chance).limit(sample_docs).select(F.coalesce("text", F.lit("")).alias("text"))
    probed = sample.coalesce(1).mapInArrow(_probe(rules), "masks array<bigint>, spent array<double>").first()
    if probed is None or not probed.masks:
        return list(rules)
    masks, left, order = np.array(probed.masks), list(range(len(rules))), []
    while left:
        def worth(i: int) -> tuple[float, float]:
            return (float(((masks >> i) & 1).sum()) / (probed.spent[i] + 1e-9), -probed.spent[i])

        best = max(left, key=worth)
        order.append(rules[best])
        left.remove(best)
        masks = masks[(masks >> best) & 1 == 0]
    return order


def _cascade(rules: Sequence[Rule]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for part in tk.slices(batch.column("text")):
                for doc in _measure(part):
                    failed = base_fails(doc.base)
                    by = "base" if failed else next((r.name for r in rules if r.rejects(doc)), None)
                    rows.append((*doc.base.values(), failed, by is None, by))
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                names=[*batch.schema.names[:-1], *BASE, "base_failed", "kept", "rejected_by"],
            )

    return run


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """One row per document: the base measures, base_failed, kept and the rule that fired first."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(_cascade(fit_order(docs) if rules is None else rules), VERDICT)


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that pass the base and every rule, unchanged."""
    own = [f"_c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*own)
    text = F.coalesce(F.col(own[docs.columns.index("text")]), F.lit(""))
    verdict = [T.StructField(c, T.LongType()) for c in BASE] + [
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("rejected_by", T.StringType()),
    ]
    schema = T.StructType([*inner.schema.fields, *verdict])
    judged = inner.withColumn("text", text).mapInArrow(
        _cascade(fit_order(docs) if rules is None else rules), schema
    )
    return judged.filter("kept").select(*own).toDF(*docs.columns)
