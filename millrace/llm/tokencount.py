"""Token counts of whole texts by the compiled transducers of ``transducer``.

Each task counts its own documents; nothing is shuffled.  Texts are joined to slices of about
``tk.SLICE_BYTES``; a longer text is cut before blanks, where every machine is in its first state,
so its memory is bounded too (but for a text without any blank).

Defined cases: a null or empty text has no bytes and no tokens; rows with a null or a
repeated id are documents like any other; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .transducer import counter


def parts(text: str, limit: int) -> Iterator[str]:
    """A long text in pieces of about ``limit`` characters that begin with a blank."""
    at = 0
    while len(text) - at > limit:
        cut = text.find(" ", at + limit)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _count(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(path)
        for batch in batches:
            counts: list[int] = []
            for part in tk.slices(batch.column("text")):
                texts = batch.column("text").slice(part.first, len(part)).to_pylist()
                if len(texts) == 1:
                    counts.append(sum(int(machine.count([p])[0]) for p in parts(texts[0], tk.SLICE_BYTES)))
                else:
                    counts += machine.count(texts).tolist()
            columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, and whether that is more than ``limit``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes")
    )
    counted = plain.mapInArrow(_count(path), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
