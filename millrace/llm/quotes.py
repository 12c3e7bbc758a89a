"""Conversations without quotations, each message linked to the one it quotes.

A line's quote level is the number of ``>`` it begins with.  Consecutive lines of one level
above 0 are a quoted passage; the rest is the message's own text.  Passages are normalised
(lower case, single blanks) and hashed, and looked up among the own texts, their parts between
quotations, paragraphs and lines of the same conversation; passages of several lines also
wherever their lines follow each other in an own text, blank lines and quotations between them
left out.  The original is the first message that has the passage, if it comes before the
quoting one.  A passage that begins or ends inside a line of its original is not found.  A message replies to the latest original of its outermost linked
quotes; messages without one begin threads.  Threads come in the order of their first message and
messages in a thread by turn, so that every reply follows what it replies to.

Defined cases: a null or empty text has no lines; null conversations are one conversation
and a null turn comes before all others; repeated rows are messages of their own with equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from .frames import LEAST

PARSED = (
    "conv_id bigint, turn bigint, role string, _c bigint, _t bigint, _h bigint, own string, "
    "hashes array<bigint>, lines array<bigint>, quotes array<struct<level:int,hash:bigint,lines:array<bigint>>>"
)
QUOTE = pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("lines", pa.list_(pa.int64()))])
PREFIX = re.compile(r"(?:[ \t]*>)+ ?")


def passage_hash(text: str) -> int | None:
    """Of the normalised passage; None if nothing is left."""
    plain = " ".join(text.lower().split())
    return int.from_bytes(hashlib.blake2b(plain.encode(), digest_size=8).digest(), "big", signed=True) if plain else None


def line_hashes(text: str) -> list[int]:
    """Of the lines with something in them."""
    return [h for h in map(passage_hash, text.split("\n")) if h is not None]


def _cut(text: str) -> tuple[list[list[str]], list[tuple[int, list[str]]]]:
    """The lines of a message's own text, cut where quotations stood, and of its quoted
    passages with their levels, in order."""
    own: list[list[str]] = [[]]
    passages: list[tuple[int, list[str]]] = []
    before = 0
    for line in text.split("\n"):
        found = PREFIX.match(line)
        level = found.group().count(">") if found else 0
        if not level:
            if before:
                own.append([])
            own[-1].append(line)
        elif level == before:
            passages[-1][1].append(line[found.end() :])
        else:
            passages.append((level, [line[found.end() :]]))
        before = level
    return own, passages


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """A message's own text, and its quoted passages with their levels, in order."""
    own, passages = _cut(text)
    quoted = [(level, "\n".join(lines)) for level, lines in passages]
    return ("\n".join(line for part in own for line in part).strip("\n") if quoted else text), quoted


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owns, hashes, lines, quotes = [], [], [], []
        for text in batch.column("text").to_pylist():
            own, quoted = parse(text)
            parts = {own, *("\n".join(part) for part in _cut(text)[0])}
            parts |= {paragraph for part in parts for paragraph in re.split(r"\n[ \t\r]*\n", part)}
            owns.append(own)
            lines.append(line_hashes(own))
            hashes.append(sorted({*lines[-1], *(h for h in map(passage_hash, parts) if h is not None)}))
            known = [(level, passage_hash(passage), line_hashes(passage)) for level, passage in quoted]
            quotes.append([{"level": level, "hash": h, "lines": own} for level, h, own in known if h is not None])
        columns = [batch.column(c) for c in ("conv_id", "turn", "role", "_c", "_t", "_h")]
        columns += [pa.array(owns, pa.string()), pa.array(hashes, pa.list_(pa.int64())), pa.array(lines, pa.list_(pa.int64()))]
        columns += [pa.array(quotes, pa.list_(QUOTE))]
        names = ["conv_id", "turn", "role", "_c", "_t", "_h", "own", "hashes", "lines", "quotes"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _runs(parsed: DataFrame, quoted: DataFrame) -> DataFrame:
    """(_c, run, original): the first message whose own text has the lines of a quoted passage
    in a row.  Only places that begin with the first two lines of a passage are hashed, in the
    lengths that passages with this beginning have."""
    lengths = quoted.filter("run is not null").select("_c", "pair", "m").distinct()
    pairs = F.expr("transform(sequence(0, size(lines) - 2), i -> xxhash64(lines[i], lines[i + 1]))")
    places = parsed.filter("size(lines) > 1").select("_c", "_t", "_h", F.posexplode(pairs).alias("at", "pair"))
    hits = places.join(lengths, ["_c", "pair"]).groupBy("_c", "_t", "_h").agg(F.collect_set(F.struct("at", "m")).alias("hits"))
    inside = "filter(hits, x -> x.at + x.m <= size(lines))"
    runs = F.expr(f"transform({inside}, x -> xxhash64(slice(lines, x.at + 1, x.m)))")
    found = parsed.select("_c", "_t", "_h", "lines").join(hits, ["_c", "_t", "_h"]).select("_c", "_t", F.explode(runs).alias("run"))
    return found.groupBy("_c", "run").agg(F.min("_t").alias("by_lines"))


def _roots(replies: DataFrame) -> DataFrame:
    """(_c, _t, root) for messages (_c, _t, parent): pointers are doubled until they rest."""
    now = stage(replies.select("_c", "_t", F.col("parent").alias("root")), "threads")
    while True:
        above = now.select("_c", F.col("_t").alias("root"), F.col("root").alias("above"))
        moved = now.join(above, ["_c", "root"], "left")
        if moved.filter("above is not null").isEmpty():
            return now
        now = stage(moved.select("_c", "_t", F.coalesce("above", "root").alias("root")), "threads")


def link_quotations(messages: DataFrame) -> DataFrame:
    """One row per message, in reply order: its own text, how many passages it quotes and how
    many of them were found, the turn it replies to and the turn that began its thread."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(LEAST))
    plain = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
        key("conv_id").alias("_c"), key("turn").alias("_t"), F.xxhash64(text).alias("_h"), text.alias("text"),
    )
    parsed = stage(plain.mapInArrow(_parse, PARSED), "messages")
    first = parsed.select("_c", "_t", F.explode("hashes").alias("hash")).groupBy("_c", "hash").agg(F.min("_t").alias("original"))
    quoted = parsed.select("_c", "_t", "_h", F.explode("quotes").alias("q")).select("_c", "_t", "_h", "q.*")
    quoted = quoted.select(
        "_c", "_t", "_h", "level", "hash", F.size("lines").alias("m"), F.expr("if(size(lines) > 1, xxhash64(lines), null)").alias("run"),
        F.expr("if(size(lines) > 1, xxhash64(lines[0], lines[1]), null)").alias("pair"),
    ).distinct()
    quoted = stage(quoted, "quotes")
    found = quoted.join(first, ["_c", "hash"], "left").join(_runs(parsed, quoted), ["_c", "run"], "left")
    found = found.withColumn("original", F.least("original", "by_lines")).filter("original < _t")
    replies = found.groupBy("_c", "_t", "_h").agg(
        F.collect_set(F.struct("hash", F.coalesce("run", F.lit(0)).alias("run"))).alias("linked"), F.min(F.struct("level", (-F.col("original")).alias("back"))).alias("best")
    )
    replies = stage(replies.withColumn("parent", -F.col("best.back")).drop("best"), "replies")
    roots = _roots(replies.groupBy("_c", "_t").agg(F.min("parent").alias("parent")))
    joined = parsed.join(replies, ["_c", "_t", "_h"], "left").join(roots, ["_c", "_t"], "left")
    run = "if(size(q.lines) > 1, xxhash64(q.lines), 0L)"
    linked = F.expr(f"filter(quotes, q -> array_contains(linked, struct(q.hash as hash, {run} as run)))")
    turn = lambda c: F.when(F.col(c) != LEAST, F.col(c))
    rows = joined.select(
        "conv_id", "turn", "role", F.col("own").alias("text"), F.size("quotes").cast("bigint").alias("n_quotes"),
        F.when(F.col("linked").isNull(), 0).otherwise(F.size(linked)).cast("bigint").alias("n_linked"),
        turn("parent").alias("reply_to"), F.coalesce("root", "_t").alias("_r"),
    )
    return rows.withColumn("thread", turn("_r")).orderBy("conv_id", "_r", "turn").drop("_r")
