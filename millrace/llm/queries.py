"""The operators of this package as queries over whole tables, and SQL to check them by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import shared_dir
from . import alignment, fingerprints, lines, near, negatives, packing, pieces, quality, quotes, substring, suffixes, tokencount, tokenfile
from .frames import documents, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(documents(spark, sf_dir), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept_words_sha256").alias("kept_sha256"))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir), near.Near(shingle=3, num=85, den=100))


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    tokenfile.write_store(documents(spark, sf_dir), folder, vocabulary("byte_bpe_50k.json"), end_id=2)
    return tokenfile.read_store(spark, folder)


@query
def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), "word", end_id=1)


@query
def op10_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_report(documents(spark, sf_dir))


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(documents(spark, sf_dir), width=400).drop("kept")


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(documents(spark, sf_dir))


@query
def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


SQL["op12_hard_negatives"] = """
WITH kept AS (
  SELECT vec_id, CAST(label AS BIGINT) AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
own AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, vec FROM kept),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum([x * coalesce(b.vec[i], 0) FOR x, i IN a.vec]) AS BIGINT) AS score
  FROM own a JOIN own b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
