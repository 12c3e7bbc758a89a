from __future__ import annotations

import pytest
from pyspark.sql import types as T

from conftest import SF_DIR
from millrace import sources, streaming
from millrace.operators import lines, relational

TEXT = "id,user,product,category,amount,at\n1,101,Pen,Home,50,2025-02-01\n2,102,TV,Tech,65000,2025-02-02\n3,101,Cup,Home,70,2025-02-03\n"
SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("user", T.IntegerType()),
        T.StructField("product", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("at", T.StringType()),
    ]
)


@pytest.fixture
def path(tmp_path):
    (tmp_path / "t.csv").write_text(TEXT)
    return str(tmp_path / "t.csv")


def test_rdd_and_dataframe_forms_agree(spark, path):
    rdd = lines.fields_rdd(lines.lines_rdd(spark, path, skip_header=True), [int, int, str, str, int, str])
    text = sources.scan_lines(spark, path, TEXT.splitlines()[0])
    for quotes in (True, False):
        df = lines.parse_lines(text, SCHEMA, quotes=quotes)
        assert sorted(map(tuple, df.collect())) == sorted(rdd.collect())
    assert dict(lines.sum_by_key_rdd(rdd, 3, 4).collect()) == dict(
        map(tuple, relational.sum_by_key(df, ["category"], "amount").collect())
    )
    assert lines.sum_rdd(rdd, 4) == lines.column_sum(df, "amount").first()[0] == 65120
    assert lines.count_rdd(rdd, lambda r: r[4] > 50000) == lines.count_where_greater(df, "amount", 50000).first()[0] == 1


def test_sums_over_nothing(spark):
    assert lines.sum_rdd(lines.values_rdd(spark, [], 2), 0) == 0
    assert lines.column_sum(spark.createDataFrame([], "v int"), "v").first()[0] is None


def test_parsing_quotes_and_bad_fields(spark):
    text = spark.createDataFrame([('1,2,"a, b",c,5,x',), ("y,2,a,c,z,x",)], "value string")
    quoted = lines.parse_lines(text, SCHEMA).collect()
    assert quoted[0]["product"] == "a, b" and quoted[0]["amount"] == 5
    naive = lines.parse_lines(text, SCHEMA, quotes=False).collect()
    assert naive[0]["product"] == '"a' and naive[1]["id"] is None and naive[1]["user"] == 2


def test_words_keep_empty_pieces(spark):
    df = spark.createDataFrame([("a  b",), ("",), (None,)], "value string")
    assert [r[0] for r in streaming.split_words(df).collect()] == ["a", "", "b", ""]


def test_stream_counts_equal_batch_counts(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("text")
    replayed = streaming.replay_table(docs, files=3)
    counts = streaming.count_words(streaming.split_words(replayed, "text"))
    query = streaming.drain(streaming.complete_to_files(counts, f"{tmp_path}/out"), 120)
    assert len(query.recentProgress) >= 3
    batch = streaming.count_words(streaming.split_words(docs, "text"))
    assert spark.read.parquet(f"{tmp_path}/out").exceptAll(batch).count() == 0
    assert spark.read.parquet(f"{tmp_path}/out").count() == batch.count()


def test_a_restarted_stream_continues_from_its_checkpoint(spark, tmp_path):
    source, state = tmp_path / "in", f"{tmp_path}/state"
    for text in ("a a b", "b c"):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").parquet(str(source))
        stream = streaming.open_stream(spark, "parquet", schema=T.StructType([T.StructField("value", T.StringType())]), path=str(source))
        counts = streaming.count_words(streaming.split_words(stream))
        streaming.drain(streaming.complete_to_files(counts, f"{tmp_path}/out", checkpoint=state), 120)
    found = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert found == {("a", 2), ("b", 2), ("c", 1)}


def test_memory_sink_and_rate_source(spark):
    stream = streaming.open_stream(spark, "rate", rowsPerSecond=50)
    query = streaming.memory_sink(stream.select("value"), "rates", "append", continuous=True)
    while not spark.table("rates").count():
        query.processAllAvailable()
    query.stop()
    assert spark.table("rates").agg({"value": "min"}).first()[0] == 0


def test_complete_mode_needs_an_aggregation(spark, tmp_path):
    stream = streaming.open_stream(spark, "rate")
    with pytest.raises(Exception, match="omplete"):
        streaming.complete_to_files(stream, f"{tmp_path}/out")


def test_replayed_files_follow_the_size(spark, monkeypatch):
    from millrace.streaming import sources

    rows, paths = spark.range(3000), []
    monkeypatch.setattr(sources, "stream_tables", lambda spark, path, *rest: paths.append(path))
    streaming.replay_table(rows)
    monkeypatch.setattr(sources, "REPLAY_BYTES", 5_000)
    streaming.replay_table(rows)
    few, more = (len(spark.read.parquet(path).inputFiles()) for path in paths)
    assert few == 4 and more == -(-sources.measure(rows)[1] // 5_000) > 4
