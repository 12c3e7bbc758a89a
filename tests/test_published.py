from __future__ import annotations

from pyspark.sql import types as T

from millrace import streaming

WORD = T.StructType([T.StructField("value", T.StringType())])


def counted(spark, source):
    return streaming.count_words(streaming.split_words(streaming.open_stream(spark, "parquet", schema=WORD, path=source)))


def add(spark, source, text):
    spark.createDataFrame([(text,)], WORD).coalesce(1).write.mode("append").parquet(source)


def rows(spark, path):
    return {tuple(r) for r in streaming.read_published(spark, path, "word string, count bigint").collect()}


def test_a_reader_sees_one_whole_result_at_any_time(spark, tmp_path):
    source, state, out = f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/out"
    assert rows(spark, out) == set()
    add(spark, source, "a a b")
    streaming.drain(streaming.publish_complete(counted(spark, source), out, state), 120)
    first = {("a", 2), ("b", 1)}
    assert rows(spark, out) == first
    # A trigger that failed before its entry: its folder is there, whole or not, and nobody reads it.
    spark.createDataFrame([("half", 1)], "word string, count bigint").write.parquet(f"{out}/results/1-broken")
    assert rows(spark, out) == first
    opened = streaming.read_published(spark, out, "word string, count bigint")
    add(spark, source, "b c")
    streaming.drain(streaming.publish_complete(counted(spark, source), out, state), 120)
    assert rows(spark, out) == {("a", 2), ("b", 2), ("c", 1)}
    assert {tuple(r) for r in opened.collect()} == first


def test_a_trigger_that_runs_again_is_one_result(spark, tmp_path):
    out = f"{tmp_path}/out"
    for folder, n in (("5-aaa", 1), ("5-bbb", 1), ("4-ccc", 9)):
        spark.createDataFrame([("w", n)], "word string, count bigint").write.parquet(f"{out}/results/{folder}")
        entry = spark.createDataFrame([(int(folder[0]), f"{out}/results/{folder}")], "batch long, folder string")
        entry.write.mode("append").parquet(f"{out}/published")
    assert rows(spark, out) == {("w", 1)}


def test_old_results_give_their_space_back(spark, tmp_path):
    source, state, out = f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/out"
    for text in ("a", "b", "c", "d"):
        add(spark, source, text)
        streaming.drain(streaming.publish_complete(counted(spark, source), out, state), 120)
    entries = streaming.published(spark, out)
    assert [r["batch"] for r in entries] == [0, 1, 2, 3]
    sizes = [spark.read.parquet(r["folder"]).count() for r in entries]
    assert sizes == [0, 0, 3, 4]


def test_state_of_a_stopped_count(spark, tmp_path):
    source, state, out = f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/out"
    for text in ("a b", "b c c"):
        add(spark, source, text)
        streaming.drain(streaming.publish_complete(counted(spark, source), out, state), 120)
    assert {tuple(r) for r in streaming.read_state(spark, state).collect()} == {("a", 1), ("b", 2), ("c", 2)} == rows(spark, out)
