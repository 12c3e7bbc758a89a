from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import sinks, sources
from millrace.operators import columns
from millrace.workspace import EMBED_BYTES, EMBED_ROWS, freeze, shared_dir, staged


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_csv_names_are_stripped_and_files_traced(spark, tmp_path):
    write(tmp_path, "Monday-WorkingHours.csv", " a, b \n1,x\n")
    write(tmp_path, "Friday-WorkingHours.csv", " a, b \n2,y\n")
    df = sources.scan_csv(spark, f"{tmp_path}/*.csv", lineage_pattern=r"(\w+-WorkingHours)")
    assert {tuple(r) for r in df.collect()} == {(1, "x", "Monday-WorkingHours"), (2, "y", "Friday-WorkingHours")}


def test_csv_leading_blanks_are_kept_unless_trimmed(spark, tmp_path):
    path = write(tmp_path, "a.csv", "n,s\n 40000,p\n30000, p\n")
    assert sources.scan_csv(spark, path).schema["n"].dataType == T.DoubleType()
    trimmed = sources.scan_csv(spark, path, trim_values=True)
    assert trimmed.schema["n"].dataType == T.IntegerType()
    assert trimmed.select("s").distinct().count() == 1


def test_csv_repeated_headers_are_renamed_by_position(spark, tmp_path):
    df = sources.scan_csv(spark, write(tmp_path, "a.csv", " H,x, H\n1,2,3\n"))
    assert columns.rename_at(df, {2: "H2", 0: "H"}).columns == ["H", "x", "H2"]
    with pytest.raises(KeyError):
        columns.rename_columns(df, {"absent": "b"})
    assert columns.rename_columns(df, {"absent": "b"}, strict=False).columns == df.columns


def test_csv_malformed_rows_are_dropped_or_quarantined(spark, tmp_path):
    path = write(tmp_path, "a.csv", "i,s\n1,a\n1.5,b\n3000000000,c\nx,d\n5,e\n")
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("s", T.StringType())])
    assert [r["i"] for r in sources.scan_csv(spark, path, schema=schema).collect()] == [1, 5]
    kept = sources.quarantine_csv(spark, path, schema).collect()
    assert [r["_corrupt_record"] for r in kept] == [None, "1.5,b", "3000000000,c", "x,d", None]
    with pytest.raises(Exception, match="MALFORMED"):
        sources.scan_csv(spark, path, schema=schema, mode="FAILFAST").collect()


def test_flow_schema():
    schema = sources.flow_schema()
    kinds = [f.dataType.simpleString() for f in schema.fields]
    assert {k: kinds.count(k) for k in set(kinds)} == {"int": 52, "bigint": 2, "double": 24, "string": 1}
    assert schema.names[34] == "Fwd Header Length" and schema.names[55] == "Fwd Header Length.1"


def test_columns_with_dots_and_blanks(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], ["a.b", "c d/s", "s"])
    assert columns.select_columns(df, ["a.b"]).first()[0] == 1
    assert columns.numeric_columns(df, exclude=["a.b"]) == ["c d/s"]
    assert [tuple(r)[1:] for r in columns.schema_profile(df).collect()] == [
        ("a.b", "bigint", 1), ("c d/s", "double", 1), ("s", "string", 1),
    ]


def test_partitioned_write_keeps_rows_and_drops_vectors(spark, tmp_path):
    from millrace.operators.features import assemble

    df = assemble(spark.range(50).withColumn("flag", (F.col("id") % 7 == 0).cast("int")), ["id"])
    path = f"{tmp_path}/data"
    sinks.write_partitioned(df, path, ["flag"])
    back = sources.scan_parquet(spark, path)
    assert back.columns == ["id", "flag"] and back.count() == 50
    rows = {r["flag"]: (r["row_count"], r["column_count"]) for r in sinks.validate_output(spark, path, ["flag"]).collect()}
    assert rows == {1: (8, 2), 0: (42, 2)}
    one = sources.scan_parquet(spark, f"{path}/flag=1", base_path=path)
    assert one.columns == ["id", "flag"] and one.count() == 8


def test_rebalanced_write_splits_a_dominant_value(spark):
    df = spark.range(1000).withColumn("flag", F.lit(1))
    assert "REBALANCE" in df.hint("rebalance", F.col("flag"))._jdf.queryExecution().optimizedPlan().toString().upper()


def test_summary_is_one_ordered_file_beside_the_data(spark, tmp_path):
    data = f"{tmp_path}/data/"
    path = sinks.sibling_path(data, "summary")
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n int").orderBy(F.desc("n"))
    sinks.write_csv_summary(df, path, data)
    files = list((tmp_path / "data_summary").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().split() == ["k,n", "b,3", "a,1"]
    for inside in (data, f"{data}sub", f"{tmp_path}/data"):
        with pytest.raises(ValueError):
            sinks.check_separate(inside, data)
    sinks.check_separate(f"{tmp_path}/data2", data)


def test_jdbc_options_need_no_server():
    options = sinks.jdbc_options("jdbc:x", "t", {"user": "u"}, 3, 500)
    assert options == {"user": "u", "url": "jdbc:x", "dbtable": "t", "numPartitions": "3", "batchsize": "500"}
    with pytest.raises(ValueError):
        sinks.jdbc_options("jdbc:x", "t", {"url": "other"}, 3, 500)


def test_inline_tables(spark):
    assert sources.inline_rows(spark, [(25, 50000, 0)], ["age", "income", "label"]).first()["income"] == 50000
    values = sources.inline_values(spark, [1, "404", None], "v")
    assert [r["v"] for r in values.collect()] == ["1", "404", None]
    assert sources.view_query(values, "inline_view", "SELECT count(v) AS n FROM {inline_view}").first()["n"] == 2


def test_frozen_tables_are_embedded_or_staged(spark):
    small = freeze(spark.range(5).toDF("x"), "small")
    assert small.rows == 5 and "LocalRelation" in small.table._jdf.queryExecution().optimizedPlan().toString()
    many = freeze(spark.range(EMBED_ROWS + 1).toDF("x"), "many")
    assert many.rows == EMBED_ROWS + 1 and many.table.inputFiles()
    wide = freeze(spark.range(9).select(F.repeat(F.lit("x"), 1 << 20).alias("x")), "wide")
    assert wide.rows == 9 and wide.size > EMBED_BYTES and wide.table.inputFiles()
    derived = freeze(small.table.withColumn("y", F.lit(1)), "derived", small)
    assert (derived.rows, derived.table.count()) == (5, 5)
    assert shared_dir(spark, "p").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_staged_tables_are_deleted(spark):
    with staged(spark.range(3).toDF("x"), "brief") as df:
        assert df.count() == 3
        path = df.inputFiles()[0]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_a_summary_of_too_many_rows_is_refused_before_anything_is_written(spark, tmp_path):
    rows = spark.range(50)
    with pytest.raises(ValueError, match="more than 49 rows"):
        sinks.write_csv_summary(rows, f"{tmp_path}/many", max_rows=49)
    assert not (tmp_path / "many").exists()
    sinks.write_csv_summary(rows, f"{tmp_path}/all", max_rows=50)
    assert sources.scan_csv(spark, f"{tmp_path}/all").count() == 50


def test_malformed_rows_are_judged_whole_whatever_is_selected(spark, tmp_path):
    """Bad values, missing and surplus ones, and line breaks inside quotes."""
    (tmp_path / "in.csv").write_text('a,b,c\n1,2,x\nbad,3,y\n4,bad,z\n5,6\n7,8,w,9\n10,11,"line\nbreak"\n12,13,v\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])
    good = sources.scan_csv(spark, str(tmp_path), schema=schema, multiLine="true", lineage_pattern=r"(\w+)\.csv")
    kept = [(1, 2, "x", "in"), (10, 11, "line\nbreak", "in"), (12, 13, "v", "in")]
    assert sorted(map(tuple, good.collect())) == kept and good.count() == 3
    for i, name in enumerate(good.columns):
        assert sorted(r[0] for r in good.select(name).collect()) == sorted(k[i] for k in kept)
    every = sources.quarantine_csv(spark, str(tmp_path), schema, multiLine="true")
    bad = every.filter("_corrupt_record IS NOT NULL")
    assert every.count() == 7 and bad.count() == 4 and every.select("c").count() == 7
    assert {r[0] for r in every.select("_corrupt_record").collect()} == {None, "bad,3,y", "4,bad,z", "5,6", "7,8,w,9"}
    assert every.filter("_corrupt_record IS NULL").select("b").count() == 3
