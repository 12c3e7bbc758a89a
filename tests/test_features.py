from __future__ import annotations

from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, TargetEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_DIR
from millrace.operators import features, lookup, metrics, profile, sampling
from millrace.workspace import BROADCAST_BYTES, FittedTable, measure

quick = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet").withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))


def test_index_order_and_ties(spark):
    df = spark.createDataFrame([(c,) for c in "babca"], "k string")
    fitted = features.fit_categories(df, ["k"])
    indexed = {tuple(r) for r in features.index_categories(df, fitted, {"k": "i"}).collect()}
    assert indexed == {("a", 0.0), ("b", 1.0), ("c", 2.0)}


def test_index_equals_mllib(orders):
    fitted = features.fit_categories(orders, ["o_orderpriority", "o_custkey"])
    outputs = {"o_orderpriority": "p", "o_custkey": "c"}
    both = StringIndexer(inputCols=list(outputs), outputCols=["mp", "mc"]).fit(orders).transform(orders)
    both = features.index_categories(both, fitted, outputs)
    assert both.filter("p <> mp OR c <> mc OR p IS NULL OR c IS NULL").count() == 0


def test_index_policies_for_unseen_and_null(spark):
    fitted = features.fit_categories(spark.createDataFrame([("a",), ("b",)], "k string"), ["k"])
    new = spark.createDataFrame([("a",), ("z",), (None,)], "k string")

    def run(policy):
        rows = features.index_categories(new, fitted, {"k": "i"}, policy).collect()
        return sorted((r["k"] or "", r["i"]) for r in rows)

    assert run("keep") == [("", 2.0), ("a", 0.0), ("z", 2.0)]
    assert run("skip") == [("a", 0.0)]
    with pytest.raises(Exception, match="k has no index for"):
        run("error")


def test_index_of_a_large_vocabulary_by_ranges(orders):
    plain = features.fit_categories(orders, ["o_custkey"]).table
    ranged = features.fit_categories(orders, ["o_custkey"], rows_per_task=20).table
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, ranged.collect()))


def test_lookup_beyond_the_broadcast_limit(spark):
    """Heavy keys, light keys, unknown keys and NULL keys all keep their rows."""
    keys = ["hot"] * 3000 + [None] * 2000 + [f"k{i}" for i in range(3000)] + ["new"] * 5
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, id int").repartition(4)
    table = df.filter("k <> 'new'").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("value"))
    for source in (table, table.filter("k IS NOT NULL")):
        fitted = FittedTable(source, *measure(source))
        broadcast = lookup.lookup(df, fitted, {"k": "k"})
        shuffled = lookup.lookup(df, replace(fitted, size=BROADCAST_BYTES + 1), {"k": "k"})
        assert sorted(map(str, broadcast.collect())) == sorted(map(str, shuffled.collect()))
        assert shuffled.count() == len(keys)


def test_lookup_by_two_keys_with_nulls(spark):
    pairs = [("a", 1)] * 2000 + [(None, 1)] * 800 + [("a", None)] * 3 + [(None, None)] * 900
    pairs += [(f"k{i}", i) for i in range(1500)] + [(None, i) for i in range(50)] + [("new", 0)] * 4
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "k string, j int, id int").repartition(4)
    table = df.filter("NOT k <=> 'new'").groupBy("k", "j").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("value"))
    fitted = FittedTable(table, *measure(table))
    small, large = (lookup.lookup(df, f, {"k": "k", "j": "j"}) for f in (fitted, replace(fitted, size=BROADCAST_BYTES + 1)))
    assert small.columns == large.columns and small.count() == len(pairs)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


@pytest.mark.parametrize("width", [1, 4, 15])
def test_large_vocabularies_read_the_source_once(spark, orders, width, monkeypatch):
    """Both encoders, with every column beyond the limit, and with all but the small ones."""
    wide = orders.select("o_orderkey", "y", *(F.pmod("o_custkey", F.lit(7 + 90 * i)).alias(f"c{i}") for i in range(width)))
    outputs = {f"c{i}": f"e{i}" for i in range(width)}
    labels, means = features.fit_categories(wide, list(outputs)), features.fit_target_means(wide, list(outputs), "y")
    plain = [features.index_categories(wide, labels, outputs), features.encode_targets(wide, means, outputs)]
    expected = [sorted(map(str, df.collect())) for df in plain] if width < 15 else None
    for limit in (0, 200):
        monkeypatch.setattr(features, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(lookup.lookup, "__kwdefaults__", {**lookup.lookup.__kwdefaults__, "broadcast_rows": limit})
        large = [features.index_categories(wide, labels, outputs), features.encode_targets(wide, means, outputs)]
        for df in large:
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("o_orderkey") and plan.count("parquet") == 1
        if expected:
            assert [sorted(map(str, df.collect())) for df in large] == expected


@pytest.mark.parametrize("smoothing", [0.0, 5.0])
def test_target_means_equal_mllib(orders, smoothing):
    indexed = features.index_categories(
        orders, features.fit_categories(orders, ["o_orderpriority"]), {"o_orderpriority": "p"}
    )
    encoder = TargetEncoder(inputCols=["p"], outputCols=["m"], labelCol="y", smoothing=smoothing)
    both = encoder.fit(indexed).transform(indexed)
    both = features.encode_targets(both, features.fit_target_means(both, ["p"], "y"), {"p": "e"}, smoothing)
    assert both.filter("abs(e - m) > 1e-12 OR e IS NULL").count() == 0


def test_target_mean_of_unseen_is_the_overall_mean(spark):
    fitted = features.fit_target_means(
        spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "k string, y int"), ["k"], "y"
    )
    new = spark.createDataFrame([("z",), (None,)], "k string")
    assert [r["e"] for r in features.encode_targets(new, fitted, {"k": "e"}).collect()] == [pytest.approx(2 / 3)] * 2


def test_scaler_equals_mllib(orders):
    rows = orders.select("o_totalprice", F.lit(2.0).alias("same"))
    vectors = VectorAssembler(inputCols=rows.columns, outputCol="v").transform(rows)
    scaler = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vectors)
    both = features.standardize(scaler.transform(vectors), features.fit_scaler(rows, rows.columns))
    arrays = both.withColumn("s", vector_to_array("s"))
    assert arrays.filter("abs(s[0] - o_totalprice_scaled) > 1e-9 OR same_scaled <> 0 OR s[1] <> 0").count() == 0


@quick
@given(st.lists(st.integers(0, 3), min_size=1, max_size=30))
def test_class_weights_sum_to_the_rows(spark, labels):
    df = spark.createDataFrame([(v,) for v in labels], "y int")
    weighted = features.add_class_weights(df, features.fit_class_weights(df, "y"), "y")
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(len(labels))


def test_stratified_split_is_exact_and_complete(spark):
    rows = [("big" if i % 3 else None if i % 2 else "small", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, id int").repartition(5)
    for ratio in (0.0, 0.8, 1.0):
        split = sampling.split_stratified(df, "s", "id", ratio)
        counts = {(r["s"], r["part"]): r["count"] for r in split.groupBy("s", "part").count().collect()}
        for stratum in ("big", "small", None):
            n = sum(1 for s, _ in rows if s == stratum)
            assert counts.get((stratum, "train"), 0) == int(ratio * n)
            assert counts.get((stratum, "test"), 0) == n - int(ratio * n)


def test_hash_split_does_not_depend_on_partitioning(orders):
    one = sampling.split_by_hash(orders.coalesce(1), "o_orderkey").select("o_orderkey", "part")
    many = sampling.split_by_hash(orders.repartition(7), "o_orderkey").select("o_orderkey", "part")
    assert one.exceptAll(many).count() == 0


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(float(i % 3 == 0), float((i * 31) % 10 > 5), ((i * 131) % 97) / 97.0) for i in range(2000)]
    return spark.createDataFrame(rows, "y double, prediction double, score double")


def test_metrics_equal_mllib(scored):
    ours = metrics.overall_metrics(metrics.tally(scored, "y", "prediction")).first()
    names = {"accuracy": "accuracy", "weightedPrecision": "weighted_precision", "weightedRecall": "weighted_recall", "f1": "weighted_f1"}
    for theirs, name in names.items():
        expected = MulticlassClassificationEvaluator(labelCol="y", metricName=theirs).evaluate(scored)
        assert ours[name] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("rows_per_task", [4_000_000, 10])
def test_area_under_roc_equals_mllib(scored, rows_per_task):
    ours = metrics.area_under_roc(metrics.tally(scored, "y", "prediction", "score"), rows_per_task=rows_per_task)
    expected = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0).evaluate(scored)
    assert ours.first()[0] == pytest.approx(expected, abs=1e-12)


def test_area_under_roc_of_one_class_is_unknown(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.5)], "y double, prediction double, score double")
    assert metrics.area_under_roc(metrics.tally(df, "y", "prediction", "score")).first()[0] is None


def test_both_correlation_forms_agree_with_gaps(spark):
    rows = [(float(i), float(i * i % 17) if i % 5 else None, float("nan") if i % 7 == 0 else -float(i), 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    native = {tuple(r)[:2]: r["corr"] for r in profile._native_pairs(df, df.columns).collect()}
    moments = {tuple(r)[:2]: r["corr"] for r in profile._moment_pairs(df, df.columns).collect()}
    assert native.keys() == moments.keys() and len(native) == 10
    for pair, value in native.items():
        assert moments[pair] == (None if value is None else pytest.approx(value, abs=1e-9))


def test_rows_without_label_count_for_nothing(spark):
    rows = [(1.0, 1.0, 0.9), (0.0, 0.0, 0.1), (None, 1.0, 0.95), (None, 0.0, 0.05)]
    df = spark.createDataFrame(rows, "y double, prediction double, score double")
    assert metrics.area_under_roc(metrics.tally(df, "y", "prediction", "score")).first()[0] == 1.0
    found = features.fit_class_weights(df, "y").table.collect()
    assert sorted((r.label, r.n, r.weight) for r in found) == [(0.0, 1, 1.0), (1.0, 1, 1.0)]


def test_infinities_count_as_missing_at_any_width(spark, monkeypatch):
    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (None, float("inf")), (4.0, 4.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    narrow = {(r.col_a, r.col_b): r["corr"] for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    monkeypatch.setattr(profile, "NATIVE_COLUMNS", 1)
    wide = {(r.col_a, r.col_b): r["corr"] for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert narrow.keys() == wide.keys() and all(abs(narrow[k] - wide[k]) < 1e-9 for k in narrow)
    assert abs(narrow["a", "b"] - 0.7071067811865476) < 1e-9
