from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import bucket, flag_unless, ratio
from millrace.operators import quality, quantiles

INF, NAN = math.inf, math.nan
quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_null_profile_tells_null_nan_and_infinity_apart(spark):
    df = spark.createDataFrame([(NAN, "a"), (None, None), (INF, "b"), (1.0, "c")], "d double, s string")
    rows = {r["column_name"]: r for r in quality.null_profile(df).collect()}
    assert tuple(rows["d"])[1:] == (4, 2, 1, 1, 1)
    assert tuple(rows["s"])[1:] == (4, 1, 1, 0, 0)


def test_null_profile_of_empty_table(spark):
    empty = spark.createDataFrame([], "d double, `odd.name` string")
    assert [tuple(r)[1:] for r in quality.null_profile(empty).collect()] == [(0, 0, 0, 0, 0)] * 2


def test_fill_takes_nan_but_not_infinity_or_text(spark):
    df = spark.createDataFrame([(NAN, None), (None, "x"), (INF, "y"), (1.0, "z")], "d double, s string")
    filled = quality.fill_missing(df)
    assert column(filled, "d") == [0.0, 0.0, INF, 1.0]
    assert column(filled, "s")[0] is None


def test_fill_drops_rows_without_key(spark):
    df = spark.createDataFrame([(1, None), (None, 2)], "k int, v int")
    assert [tuple(r) for r in quality.fill_missing(df, 0, keys=["k"]).collect()] == [(1, 0)]


def test_infinity_to_zero_or_null(spark):
    df = spark.createDataFrame([(INF,), (-INF,), (2.0,), (None,)], "d double")
    assert column(quality.replace_infinity(df), "d") == [0.0, 0.0, 2.0, None]
    assert column(quality.replace_infinity(df, ["d"], None), "d") == [None, None, 2.0, None]
    kept = quality.replace_infinity(spark.createDataFrame([(NAN,)], "d double"), ["d"], 0.0)
    assert math.isnan(column(kept, "d")[0])


def test_duplicates_equate_null_nan_and_signed_zero(spark):
    df = spark.createDataFrame([(NAN, None), (NAN, None), (0.0, 1), (-0.0, 1)], "d double, i int")
    assert quality.drop_duplicates(df).count() == 2
    assert tuple(quality.duplicate_report(df).first()) == (4, 2, 2)
    assert tuple(quality.duplicate_report(df.limit(0)).first()) == (0, 0, 0)


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 5), (None, 4)], "k string, v int")
    kept = quality.keep_first(df, ["k"], ["v"])
    assert {tuple(r) for r in kept.collect()} == {("a", 1), ("b", 2), (None, 4)}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_capping_by_interquartile_range(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 1000)] + [(None,)], "v int")
    for exact in (False, True):
        bounds = quality.fit_bounds(df, ["v"], exact=exact)
        assert bounds["v"] == quality.Bounds(-1.0, 7.0)
    capped = quality.cap_outliers(df, bounds)
    assert capped.schema["v"].dataType.simpleString() == "double"
    assert column(capped, "v") == [1.0, 2.0, 3.0, 4.0, 7.0, None]


def test_capping_leaves_empty_columns_and_nan_alone(spark):
    df = spark.createDataFrame([(None, NAN), (None, 1.0)], "e double, n double")
    for exact in (False, True):
        bounds = quality.fit_bounds(df, ["e", "n"], exact=exact)
        assert bounds["e"] == quality.Bounds(None, None)
        assert math.isnan(column(quality.cap_outliers(df, bounds), "n")[0])


def test_blank_and_text_to_number(spark):
    df = spark.createDataFrame([(" ",), (" 4.5 ",), ("",), ("x",), (None,)], "s string")
    assert column(quality.blank_to_number(df, ["s"]), "s") == [None, 4.5, None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        quality.cast_to_double(df, ["s"], strict=True).collect()


def test_step_report_counts_missing_keys_as_dropped(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "k int, s string")
    rows = [tuple(r)[1:] for r in quality.step_report(df, F.col("k") > 0).collect()]
    assert rows == [("drop_missing", 3, 2, 1), ("drop_duplicates", 2, 1, 1)]


def test_buckets_are_half_open_and_keep_null(spark):
    df = spark.createDataFrame([(0,), (10,), (19,), (20,), (None,)], "v int")
    named = df.select(bucket(F.col("v"), (10, 20), ("low", "mid", "high")).alias("b"))
    assert column(named, "b") == ["low", "mid", "mid", "high", None]
    with pytest.raises(ValueError):
        bucket(F.col("v"), (20, 10), ("a", "b", "c"))


def test_ratio_and_flag(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (4.0, -1.0), (4.0, None)], "a double, b double")
    assert column(df.select(ratio(F.col("a"), F.col("b"), F.col("a")).alias("r")), "r") == [2.0, 4.0, 4.0, 4.0]
    labels = spark.createDataFrame([("ok",), ("bad",), (None,)], "s string")
    assert column(labels.select(flag_unless(F.col("s"), "ok").alias("f")), "f") == [0, 1, None]
    assert column(labels.select(flag_unless(F.col("s"), "ok", 1).alias("f")), "f") == [0, 1, 1]


def interpolated(values, p):
    ordered = sorted(values)
    place = p * (len(ordered) - 1)
    low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
    return low if low == high else low + (high - low) * (place - math.floor(place))


@quick
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60), st.floats(0, 1))
def test_exact_quantiles_of_any_numbers(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert quantiles.exact_quantiles(df, ["v"], [p])["v"][0] == pytest.approx(interpolated(values, p), abs=1e-6)


def test_exact_quantiles_when_the_sketch_is_coarse(spark, monkeypatch):
    """Few gathered rows and a poor first estimate force probing, narrowing and missing."""
    monkeypatch.setattr(quantiles, "GATHER_ROWS", 3)
    monkeypatch.setattr(quantiles, "PROBES", 8)
    values = [float((i * 7919) % 10007) for i in range(10007)] + [500.0] * 5000 + [INF, -INF]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    probabilities = [0.0, 0.01, 0.25, 0.3, 0.5, 0.75, 0.999, 1.0]
    found = quantiles.exact_quantiles(df, ["v"], probabilities, accuracy=20)["v"]
    assert found == pytest.approx([interpolated(values, p) for p in probabilities])


def test_exact_quantiles_recover_from_wrong_brackets(spark):
    values = [float(v) for v in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "c0 double")
    for low, high in ((80.0, 90.0), (1.0, 2.0)):
        search = quantiles._Rank("c0", 50, low, high)
        while search.value is None:
            quantiles._round(df, [search])
        assert search.value == 50.0


@quick
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=40))
def test_capping_is_idempotent_and_within_bounds(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    bounds = quality.fit_bounds(df, ["v"])
    once = quality.cap_outliers(df, bounds)
    result = column(once, "v")
    assert all(bounds["v"].lower <= v <= bounds["v"].upper for v in result)
    assert column(quality.cap_outliers(once, bounds), "v") == result
