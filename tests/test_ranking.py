"""The ranged forms have to agree with the plain window, whatever the groups look like."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, one value most of that group; NULL is a group too."""
    rows = []
    for i in range(6000):
        group = "hot" if i % 10 < 7 else None if i % 10 == 7 else f"g{i % 50}"
        value = 42.0 if i % 3 == 0 else None if i % 101 == 0 else float((i * 37) % 900)
        rows.append((group, value, i))
    return spark.createDataFrame(rows, "k string, v double, id int").repartition(6)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[2])


@pytest.mark.parametrize("groups", [["k"], []])
@pytest.mark.parametrize("order", [["v", "id"], ["-v", "id"], ["-id"]])
def test_numbers_by_ranges(skewed, groups, order):
    cuts = ranking.fit_range_cuts(skewed, groups, order, rows_per_task=150)
    assert cuts is not None and cuts.pieces > 5
    plain = ranking.number_rows(skewed, groups, order, "n")
    assert collected(ranking.number_rows(skewed, groups, order, "n", cuts)) == collected(plain)


@pytest.mark.parametrize("order", [["v"], ["-v"]])
def test_ranks_by_ranges(skewed, order):
    cuts = ranking.fit_range_cuts(skewed, ["k"], order, rows_per_task=150)
    assert cuts is not None
    plain = ranking.rank_rows(skewed, ["k"], order, "n")
    assert collected(ranking.rank_rows(skewed, ["k"], order, "n", cuts)) == collected(plain)


@pytest.mark.parametrize(
    "kind", ["string", "binary", "date", "timestamp", "timestamp_ntz", "boolean", "decimal(12,2)", "bigint", "tinyint"]
)
def test_falling_keys_of_any_type(skewed, kind):
    source = {
        "string": "substring('abcab', 1, int(v % 6)) || if(v % 4 = 0, 'é', '')",
        "binary": "cast(substring('abcab', 1, int(v % 6)) as binary)",
        "date": "date_add(date'1969-12-01', int(v))",
        "timestamp": "timestamp_millis(int(v * 1000 - 300000))",
        "timestamp_ntz": "cast(timestamp_millis(int(v * 1000 - 300000)) as timestamp_ntz)",
        "boolean": "v > 300",
        "bigint": "if(v = 42, -9223372036854775808, bigint(v))",
        "tinyint": "tinyint(v % 128 - if(v % 128 = 0, 128, 0))",
    }.get(kind, f"cast(v / 7 as {kind})")
    rows = skewed.selectExpr("k", f"{source} AS v", "id")
    cuts = ranking.fit_range_cuts(rows, ["k"], ["-v", "id"], rows_per_task=150)
    assert cuts is not None and rows.dtypes[1][1] == kind
    plain = ranking.number_rows(rows, ["k"], ["-v", "id"], "n")
    assert collected(ranking.number_rows(rows, ["k"], ["-v", "id"], "n", cuts)) == collected(plain)


def test_ranges_split_the_hot_group(skewed):
    cuts = ranking.fit_range_cuts(skewed, ["k"], ["v", "id"], rows_per_task=150)
    assert cuts.rows == skewed.groupBy("k").count().filter("count > 150").agg({"count": "sum"}).first()[0]
    _, large, names = ranking._parted(skewed.filter("k = 'hot'"), cuts)
    rows, offsets = ranking._placed(large, names, cuts)
    sizes = [r["count"] for r in rows.groupBy("__part").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 900 and sum(sizes) == 4200
    assert sorted(r["before"] for r in offsets.table.collect())[0] == 0


def test_plain_windows_see_no_row_of_a_large_group(skewed):
    cuts = ranking.fit_range_cuts(skewed, ["k"], ["v", "id"], rows_per_task=150)
    small, large, _ = ranking._parted(skewed, cuts)
    assert small.groupBy("k").count().filter("count > 150").count() == 0 and large.count() == cuts.rows


@pytest.mark.parametrize("groups", [["k"], []])
@pytest.mark.parametrize("rows_per_task", [150, 4_000_000])
def test_prefix_sums(skewed, groups, rows_per_task):
    rows = skewed.withColumn("w", F.col("id") % 7)
    window = Window.partitionBy(*groups).orderBy(F.col("v").desc(), "id").rowsBetween(Window.unboundedPreceding, -1)
    plain = rows.withColumn("before", F.coalesce(F.sum("w").over(window), F.lit(0)))
    assert collected(ranking.prefix_sums(rows, groups, ["-v", "id"], "w", "before", rows_per_task)) == collected(plain)


def test_large_groups_pass_one_shuffle_and_no_window(skewed):
    hot = skewed.filter("k = 'hot'")
    cuts = ranking.fit_range_cuts(hot, ["k"], ["v", "id"], rows_per_task=150)
    assert ranking._parted(hot, cuts)[0].count() == 0
    _, large, names = ranking._parted(hot, cuts)
    rows, _ = ranking._placed(large, names, cuts)
    assert "Window" not in rows._jdf.queryExecution().toString()


def test_no_cuts_for_small_groups(skewed):
    assert ranking.fit_range_cuts(skewed, ["k"], ["v"]) is None
    assert ranking.fit_range_cuts(skewed.limit(0), ["k"], ["v"]) is None


def test_ranges_do_not_grow_with_the_rows(skewed, monkeypatch):
    """Many more rows than the ranges allowed may hold by ``rows_per_task``: longer ranges, same results."""
    monkeypatch.setattr(ranking, "MOST_PIECES", 7)
    most = max(7, 2 * skewed.sparkSession.sparkContext.defaultParallelism)
    rows, order = skewed.withColumn("w", F.col("id") % 13), ["v", "id"]
    cuts = ranking.fit_range_cuts(rows, ["k"], order, rows_per_task=2)
    assert cuts is not None and cuts.pieces == most and cuts.rows > 1000
    assert collected(ranking.number_rows(rows, ["k"], order, "n", cuts)) == collected(ranking.number_rows(rows, ["k"], order, "n"))
    assert collected(ranking.rank_rows(rows, ["k"], ["v"], "n", cuts)) == collected(ranking.rank_rows(rows, ["k"], ["v"], "n"))
    ranged, plain = (ranking.prefix_sums(rows, ["k"], order, "w", "before", n) for n in (2, 4_000_000))
    assert collected(ranged) == collected(plain)
    assert ranking.LargeGroups(cuts.table, 216_000_000, ("k",), ("v",), 600).pieces == most
