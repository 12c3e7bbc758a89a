from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators import sampling


@pytest.mark.parametrize("digits,limit", [(1, 3), (1, 50), (2, 5), (4, 1), (4, 1_000_000)])
def test_quotas_found_by_descent(spark, digits, limit):
    """One stratum has 90 % of the rows; one row alone, NULL and two-row strata are there, too."""
    rows = [(("most" if i % 10 else None if i % 20 else f"s{i % 7}"), i) for i in range(3000)] + [("one", 9001), ("two", 9002), ("two", 9003)]
    table = spark.createDataFrame(rows, "stratum string, id long").repartition(7)
    found = sampling.split_stratified(table, "stratum", "id", 0.7, rows_per_task=limit, bin_digits=digits)
    want, held = {}, defaultdict(list)
    for stratum, i in rows:
        held[stratum].append((hashlib.md5(str(i).encode()).hexdigest(), i))
    for some in held.values():
        quota = len(some) * 7 // 10
        want.update({i: "train" if n < quota else "test" for n, (_, i) in enumerate(sorted(some))})
    assert {r["id"]: r["part"] for r in found.collect()} == want
    assert Counter(want.values())["train"] > 2000


def test_no_bin_is_larger_than_asked_for(spark):
    keyed = spark.range(40_000).select(F.lit("s").alias("s"), "id", F.md5(F.col("id").cast("string")).alias("digest"))
    bins = sampling._quota_bins(keyed, None, 0.5, 1)
    sizes = [bins.table.first()["size"]]
    while sizes[-1] > 20:
        bins = sampling._quota_bins(keyed, bins, 0.5, 1)
        sizes.append(bins.table.first()["size"])
    assert len(sizes) > 2 and all(a > b for a, b in zip(sizes, sizes[1:]))
    assert sampling._in_bins(keyed, bins).count() == sizes[-1]
