from __future__ import annotations

import math
import random
from datetime import date, datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import types as T

from millrace.operators.selection import discrete_quantiles

SHARES = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]
RANDOM = random.Random(8)
KINDS = {
    "bigint": [9007199254740993, 9007199254740992, 9007199254740995, -(2**63), 2**63 - 1, 0, -1, 1] + [RANDOM.randrange(-(2**62), 2**62) for _ in range(90)],
    "tinyint": [RANDOM.randrange(-128, 128) for _ in range(70)],
    "date": [date(1, 1, 1), date(9999, 12, 31), date(1970, 1, 1), date(1969, 12, 31), *[date(1900 + i, 3, 7) for i in range(40)]],
    "timestamp_ntz": [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1), *[datetime(1900 + i, 3, 7, 1, 2, 3, i) for i in range(150)]],
    "timestamp": [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 2), *[datetime(1950 + i, 3, 7, 1, 2, 3, i) for i in range(80)]],
    "decimal(12,2)": [Decimal(RANDOM.randrange(-(10**11), 10**11)).scaleb(-2) for _ in range(80)],
    "decimal(38,10)": [Decimal(RANDOM.randrange(-(10**37), 10**37)).scaleb(-10) for _ in range(60)]
    + [Decimal(n).scaleb(-10) for n in (-1, 0, 1, 10**18, -(10**18), 10**18 - 1, 1 - 10**18, 10**37 - 1)],
    "decimal(38,0)": [Decimal(10**38 - 1), Decimal(1 - 10**38), Decimal(5), Decimal(-5), Decimal(10**20 + 3)],
}


def expected(values, p):
    return sorted(values)[min(max(math.ceil(Fraction(str(p)) * len(values)) - 1, 0), len(values) - 1)]


@pytest.mark.parametrize("kind", list(KINDS))
def test_values_at_ranks_in_their_own_type(spark, kind):
    rows = KINDS[kind] + KINDS[kind][:5] * 3
    table = spark.createDataFrame([(v,) for v in rows] + [(None,)] * 9, f"v {kind}").repartition(5)
    assert discrete_quantiles(table, ["v"], SHARES)["v"] == [expected(rows, p) for p in SHARES]


def test_large_numbers_that_doubles_confuse(spark):
    table = spark.createDataFrame([(9007199254740993,)] * 3 + [(9007199254740992,)] * 2, "v bigint")
    assert discrete_quantiles(table, ["v"], [0.4, 0.5])["v"] == [9007199254740992, 9007199254740993]


def test_columns_together_and_columns_without_values(spark):
    rows = [(i % 7, date(2020, 1, 1 + i % 28), None) for i in range(500)]
    schema = "`a.b` int, d date, n bigint"
    found = discrete_quantiles(spark.createDataFrame(rows, schema), ["a.b", "d", "n"], [0.5, 0.99])
    assert found == {"a.b": [3, 6], "d": [expected([r[1] for r in rows], p) for p in (0.5, 0.99)], "n": [None, None]}
    assert discrete_quantiles(spark.createDataFrame([], schema), ["d"], [0.5]) == {"d": [None]}


def test_one_value_that_nearly_all_rows_have(spark):
    table = spark.range(20_000).selectExpr("if(id % 50 = 0, id, 77) AS v")
    values = [i if i % 50 == 0 else 77 for i in range(20_000)]
    assert discrete_quantiles(table, ["v"], SHARES)["v"] == [expected(values, p) for p in SHARES]


def test_no_code_for_text(spark):
    with pytest.raises(TypeError, match="string"):
        discrete_quantiles(spark.createDataFrame([("x",)], T.StructType([T.StructField("v", T.StringType())])), ["v"], [0.5])
