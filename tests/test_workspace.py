from __future__ import annotations

import pytest

from millrace import workspace


def test_staged_rows_are_there_inside_and_their_space_is_freed_after(spark):
    with workspace.staged(spark.range(50_000), "numbers") as table:
        assert table.count() == 50_000
        (place,) = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    assert spark.read.parquet(place).count() == 0 and spark.read.parquet(place).columns == ["gone"]


def test_space_is_freed_after_an_error_too(spark):
    places = []
    with pytest.raises(ValueError):
        with workspace.staged(spark.range(10), "numbers") as table:
            places.append(table.inputFiles()[0].rsplit("/", 1)[0])
            raise ValueError
    assert spark.read.parquet(places[0]).count() == 0
