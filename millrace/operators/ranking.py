"""Row numbers, ranks and running totals that survive dominant groups.

A window function gathers each group in one task.  Groups larger than a task should hold are
therefore range-partitioned by group and order instead, and sorted where they lie: every row's
place in its partition is known without a window, and what the partitions before hold of its
group is a sum over one small row for each pair of partition and group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import quoted
from millrace.operators.lookup import lookup
from millrace.workspace import FittedTable, freeze, stage, staged

#: Rows of one group that a single task may sort.
ROWS_PER_TASK = 4_000_000
#: Ranges that rows are cut into at most, unless more cores can sort at once: each costs a task, a file,
#: an offset and a sample of keys on the driver.  With more rows the ranges are longer, and their
#: tasks sort on disk what memory lacks.
MOST_PIECES = 256
#: ``monotonically_increasing_id`` counts a partition's rows in this many low bits.
PLACE_BITS = 33


def order_columns(order_by: Sequence[str]) -> list[Column]:
    """Sort expressions; ``"-name"`` sorts a column downwards."""
    return [quoted(name[1:]).desc() if name.startswith("-") else quoted(name).asc() for name in order_by]


@dataclass(frozen=True)
class LargeGroups:
    """The groups that one task should not sort, with their sizes."""

    table: FittedTable
    rows: int
    partition_by: tuple[str, ...]
    order_by: tuple[str, ...]
    rows_per_task: int

    @property
    def pieces(self) -> int:
        cores = self.table.table.sparkSession.sparkContext.defaultParallelism
        return min(-(-self.rows // self.rows_per_task), max(MOST_PIECES, 2 * cores))


def _with_groups(df: DataFrame, partition_by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Copies of the group columns under fixed names; one constant if there are none."""
    sources = [quoted(c) for c in partition_by] or [F.lit(0)]
    names = [f"__g{i}" for i in range(len(sources))]
    return df.select("*", *[c.alias(n) for c, n in zip(sources, names)]), names


def fit_range_cuts(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], *, rows_per_task: int = ROWS_PER_TASK
) -> LargeGroups | None:
    """Find the groups too large for one task; ``None`` if there are none, which one count by
    group finds out."""
    grouped, names = _with_groups(df, partition_by)
    with staged(grouped.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "group-sizes") as sizes:
        large = sizes.filter(F.col("n") > rows_per_task)
        rows = large.agg(F.sum("n")).first()[0]
        if not rows:
            return None
        # No more of them than the rows hold limits, so the table is as small as that quotient.
        return LargeGroups(freeze(large, "large-groups"), rows, tuple(partition_by), tuple(order_by), rows_per_task)


def _parted(df: DataFrame, groups: LargeGroups) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows of small groups and rows of large ones, both with the group columns."""
    grouped, names = _with_groups(df, groups.partition_by)
    keys = [f"{n}_" for n in names]
    table = groups.table.table.select(*[F.col(n).alias(k) for n, k in zip(names, keys)])
    on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(k)) for n, k in zip(names, keys)])
    few = F.broadcast(table)
    return grouped.join(few, on, "left_anti"), grouped.join(few, on, "left_semi"), names


def _placed(large: DataFrame, names: list[str], groups: LargeGroups) -> tuple[DataFrame, FittedTable]:
    """Rows range-partitioned by group and order and sorted, with their ``__part`` and place
    ``__at``; and for each part and group its first place and the rows in earlier parts."""
    order = [*map(F.col, names), *order_columns(groups.order_by)]
    ranged = large.repartitionByRange(groups.pieces, *order).sortWithinPartitions(*order)
    rows = stage(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranged-rows")
    rows = rows.withColumn("__part", F.shiftright("__at", PLACE_BITS))
    parts = rows.groupBy(*names, "__part").agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*names).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return rows, freeze(before, "range-offsets")


def number_rows(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    name: str = "row_number",
    cuts: LargeGroups | None = None,
) -> DataFrame:
    """``row_number`` within each group.  ``order_by`` has to end in a unique key, or
    equal rows get their numbers in any order.  Pass what ``fit_range_cuts`` found for large
    groups: their rows are shuffled once, by range, and pass no window."""
    own = [quoted(c) for c in df.columns]
    if cuts is None:
        window = Window.partitionBy(*[quoted(c) for c in partition_by]).orderBy(*order_columns(order_by))
        return df.withColumn(name, F.row_number().over(window).cast("bigint"))
    small, large, names = _parted(df, cuts)
    window = Window.partitionBy(*map(F.col, names)).orderBy(*order_columns(order_by))
    plain = small.select(*own, F.row_number().over(window).cast("bigint").alias(name))
    rows, offsets = _placed(large, names, cuts)
    found = lookup(rows, offsets, {n: n for n in [*names, "__part"]})
    number = F.col("__at") - F.col("first") + F.col("before") + 1
    return plain.unionAll(found.select(*own, number.cast("bigint").alias(name)))


def prefix_sums(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    value: str,
    name: str = "before",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group, 0 for the first.  ``order_by`` has to
    be unique within a group."""
    own, zero = [quoted(c) for c in df.columns], F.lit(0).cast(df.schema[value].dataType)

    def earlier(keys: Sequence[Column], order: Sequence[Column]) -> Column:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(quoted(value)).over(window), zero)

    order = order_columns(order_by)
    cuts = fit_range_cuts(df, partition_by, order_by, rows_per_task=rows_per_task)
    if cuts is None:
        return df.select(*own, earlier([quoted(c) for c in partition_by], order).alias(name))
    small, large, names = _parted(df, cuts)
    groups = [F.col(n) for n in names]
    rows, _ = _placed(large, names, cuts)
    # A window over a part passes its rows one by one, and keeps them on disk if they are many.
    parts = rows.groupBy(*names, "__part").agg(F.sum(quoted(value)).alias("total"), F.count(F.lit(1)).alias("n"))
    start = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = freeze(parts.select(*names, "__part", "n", F.coalesce(F.sum("total").over(start), zero).alias("__start")), "offsets")
    inside = rows.withColumn("__inside", earlier([*groups, F.col("__part")], [F.col("__at")]))
    found = lookup(inside, offsets, {n: n for n in [*names, "__part"]})
    total = (F.col("__inside") + F.col("__start")).alias(name)
    return small.select(*own, earlier(groups, order).alias(name)).unionAll(found.select(*own, total))


def rank_rows(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    name: str = "rank",
    cuts: LargeGroups | None = None,
) -> DataFrame:
    """``rank`` within each group.  In large groups (see ``fit_range_cuts``) equal keys are merged
    before the shuffle; a rank is one more than the rows with earlier keys, and goes back to
    the rows by a lookup, which is made for keys that very many rows share."""
    if cuts is None:
        window = Window.partitionBy(*[quoted(c) for c in partition_by]).orderBy(*order_columns(order_by))
        return df.withColumn(name, F.rank().over(window).cast("bigint"))
    own = [quoted(c) for c in df.columns]
    small, large, names = _parted(df, cuts)
    window = Window.partitionBy(*map(F.col, names)).orderBy(*order_columns(order_by))
    plain = small.select(*own, F.rank().over(window).cast("bigint").alias(name))
    keys = [c.removeprefix("-") for c in order_by]
    aliases, own_groups = [f"__o{i}" for i in range(len(keys))], [f"__k{i}" for i in range(len(names))]
    keyed = large.select("*", *[quoted(c).alias(a) for c, a in zip(keys, aliases)]).withColumnsRenamed(dict(zip(names, own_groups)))
    tally = keyed.groupBy(*own_groups, *aliases).agg(F.count(F.lit(1)).alias("n"))
    order = [f"-{a}" if c.startswith("-") else a for c, a in zip(order_by, aliases)]
    before = prefix_sums(stage(tally, "tally"), own_groups, order, "n", "__before", cuts.rows_per_task)
    found = lookup(keyed, freeze(before, "ranks"), {c: c for c in [*own_groups, *aliases]})
    return plain.unionAll(found.select(*own, (F.col("__before") + 1).cast("bigint").alias(name)))


def top_rows(df: DataFrame, order_by: Sequence[str], count: int) -> DataFrame:
    """The first ``count`` rows; each task keeps only its own first ``count``."""
    return df.orderBy(*order_columns(order_by)).limit(count)
