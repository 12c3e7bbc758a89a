"""Joining learned tables to the rows they apply to."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import quoted
from millrace.workspace import BROADCAST_BYTES, FittedTable

#: A learned table up to this many rows (and ``BROADCAST_BYTES``) is broadcast.
BROADCAST_ROWS = 200_000
#: A key holding more than one row in this many is joined by broadcast in any case,
#: unless the key itself is long.
HEAVY_SHARE = 1_000
HEAVY_KEY_BYTES = 10_000
#: Rows answered by a heavy key are dealt over this many keys of the shuffle.
SPREAD = 65_536


def lookup(
    df: DataFrame,
    fitted: FittedTable,
    keys: Mapping[str, str],
    *,
    weight: str = "n",
    keep_weight: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left-join a learned table; ``keys`` maps columns of ``df`` to columns of the table.

    NULL keys match a NULL entry.  A table whose measured extent is small is broadcast.  For
    a larger one ``df`` is read once all the same: heavy keys (by the ``weight`` column, at
    most ``HEAVY_SHARE`` of them) and the entry whose keys are all NULL are looked up by
    broadcast, the other keys by shuffle.  Rows that have their answer pass that shuffle
    under a spread key which no entry has.
    """
    unused = [] if keep_weight else [weight]
    renamed = {name: f"__{name}" for name in keys.values()}
    table = fitted.table.withColumnsRenamed(renamed)
    pairs = [(left, renamed[right]) for left, right in keys.items()]
    on = reduce(lambda a, b: a & b, [quoted(left).eqNullSafe(F.col(right)) for left, right in pairs])
    if fitted.rows <= broadcast_rows and fitted.size <= BROADCAST_BYTES:
        return df.join(F.broadcast(table.drop(*unused)), on, "left").drop(*renamed.values())
    total = table.agg(F.sum(weight)).first()[0]
    all_null = reduce(lambda a, b: a & b, [F.col(right).isNull() for _, right in pairs])
    key_bytes = F.octet_length(F.to_json(F.struct(*[F.col(right) for _, right in pairs])))
    frequent = (F.col(weight) * HEAVY_SHARE > F.lit(total)) & (key_bytes <= HEAVY_KEY_BYTES)
    is_heavy = F.coalesce(frequent, F.lit(False)) | all_null
    values = [c for c in table.columns if c not in unused and c not in renamed.values()]
    heavy = table.filter(is_heavy).select(*renamed.values(), F.struct(*map(quoted, values)).alias("__heavy"))
    light = table.filter(~is_heavy).select(
        *renamed.values(), F.lit(0).alias("__entry"), F.struct(*map(quoted, values)).alias("__light")
    )
    unhashable = ("map<", "variant")
    hashable = [quoted(name) for name, kind in df.dtypes if not any(u in kind for u in unhashable)]
    answered = F.col("__heavy").isNotNull() | reduce(lambda a, b: a & b, [quoted(left).isNull() for left, _ in pairs])
    spread = F.when(answered, F.pmod(F.xxhash64(*hashable), F.lit(SPREAD)).cast("int") + 1).otherwise(0)
    first = df.join(F.broadcast(heavy), on, "left").drop(*renamed.values()).withColumn("__spread", spread)
    both = first.join(light, on & (F.col("__spread") == F.col("__entry")), "left")
    found = F.coalesce("__heavy", "__light")
    return both.select(*map(quoted, df.columns), *(found.getField(c).alias(c) for c in values))
