"""JDBC sink.  The caller names the server and supplies the credentials."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from millrace.sinks.files import scalar_columns


def jdbc_options(
    url: str, table: str, properties: Mapping[str, str] | None, connections: int, batch_rows: int
) -> dict[str, str]:
    """Options of the write; ``numPartitions`` bounds the open connections."""
    if connections < 1 or batch_rows < 1:
        raise ValueError("connections and batch_rows must be positive")
    own = {"url": url, "dbtable": table, "numPartitions": str(connections), "batchsize": str(batch_rows)}
    clash = own.keys() & set(properties or {})
    if clash:
        raise ValueError(f"given twice: {sorted(clash)}")
    return {**(properties or {}), **own}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
    connections: int = 4,
    batch_rows: int = 10_000,
) -> None:
    """Write the scalar columns to a database table.

    Partitions commit on their own, so a re-tried task can write its rows again:
    write to a fresh staging table and swap it in on the server.
    """
    options = jdbc_options(url, table, properties, connections, batch_rows)
    scalar_columns(df).write.format("jdbc").options(**options).mode(mode).save()
