"""Compare a query's rows with those of its SQL, whatever their order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: [(v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r])


def kinds(types: list[str]) -> list[str]:
    """Types both engines share, so that a bigint is not taken for an int."""
    names = {"bigint": "bigint", "long": "bigint", "int": "integer", "varchar": "string", "hugeint": "hugeint"}
    return [names.get(t.lower(), t.lower()) for t in types]


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = dict(zip(columns, kinds([str(d[1]) for d in result.description])))
    expected = _rows(columns, result.fetchall())
    found = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} expected {sorted(columns)}"]
    own = dict(zip(df.columns, kinds([f.dataType.simpleString() for f in df.schema.fields])))
    found += [f"type of {c}: {own[c]} expected {types[c]}" for c in columns if own[c] != types[c]]
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows, expected {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        found.append(f"{len(wrong)} rows differ, e.g. {wrong[0][0]} expected {wrong[0][1]}")
    return found
