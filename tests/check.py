"""Run a registered query on Spark and its SQL on DuckDB and compare the two results, order aside."""

from __future__ import annotations

import math

import duckdb

from tidemark.queries.fixtures import TABLES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v.tolist() if hasattr(v, "tolist") else v


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


# DuckDB name of each Spark type that occurs
_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
          "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def type_differences(df, result) -> list[str]:
    want = {d[0]: str(d[1]) for d in result.description}
    return [f"{name}: {t} / {want.get(name)}" for name, t in df.dtypes
            if _TYPES.get(t, t.upper()) != want.get(name)]


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    got_names = df.columns
    got = rows_of(got_names, df.collect())
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want = rows_of(want_names, result.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns: {sorted(got_names)} / {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows: {len(got)} / {len(want)}; first {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference in {sorted(got_names)}:\n  spark {a}\n  sql   {b}"
    return None
