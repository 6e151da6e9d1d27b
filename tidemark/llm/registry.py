"""The queries of this folder, by name, with the SQL that must agree where SQL can express them."""

from __future__ import annotations

from tidemark.queries.registry import Query

QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = Query(fn, sql)
        return fn
    return add
