"""Names, functions and check SQL of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""
    def add(fn):
        REGISTRY[fn.__name__] = Query(fn, sql)
        return fn
    return add
