"""The registered queries: each runs a part of the library over the given tables, with the SQL that must agree."""

from __future__ import annotations

from tidemark.queries import cleaning, loads, meta, quality, ranges, scans  # noqa: F401  (fills the registry)
from tidemark.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
