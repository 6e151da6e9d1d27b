"""All queries of this folder."""

from __future__ import annotations

from tidemark.llm import (  # noqa: F401  (fills the registry)
    bpe, chat, importance, kdtree, licenses, mixing, quality, secrets, simhash, tokencounts, toxicity, urls, vectorcodes)
from tidemark.llm.registry import QUERIES

__all__ = ["QUERIES"]
