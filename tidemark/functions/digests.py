"""Order-independent comparison of two groups of rows by their hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

_BITS = 22
_MASK = (1 << _BITS) - 1
SLICES = 3


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of the listed columns.

    NULL-ness goes in as well: xxhash64 skips NULLs, so (NULL, 1) and (1, NULL) would collide.
    """
    parts = [F.col(c) for c in columns]
    return F.xxhash64(*parts, *[p.isNull() for p in parts])


def hash_differences(h: Column, left: Column) -> list[Column]:
    """Three sums, all zero if the rows where `left` holds have the same hashes as the others.

    Each sums one 22-bit slice of the hash, added on the left and taken off on the right. A sum,
    unlike xor, also tells apart groups that hold a row twice. A slice is below 2^22, so a BIGINT has
    room for 2^41 rows per group, and Spark combines these plain additions before the shuffle.
    """
    slices = [F.shiftrightunsigned(h, i * _BITS).bitwiseAND(F.lit(_MASK)) for i in range(SLICES)]
    return [F.sum(F.when(left, s).otherwise(-s)) for s in slices]
