"""Row-by-row comparison of source and target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.casts import cast_or_null
from tidemark.functions.digests import hash_differences, row_hash

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _compared(source: DataFrame, target: DataFrame, keys: Sequence[str], compare: Sequence[str] | None) -> list[str]:
    return list(compare) if compare is not None else list(dict.fromkeys(
        c for c in [*source.columns, *target.columns] if c not in keys))


def _hashed(source: DataFrame, target: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """keys, _h (hash of the compared columns) and _src (true for the source's rows) of both sides."""
    def side(df: DataFrame, flag: bool) -> DataFrame:
        # Hash in the source's types, so that a widened target column does not count as a change. A value that does
        # not fit them is no NULL of the source's, and a column that only one side has is NULL on the other.
        typed = [F.col(f"`{c}`") if flag else F.col(f"`{c}`").try_cast(source.schema[c].dataType).alias(c) for c in keys]
        unfit = F.lit(0)
        for c in cols:
            dtype = source.schema[c].dataType if c in source.columns else target.schema[c].dataType
            if c not in df.columns:
                typed.append(F.lit(None).cast(dtype).alias(c))
                continue
            fitted = F.col(f"`{c}`") if df.schema[c].dataType == dtype else cast_or_null(F.col(f"`{c}`"), df.schema[c].dataType, dtype)
            typed.append(fitted.alias(c))
            unfit = unfit + F.when(F.col(f"`{c}`").isNotNull() & fitted.isNull(), 1).otherwise(0)
        rows = df.select(*typed, unfit.alias("_unfit"))
        return rows.select(*keys, row_hash([*cols, "_unfit"]).alias("_h"), F.lit(flag).alias("_src"))

    return side(source, True).unionByName(side(target, False))


def compare_rows(source: DataFrame, target: DataFrame, keys: Sequence[str],
                 compare: Sequence[str] | None = None) -> DataFrame:
    """Per key: rows on each side and a status (missing, extra, changed, same).

    Both sides go through one grouped pass instead of an outer join. Groups are combined before the
    shuffle, so a key that holds much of the table costs each task one row, and repeated keys are
    compared as multisets instead of being paired with each other. Without `compare` all columns of
    either side count; `schema_differences` says which only one side has.
    """
    cols = _compared(source, target, keys, compare)
    both = _hashed(source, target, keys, cols)
    src = F.col("_src")
    nets = {f"_net{i}": net for i, net in enumerate(hash_differences(F.col("_h"), src))}
    grouped = both.groupBy(*keys).agg(
        F.count_if(src).alias("source_rows"), F.count_if(~src).alias("target_rows"),
        *[net.alias(name) for name, net in nets.items()])
    equal = F.col("source_rows") == F.col("target_rows")
    for name in nets:
        equal = equal & (F.col(name) == 0)
    status = (F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra")
              .when(equal, "same").otherwise("changed"))
    return grouped.select(*keys, "source_rows", "target_rows", status.alias("status"))


def schema_differences(source: DataFrame, target: DataFrame) -> DataFrame:
    """(column_name, source_type, target_type) of the columns that one side lacks or has in another type."""
    src, tgt = dict(source.dtypes), dict(target.dtypes)
    rows = [(c, src.get(c), tgt.get(c)) for c in dict.fromkeys([*src, *tgt]) if src.get(c) != tgt.get(c)]
    return source.sparkSession.createDataFrame(rows, "column_name string, source_type string, target_type string")


def differences(source: DataFrame, target: DataFrame, keys: Sequence[str],
                compare: Sequence[str] | None = None) -> DataFrame:
    """Only the keys that differ."""
    return compare_rows(source, target, keys, compare).filter("status <> 'same'")


def summary(source: DataFrame, target: DataFrame, keys: Sequence[str],
            compare: Sequence[str] | None = None) -> DataFrame:
    return compare_rows(source, target, keys, compare).groupBy("status").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("source_rows").alias("source_rows"),
        F.sum("target_rows").alias("target_rows"))


_FANOUT = 4_096      # parts that a node of the tree is cut into
_MAX_NODES = 100_000 # differing nodes that are looked into; beyond, so much differs that finer ones do not pay
_LEAF_ROWS = 10_000  # differing rows that need no finer nodes
_MAX_SPANS = 50      # stretches that are written into the plan as bounds


def _place(df: DataFrame, keys: Sequence[str], dtype: T.DataType) -> Column:
    """Where a row hangs in the tree: at its key, if that is one whole number, so that neighbours in the files share a
    node and scans can be cut; else at a hash of the keys."""
    if len(keys) == 1 and isinstance(dtype, _INTEGRAL):
        return F.col(f"`{keys[0]}`").try_cast(dtype).cast("bigint")
    return row_hash(keys)


def _inside(df: DataFrame, place: Column, nodes: list, width: int) -> DataFrame:
    """The rows whose place lies in one of the nodes. Few stretches are plain bounds, which reach the files; many nodes are
    a broadcast table, one look-up per row however many they are."""
    spans = []
    for low in sorted(n for n in nodes if n is not None):
        if spans and spans[-1][1] == low:
            spans[-1][1] = low + width
        else:
            spans.append([low, low + width])
    if len(spans) > _MAX_SPANS:
        low = place - F.pmod(place, F.lit(width).cast("bigint"))
        table = F.broadcast(df.sparkSession.createDataFrame([(n,) for n in nodes], "_node bigint"))
        return df.join(table, low.eqNullSafe(F.col("_node")) if None in nodes else low == F.col("_node"), "left_semi")
    inside = F.lit(False)
    for start, end in spans:
        inside = inside | ((place >= F.lit(start)) & (place < F.lit(end) if end < 1 << 63 else F.lit(True)))
    return df.filter((inside | place.isNull()) if None in nodes else (inside & place.isNotNull()))


def differing_nodes(source: DataFrame, target: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None,
                    fanout: int = _FANOUT, leaf_rows: int = _LEAF_ROWS) -> tuple[list, int, int]:
    """(lower edges of the nodes that differ, NULL for rows without a key; their width; the rows of both sides in them).

    A node is a stretch of places with, per side, the count and order-free sums of the hashes of its rows; both sides go
    into them in one pass, merged before the shuffle, so a level sends at most `fanout` rows per node and task. Only
    what differs is cut finer, while that still halves the rows in question and nodes are fewer than these rows: beyond,
    nodes would be as many as keys and merge nothing. Nodes, not rows, reach the driver.
    """
    cols = _compared(source, target, keys, compare)
    dtype = source.schema[keys[0]].dataType
    both = _hashed(source, target, keys, cols)
    both = both.select(_place(both, keys, dtype).alias("_place"), row_hash([*keys, "_h"]).alias("_h"), "_src")
    # hashes lie anywhere, so they need not be read for their ends
    hashed = len(keys) > 1 or not isinstance(dtype, _INTEGRAL)
    lo, hi = (F.lit(-(1 << 63)), F.lit((1 << 63) - 2)) if hashed else (F.min("_place"), F.max("_place"))
    ends = both.agg(F.count(F.lit(1)).alias("rows"), lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi")).first()
    if ends.lo is None:
        return [None], 1, 0
    width, nodes, before = 1 << (ends.hi - ends.lo + 1).bit_length(), None, ends["rows"]
    nets = hash_differences(F.col("_h"), F.col("_src"))
    while True:
        finer = max(1, width // fanout)   # powers of two, so finer nodes nest
        rows = both if nodes is None else _inside(both, F.col("_place"), nodes, width)
        low = F.col("_place") - F.pmod(F.col("_place"), F.lit(finer).cast("bigint")) if finer < 1 << 63 else F.lit(None).cast("bigint")
        sums = rows.groupBy(low.alias("low")).agg(
            F.count(F.lit(1)).alias("rows"), (2 * F.count_if("_src") - F.count(F.lit(1))).alias("n"), *[x.alias(f"n{i}") for i, x in enumerate(nets)])
        differs = F.col("n") != 0
        for i in range(len(nets)):
            differs = differs | (F.col(f"n{i}") != 0)
        found = sums.filter(differs).select("low", "rows").limit(_MAX_NODES + 1).collect()
        held = sum(r["rows"] for r in found)
        if len(found) > _MAX_NODES or 2 * held > before:
            return (nodes, width, before) if nodes is not None else ([], 0, -1)
        nodes, width, before = [r["low"] for r in found], finer, held
        if held <= leaf_rows or width == 1 or len(nodes) * min(fanout, width) > held:
            return nodes, width, held


def tree_differences(source: DataFrame, target: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None,
                     fanout: int = _FANOUT, leaf_rows: int = _LEAF_ROWS) -> DataFrame:
    """Like `differences`, for sides that agree nearly everywhere: only rows in differing nodes are shuffled by key."""
    nodes, width, held = differing_nodes(source, target, keys, compare, fanout, leaf_rows)
    if held < 0:   # nearly all differs
        return differences(source, target, keys, compare)
    dtype = source.schema[keys[0]].dataType
    near = [_inside(df, _place(df, keys, dtype), nodes, width) for df in (source, _as_keys(target, source, keys))]
    return differences(*near, keys, compare)


def _as_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """target with its keys in the source's types, in which places are computed."""
    return target.withColumns({k: F.col(f"`{k}`").try_cast(source.schema[k].dataType) for k in keys
                               if target.schema[k].dataType != source.schema[k].dataType})
