"""Scans. All of them are filters on a DataFrame, so Spark pushes them into parquet or a database."""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import literal_like
from tidemark.functions.digests import row_hash
from tidemark.operators.ranges import NULL_RANGE, collect_plan, default_width, histogram, running_total

# Fixed values
SAMPLE_ROWS = 1_000_000

_LAST_KEY = 2**63 - 1
_BUCKETS = 1_000   # that one question to a database is answered in


def table(spark: SparkSession, location: str) -> DataFrame:
    """A parquet folder or file, or a catalog table `schema.table`."""
    return spark.read.parquet(location) if "/" in location else spark.table(location)


def sample(df: DataFrame, pk: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first `rows` rows by key, for a table the caller wants a sample of."""
    return first_rows(df, pk, rows)


def first_rows(df: DataFrame, pk: str, n: int) -> DataFrame:
    """The first `n` rows by an integer key; rows without a key come last.

    A plain sort-and-limit sends `n` rows of every task to one task. Here a histogram finds the key at
    which the count is reached, and a filter takes all rows before it. Rows that share that key are
    cut by a hash of the row in the same way, so the limit that is left only sees a sliver.
    """
    key = F.coalesce(F.col(pk).cast("bigint"), F.lit(_LAST_KEY))
    width = default_width(df, pk, n)
    slot = F.shiftrightunsigned(row_hash(df.columns), 44)   # the hash's upper 20 bits
    taken, edge, need = F.lit(False), F.lit(True), n
    # Each level: the value to count by, its bucket width, and what the scan may be cut to.
    for value, step in ((key, width), (key, 1), (slot, 1)):
        hist = histogram(df.filter(edge).select(value.alias("v")), "v", step)
        cut = running_total(hist, step).filter(F.col("cum") >= need).orderBy("bucket").first()
        if cut is None:
            return df
        last = min(cut.bucket + step - 1, _LAST_KEY)
        taken = taken | (edge & (value < cut.bucket))
        edge = edge & (value >= cut.bucket) & (value <= last)
        if value is key and last < _LAST_KEY:
            df = df.filter(F.col(pk) <= literal_like(last, df.schema[pk].dataType))   # this one reaches the files
        need -= cut.cum - cut.row_count
        if need == cut.row_count:
            return df.filter(taken | edge)
    return df.filter(taken).unionAll(df.filter(edge).orderBy(pk, *[c for c in df.columns if c != pk]).limit(need))


def since(df: DataFrame, date: str, start: str | dt.datetime) -> DataFrame:
    """Rows dated at or after `start`, without upper bound."""
    return df.filter(F.col(date) >= literal_like(start, df.schema[date].dataType))


def window(df: DataFrame, date: str, start: str | dt.datetime, end: str | dt.datetime) -> DataFrame:
    """Rows dated in [start, end). Consecutive windows share no row."""
    dtype = df.schema[date].dataType
    return df.filter((F.col(date) >= literal_like(start, dtype)) & (F.col(date) < literal_like(end, dtype)))


def open_window(df: DataFrame, date: str, start: str | dt.datetime, as_of: str | dt.datetime) -> DataFrame:
    """Rows from `start` on, except those dated exactly `as_of`, which open the next window.

    Rows dated after `as_of` are read too, so that validation can reject them and say so; the next
    window sees them again.
    """
    return since(df, date, start).filter(F.col(date) != literal_like(as_of, df.schema[date].dataType))


def above_id(df: DataFrame, pk: str, snapshot_max_id: int) -> DataFrame:
    """Rows added after a snapshot of the key."""
    return df.filter(F.col(pk) > literal_like(snapshot_max_id, df.schema[pk].dataType))


def key_range(df: DataFrame, pk: str, start: int | None, end: int | None) -> DataFrame:
    """Rows with start <= key < end; a bound of None is open."""
    dtype = df.schema[pk].dataType
    if start is not None:
        df = df.filter(F.col(pk) >= literal_like(start, dtype))
    return df if end is None else df.filter(F.col(pk) < literal_like(end, dtype))


def sliced(predicate: str, slices: int, slice_by: str | None) -> list[str]:
    """A WHERE text cut into `slices` by a whole number per row, in the database's SQL; as it is without one."""
    if slices <= 1 or not slice_by:
        return [predicate]
    return [f"({predicate}) AND ABS(COALESCE({slice_by}, 0)) % {slices} = {i}" for i in range(slices)]


def _span(pk: str, start: int | None, end: int | None) -> str:
    parts = [f"{pk} >= {start}"] * (start is not None) + [f"{pk} < {end}"] * (end is not None)
    return " AND ".join(parts) or f"{pk} IS NOT NULL"


def range_predicates(pk: str, plan: DataFrame, slice_by: str | None = None) -> list[str]:
    """WHERE texts, together covering every row once, for a parallel database read: one per range, or as many as the
    plan's `slices` says if `slice_by` tells the rows of a hot key apart."""
    slices = {r.range_id: r.slices for r in plan.select("range_id", "slices").collect()} if "slices" in plan.columns else {}
    keyed = [p for r in collect_plan(plan) for p in sliced(_span(pk, r.start_id, r.end_id), slices.get(r.range_id, 1), slice_by)]
    return keyed + sliced(f"{pk} IS NULL", slices.get(NULL_RANGE, 1), slice_by)


def key_predicates(pk: str, low: int, high: int, parts: int) -> list[str]:
    """WHERE texts for `parts` ranges of equal width between two keys, for a source that cannot be asked for counts;
    outer ones are open, the first takes NULL keys."""
    parts = max(1, min(parts, high - low + 1))
    cuts = [low + (high - low + 1) * i // parts for i in range(1, parts)]
    if not cuts:
        return ["1 = 1"]
    return [f"{pk} < {cuts[0]} OR {pk} IS NULL", *[f"{pk} >= {a} AND {pk} < {b}" for a, b in zip(cuts, cuts[1:])], f"{pk} >= {cuts[-1]}"]


def key_counts_sql(pk: str, table_name: str, low: int, high: int, width: int) -> str:
    """Rows per bucket of keys in [low, high), a row per bucket that has any; low is the first bucket's edge, so that
    whole-number and decimal division give the same bucket."""
    return (f"SELECT FLOOR(({pk} - ({low})) / {width}) AS bucket, COUNT(*) AS row_count FROM {table_name} "
            f"WHERE {pk} >= {low} AND {pk} < {high} GROUP BY FLOOR(({pk} - ({low})) / {width})")


def histogram_predicates(ask: Callable[[str], list], table_name: str, pk: str, parts: int, slice_by: str | None = None) -> list[str]:
    """WHERE texts of about equal row counts, at least `parts` if there are as many keys.

    `ask` runs a query in the database and returns its rows: counts per bucket of keys, at most _BUCKETS rows. A bucket
    over the share of a part is asked about again in finer buckets, so far keys and dense stretches cost another
    question, not an uneven read. A single key over the share is cut by `slice_by`, if given. Outer ranges are open.
    """
    edge = ask(f"SELECT MIN({pk}) AS low, MAX({pk}) AS high, COUNT(*) AS row_count, COUNT({pk}) AS keyed FROM {table_name}")[0]
    share = max(1, -(-int(edge["row_count"]) // max(1, parts)))
    nulls = -(-(int(edge["row_count"]) - int(edge["keyed"])) // share)
    none = sliced(f"{pk} IS NULL", nulls, slice_by)
    if edge["low"] is None:
        return none
    # at most 2^62 wide, so that no difference of two keys overflows
    cuts = [*range(int(edge["low"]), int(edge["high"]) + 1, 1 << 62), int(edge["high"]) + 1]
    found, todo = [], list(zip(cuts, cuts[1:]))   # found: (first key, rows)
    while todo:
        low, high = todo.pop()
        width = -(-(high - low) // _BUCKETS)
        for r in ask(key_counts_sql(pk, table_name, low, high, width)):
            first, rows = low + int(r["bucket"]) * width, int(r["row_count"])
            if rows > share and width > 1:
                todo.append((first, min(high, first + width)))
            else:
                found.append((first, rows))
    out, start, held = [], None, 0
    found.sort()
    for i, (first, rows) in enumerate(found):
        if held and held + rows > share:   # what is held ends where this bucket begins
            out += sliced(_span(pk, start, first), -(-held // share), slice_by)
            start, held = first, 0
        held += rows
    return out + sliced(_span(pk, start, None), -(-held // share), slice_by) + none


def database_table(spark: SparkSession, url: str, table_name: str, pk: str | None, parts: int,
                   properties: dict[str, str] | None = None, slice_by: str | None = None) -> DataFrame:
    """A database table read in about `parts` tasks of equal row counts, by the key's distribution in the database.

    A table without a key column has nothing to be cut by, and is refused."""
    if pk is None:
        raise ValueError(f"{table_name} needs PK_Column_Name in the control table to be read from a database")

    def ask(query: str) -> list:
        return spark.read.jdbc(url, f"({query}) q", properties=properties or {}).collect()
    predicates = histogram_predicates(ask, table_name, pk, parts, slice_by)
    return spark.read.jdbc(url, table_name, predicates=predicates, properties=properties or {})


def database_ranges(spark: SparkSession, url: str, table_name: str, pk: str, plan: DataFrame,
                    properties: dict[str, str], slice_by: str | None = None) -> DataFrame:
    """A database table read with a task per range, or per slice of it. Needs the database's driver on the class path."""
    return spark.read.jdbc(url, table_name, predicates=range_predicates(pk, plan, slice_by), properties=properties)
