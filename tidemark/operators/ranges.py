"""Key ranges: plan them from the key distribution, assign rows, follow progress.

A plan is a DataFrame (range_id, start_id, end_id, row_count, slices): ranges are half-open
[start_id, end_id), the first and the last are open-ended (NULL bound), and rows without a key form
range -1. So every row of the table, also one that arrives later, is in exactly one range.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.columns import ntz, seconds_between
from tidemark.session import stored

NULL_RANGE = -1
_NO_RANGE = -(1 << 31)   # stands for "no range" in a list of range ids
_START_BUCKETS = 1_000_000   # of the first histogram; buckets over the target are cut up further
_BLOCK = 4_096           # buckets whose running total one task computes

# Fixed values
LOG_SCHEMA = "phase string, range_id int, rows bigint, completed_at timestamp_ntz, status string"
MILESTONES = (25, 50, 75, 90, 100)


def bucket_start(key: Column, width: int) -> Column:
    """Lower edge of the bucket, in exact integer arithmetic and also for negative keys."""
    k = key.cast("bigint")
    return k - F.pmod(k, F.lit(width).cast("bigint"))


def histogram(df: DataFrame, key: str, width: int) -> DataFrame:
    """(bucket, row_count) per occupied bucket, in one scan of the key column; NULL keys are one row."""
    return df.groupBy(bucket_start(F.col(key), width).alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"))


def default_width(df: DataFrame, key: str, target_rows: int) -> int:
    """A sixteenth of the target, so that a bucket of unique keys is well below it; wider over a very wide
    span of keys, where plan_ranges refines what is crowded. Collects one row."""
    b = df.agg(F.min(key).cast("bigint").alias("lo"), F.max(key).cast("bigint").alias("hi")).first()
    span = 0 if b.lo is None else b.hi - b.lo + 1
    return max(1, target_rows // 16, span // _START_BUCKETS)


def running_total(hist: DataFrame, width: int) -> DataFrame:
    """Add `cum`, the rows up to and including each bucket; NULL keys count for nothing.

    Totals run inside blocks of buckets, in parallel; only block sums, 4096 times fewer than
    buckets, meet in one task. The null-safe join leaves both sides of it with the same histogram,
    whose shuffle Spark then does once.
    """
    blocks = hist.withColumn("_block", bucket_start(F.col("bucket"), width * _BLOCK))
    rows = F.sum(F.when(F.col("bucket").isNotNull(), F.col("row_count")))
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.groupBy(F.col("_block").alias("_b")).agg(rows.alias("_rows")).select(
        "_b", F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return blocks.join(offsets, F.col("_block").eqNullSafe(F.col("_b"))).select(
        "bucket", "row_count", (F.sum("row_count").over(inside) + F.col("_before")).alias("cum"))


def _refined(df: DataFrame, key: str, target_rows: int, width: int) -> DataFrame:
    """(bucket, row_count, cum) like running_total, with buckets over the target cut up until they fit or hold one key.

    A level cuts a bucket into at most 4096; its running totals stay inside the bucket. Each level reads the keys
    of its crowded buckets only, and is written, so that going deeper does not compute it again.
    """
    width, k = 1 << (width - 1).bit_length(), F.col(key).cast("bigint")
    level = stored(running_total(histogram(df, key, width), width), "buckets")
    leaves = []
    while width > 1:
        full = level.filter((F.col("row_count") > target_rows) & F.col("bucket").isNotNull())
        if full.isEmpty():
            break
        leaves.append(level.filter((F.col("row_count") <= target_rows) | F.col("bucket").isNull()))
        parents = full.select(F.col("bucket").alias("_p"), (F.col("cum") - F.col("row_count")).alias("_before"))
        rows = df.select(k.alias("_k")).withColumn("_in", bucket_start(F.col("_k"), width)).join(parents, F.col("_in") == F.col("_p"))
        finer = max(1, width // _BLOCK)   # both are powers of two, so parts nest in their bucket
        parts = rows.groupBy("_p", "_before", bucket_start(F.col("_k"), finer).alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"))
        upto = Window.partitionBy("_p").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        level = stored(parts.select("bucket", "row_count", (F.sum("row_count").over(upto) + F.col("_before")).alias("cum")), "buckets")
        width = finer
    for leaf in leaves:
        level = level.unionByName(leaf)
    return level


def plan_ranges(df: DataFrame, key: str, target_rows: int, width: int | None = None) -> DataFrame:
    """Ranges of about `target_rows` rows each.

    Empty buckets vanish, small ones merge, and a dense region is split down to single keys, or to `width`
    if one is given. A range that still has more rows than the target, because one key repeats, says in
    `slices` how many parallel parts it should be read in.
    """
    buckets = (running_total(histogram(df, key, width), width) if width
               else _refined(df, key, target_rows, default_width(df, key, target_rows)))
    group = F.when(F.col("bucket").isNull(), F.lit(NULL_RANGE)).otherwise(F.expr(f"(cum - 1) div {int(target_rows)}"))
    # The range without key is always there: rows without one may turn up after planning.
    none = df.sparkSession.createDataFrame([(NULL_RANGE, None, 0)], "_group bigint, bucket bigint, row_count bigint")
    grouped = buckets.select(group.cast("bigint").alias("_group"), "bucket", "row_count").unionByName(none).groupBy("_group").agg(
        F.min("bucket").alias("_start"), F.sum("row_count").alias("row_count"))
    # One row per range from here on. The range without key sorts first and is not numbered.
    order = Window.orderBy("_group")
    number = F.count("_start").over(order.rowsBetween(Window.unboundedPreceding, 0))
    keyed = F.col("_start").isNotNull()
    return grouped.select(
        F.when(keyed, number - 1).otherwise(F.lit(NULL_RANGE)).cast("int").alias("range_id"),
        F.when(keyed & (number > 1), F.col("_start")).alias("start_id"),
        F.when(keyed, F.lead("_start").over(order)).alias("end_id"),
        "row_count",
        F.greatest(F.ceil(F.col("row_count") / F.lit(target_rows)), F.lit(1)).cast("int").alias("slices"))


def plan_fixed(df: DataFrame, key: str, width: int) -> DataFrame:
    """Ranges of fixed width from the smallest to the largest key. The first and the last are open-ended, and rows
    without a key have range -1, if there are such rows or not: every row, also a later one, is in one range."""
    b = df.agg(F.min(key).cast("bigint").alias("lo"), F.max(key).cast("bigint").alias("hi")).first()
    if b.lo is None:
        return df.sparkSession.createDataFrame([(NULL_RANGE, None, None)], "range_id int, start_id bigint, end_id bigint")
    n = (b.hi - b.lo) // width + 1
    at = F.lit(b.lo).cast("bigint") + F.col("id") * F.lit(width).cast("bigint")
    return df.sparkSession.range(-1, n).select(
        F.col("id").cast("int").alias("range_id"), F.when(F.col("id") > 0, at).alias("start_id"),
        F.when((F.col("id") >= 0) & (F.col("id") < n - 1), at + F.lit(width).cast("bigint")).alias("end_id"))


def collect_plan(plan: DataFrame) -> list:
    """The keyed ranges in order: a row per range, as many as the table has rows over the target."""
    rows = plan.select("range_id", "start_id", "end_id").filter(F.col("range_id") != NULL_RANGE).collect()
    return sorted(rows, key=lambda r: r.range_id)


def edges_of(found: list) -> tuple[list, list]:
    """The edges of ranges that do not overlap, rising, and what lies before, between and after them: a range id or None."""
    edges, labels = [], [None]
    for r in sorted(found, key=lambda r: (r.start_id is not None, r.start_id)):
        if r.start_id is not None and r.end_id is not None and r.end_id <= r.start_id:
            continue   # an empty range
        if r.start_id is None:
            fits = not edges and labels == [None]
        elif edges and edges[-1] == r.start_id:
            fits = labels.pop() is None
        else:
            fits = labels[-1] is None and (not edges or edges[-1] < r.start_id)
            edges.append(r.start_id)
        if not fits:
            raise ValueError(f"range {r.range_id} overlaps another one")
        labels = [r.range_id] if r.start_id is None else [*labels, r.range_id]
        if r.end_id is not None:
            edges.append(r.end_id)
            labels.append(None)
    return edges, labels


def position(key: Column, edges: Column, count: int) -> Column:
    """How many of the `count` rising edges are at or below the key, by binary search in an array."""
    halves = [1 << i for i in reversed(range(count.bit_length()))]
    if not halves:
        return F.lit(0)
    return F.aggregate(F.array(*[F.lit(h) for h in halves]), F.lit(0), lambda at, half: at + F.when(
        F.get(edges, at + half - 1) <= key, half).otherwise(0))   # beyond the last edge `get` gives NULL


def range_of(key: Column, found: list) -> Column:
    """The id of the range that a whole-number key lies in, NULL outside of all.

    Edges and ids are two arrays in the plan, which Spark folds to constants, and every row is looked up where it is:
    no join, no shuffle, and steps that grow with the logarithm of the number of ranges only.
    """
    edges, labels = edges_of(found)
    ids = [_NO_RANGE if r is None else r for r in labels]
    if len(ids) == 1:
        return F.lit(labels[0]).cast("int")

    def constant(values: list, dtype: str) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{dtype}>")
    at = position(key, constant(edges, "bigint"), len(edges))
    return F.nullif(F.get(constant(ids, "int"), at), F.lit(_NO_RANGE))


def assign_found(df: DataFrame, key: str, found: list) -> DataFrame:
    """Add `range_id` for collected ranges; NULL for what they do not cover, rows without a key among it if -1 is not there."""
    k = F.col(f"`{key}`").cast("bigint")
    keyless = F.lit(NULL_RANGE if any(r.range_id == NULL_RANGE for r in found) else None).cast("int")
    inside = range_of(k, [r for r in found if r.range_id != NULL_RANGE])
    return df.withColumn("range_id", F.when(k.isNull(), keyless).otherwise(inside))


def assign(df: DataFrame, key: str, plan: DataFrame) -> DataFrame:
    """Add `range_id`: -1 without a key, NULL if the plan does not cover the key.

    The plan, a row per range, is collected and becomes a constant of the lookup (see range_of).
    """
    inside = range_of(F.col(f"`{key}`").cast("bigint"), collect_plan(plan))
    return df.withColumn("range_id", F.when(F.col(f"`{key}`").isNull(), F.lit(NULL_RANGE)).otherwise(inside))


def plan_time_ranges(df: DataFrame, key: str, target_rows: int) -> DataFrame:
    """Like plan_ranges over a date or a timestamp without zone; the edges are of the key's type."""
    if isinstance(df.schema[key].dataType, T.DateType):
        number, back = F.unix_date(key), lambda c: F.date_from_unix_date(c.cast("int"))
    else:
        number, back = F.unix_micros(F.col(key).cast("timestamp")), lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    plan = plan_ranges(df.select(number.cast("bigint").alias("_number")), "_number", target_rows)
    return plan.withColumns({"start_id": back(F.col("start_id")), "end_id": back(F.col("end_id"))})


def _shared(a: str, b: str) -> int:
    """How many characters two texts begin with alike."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def plan_text_ranges(df: DataFrame, key: str, target_rows: int) -> DataFrame:
    """(range_id, start_id, end_id, row_count, slices) over a text key; range -1 takes rows without one.

    Rows are counted by the first characters of the key. A beginning with more than a quarter of the target is counted
    again by one character more than what its smallest and largest key share, so common beginnings cost no level. The
    counts of beginnings, in order, merge to ranges: at most the target and a quarter, but for a key that repeats more
    often, which shows in `slices`. Crowded beginnings, fewer than four times the ranges, reach the driver.
    """
    crowd = max(1, target_rows // 4)
    rows = df.select(F.col(f"`{key}`").cast("string").alias("_k"))
    first = rows.filter("_k is not null").agg(F.min("_k").alias("lo"), F.max("_k").alias("hi")).first()
    leaves = rows.filter("_k is null").agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("string").alias("head"), "n")
    todo = [] if first.lo is None else [("", _shared(first.lo, first.hi) + 1)]
    while todo:
        parents = df.sparkSession.createDataFrame([(p, len(p), n) for p, n in todo], "_head string, _length int, _next int")
        if len(todo) == 1 and todo[0][0] == "":
            cut = rows.filter("_k is not null").withColumn("_next", F.lit(todo[0][1]))
        else:   # the length is joined as well, a bucket per length, so that beginnings of different length do not meet
            lengths = sorted({len(p) for p, _ in todo})
            heads = F.array(*[F.when(F.length("_k") >= n, F.struct(F.substring("_k", 1, n).alias("_head"), F.lit(n).alias("_length"))) for n in lengths])
            cut = rows.filter("_k is not null").select("_k", F.explode(F.filter(heads, lambda h: h.isNotNull())).alias("_h")).select(
                "_k", "_h.*").join(parents, ["_head", "_length"])
        counted = stored(cut.groupBy(F.expr("substring(_k, 1, _next)").alias("head")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_k").alias("lo"), F.max("_k").alias("hi")), "beginnings")
        full = (F.col("n") > crowd) & (F.col("lo") != F.col("hi"))
        leaves = leaves.unionByName(counted.filter(~full).select("head", "n"))
        todo = [(r["head"], _shared(r["lo"], r["hi"]) + 1) for r in counted.filter(full).collect()]
    leaves = stored(leaves, "leaves")
    upto = Window.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)   # beginnings, some per range
    keyed = leaves.filter("head is not null").select("head", "n", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    grouped = keyed.groupBy(F.expr(f"before div {int(target_rows)}").alias("_group")).agg(F.min("head").alias("_start"), F.sum("n").alias("row_count"))
    order = Window.orderBy("_group")
    number = F.row_number().over(order) - 1
    slices = F.greatest(F.ceil(F.col("row_count") / F.lit(target_rows)), F.lit(1)).cast("int").alias("slices")
    plan = grouped.select(number.cast("int").alias("range_id"), F.when(number > 0, F.col("_start")).alias("start_id"),
                          F.lead("_start").over(order).alias("end_id"), "row_count", slices)
    none = F.lit(None).cast("string")
    return plan.unionByName(leaves.filter("head is null").select(
        F.lit(NULL_RANGE).alias("range_id"), none.alias("start_id"), none.alias("end_id"), F.col("n").alias("row_count")).select("*", slices))


def assign_ordered(df: DataFrame, key: str, plan: DataFrame) -> DataFrame:
    """Add `range_id` for a plan over a key of any type with an order that has no gaps; -1 without a key."""
    dtype = df.schema[key].dataType
    starts = [r.start_id for r in collect_plan(plan) if r.start_id is not None]
    if not starts:
        at = F.lit(0)
    else:
        at = position(F.col(f"`{key}`"), F.array(*[F.lit(s).cast(dtype) for s in starts]), len(starts))
    return df.withColumn("range_id", F.when(F.col(f"`{key}`").isNull(), F.lit(NULL_RANGE)).otherwise(at))


def counts_by_range(df: DataFrame, key: str, plan: DataFrame) -> DataFrame:
    """Rows per range for all ranges in one scan; ranges without rows do not appear."""
    return assign(df.select(key), key, plan).groupBy("range_id").agg(F.count(F.lit(1)).alias("row_count"))


def file_plan(counts: DataFrame, rows_per_file: int) -> DataFrame:
    """Files each range needs at `rows_per_file` rows per file."""
    return counts.withColumn("files", F.ceil(F.col("row_count") / F.lit(rows_per_file)).cast("bigint"))


def done_entries(log: DataFrame, phase: str) -> DataFrame:
    """Finished ranges of the run in progress: a `closed` row ends a run and outdates what is before it."""
    log = log.filter(F.col("phase") == phase)
    closed = log.filter("status = 'closed'").groupBy("phase").agg(F.max("completed_at").alias("_closed"))
    return (log.filter("status = 'done'").join(closed, "phase", "left")
            .filter("_closed is null or completed_at > _closed").drop("_closed"))


def pending(plan: DataFrame, log: DataFrame, phase: str) -> DataFrame:
    """Planned ranges that the current run has not finished. A failed range is still pending."""
    return plan.join(done_entries(log, phase).select("range_id").distinct(), "range_id", "left_anti")


def start_mode(target_exists: Column, done: Column) -> Column:
    """create (no target), rebuild (target from an earlier run), resume (target of this run)."""
    return F.when(~target_exists, "create").when(done == 0, "rebuild").otherwise("resume")


def progress(plan: DataFrame, log: DataFrame, phase: str, session_start: str | dt.datetime) -> DataFrame:
    """Per finished range: rows so far, percent of the whole plan, rate and time left.

    The total is that of the whole plan and the rate counts this session's rows only, so a resumed
    run neither passes 100 % nor looks faster than it is.
    """
    # One row per range, so that windows over all of them are small.
    total = F.sum("row_count").over(Window.partitionBy())
    done = (plan.select("range_id", "row_count").join(done_entries(log, phase), "range_id", "left")
            .withColumn("_total", total).filter("completed_at is not null"))
    upto = Window.orderBy("completed_at", "range_id").rowsBetween(Window.unboundedPreceding, 0)
    start = ntz(session_start)
    mine = F.when(F.col("completed_at") > start, F.col("rows")).otherwise(F.lit(0))
    done = done.withColumns({"cum_rows": F.sum("rows").over(upto), "_mine": F.sum(mine).over(upto)})
    seconds = seconds_between(start, F.col("completed_at"))
    rate = F.when(seconds > 0, F.col("_mine").cast("double") / seconds.cast("double"))
    left = F.col("_total") - F.col("cum_rows")
    return done.select(
        "range_id", "completed_at", "rows", "cum_rows",
        (F.col("cum_rows").cast("double") / F.col("_total").cast("double") * 100).alias("percent"),
        rate.alias("rows_per_second"),
        F.when(rate > 0, F.floor(left.cast("double") / rate)).cast("bigint").alias("eta_seconds"))


def milestones(progress_rows: DataFrame, marks: tuple[int, ...] = MILESTONES) -> DataFrame:
    """The first range at or past each percent mark."""
    crossed = progress_rows.select("*", F.explode(F.array(*[F.lit(m) for m in marks])).alias("milestone")).filter(
        "percent >= milestone")
    first = F.min(F.struct("completed_at", "range_id", "cum_rows")).alias("f")
    return crossed.groupBy("milestone").agg(first).select("milestone", "f.range_id", "f.completed_at", "f.cum_rows")
