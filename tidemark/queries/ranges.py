"""Key ranges: planning, assignment, progress."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import ranges, watermark
from tidemark.queries.fixtures import CLEAN_ORDERS_SQL, ORDERS_AS_OF, SPARSE_KEYS_SQL, sparse_keys, table
from tidemark.queries.cleaning import marked_orders
from tidemark.operators.validate import accepted
from tidemark.queries.registry import query
from tidemark.session import stored
from tidemark.sources import scan

WIDTH, TARGET = 500, 10_000
FIXED = 2_500

_RANGE_PLAN = f"""
WITH keys AS ({SPARSE_KEYS_SQL}),
hist AS (SELECT k - ((k % {WIDTH}) + {WIDTH}) % {WIDTH} AS bucket, count(*) AS row_count FROM keys GROUP BY ALL),
cum AS (SELECT bucket, row_count, CAST(sum(row_count) OVER (ORDER BY bucket) AS BIGINT) AS cum FROM hist WHERE bucket IS NOT NULL),
grp AS (SELECT (cum - 1) // {TARGET} AS g, min(bucket) AS s, CAST(sum(row_count) AS BIGINT) AS row_count FROM cum GROUP BY ALL),
plan AS (SELECT CAST(row_number() OVER (ORDER BY g) - 1 AS INTEGER) AS range_id,
                CASE WHEN row_number() OVER (ORDER BY g) > 1 THEN s END AS start_id, lead(s) OVER (ORDER BY g) AS end_id, row_count
         FROM grp
         UNION ALL SELECT -1, NULL, NULL, row_count FROM hist WHERE bucket IS NULL)"""

_ASSIGNED = """, assigned AS (
SELECT l_orderkey, l_linenumber, k, coalesce(p.range_id, -1) AS range_id
FROM keys LEFT JOIN plan p ON p.range_id >= 0 AND k >= coalesce(p.start_id, -9223372036854775808) AND (p.end_id IS NULL OR k < p.end_id))"""

_FIXED_PLAN = f"""
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
starts AS (SELECT hi, unnest(range(lo, hi + 1, {FIXED})) AS start_id FROM b),
plan AS (SELECT -1 AS range_id, NULL AS start_id, NULL AS end_id UNION ALL
         SELECT CAST(row_number() OVER (ORDER BY start_id) - 1 AS INTEGER) AS range_id,
                CASE WHEN start_id > (SELECT lo FROM b) THEN start_id END AS start_id,
                CASE WHEN start_id + {FIXED} <= hi THEN start_id + {FIXED} END AS end_id FROM starts),
counts AS (SELECT range_id, start_id, end_id, count(*) AS row_count
           FROM plan JOIN orders ON range_id >= 0 AND (start_id IS NULL OR o_orderkey >= start_id) AND (end_id IS NULL OR o_orderkey < end_id) GROUP BY ALL)"""


def _plan(spark, sf):
    return ranges.plan_ranges(sparse_keys(spark, sf), "k", TARGET, WIDTH)


def fixed_counts(spark, sf):
    """Fixed-width ranges of orders with the rows in each; written, so that orders is scanned once however often it is used."""
    orders = table(spark, sf, "orders")
    plan = ranges.plan_fixed(orders, "o_orderkey", FIXED)
    return stored(plan.join(ranges.counts_by_range(orders, "o_orderkey", plan), "range_id"), "counts")


@query(_RANGE_PLAN + f" SELECT *, CAST(ceil(row_count / {TARGET}) AS INTEGER) AS slices FROM plan")
def range_plan(spark, sf):
    return _plan(spark, sf)


@query(_FIXED_PLAN + " SELECT * FROM plan")
def range_plan_fixed(spark, sf):
    return ranges.plan_fixed(table(spark, sf, "orders"), "o_orderkey", FIXED)


@query(_RANGE_PLAN + _ASSIGNED + " SELECT * FROM assigned")
def assign_range(spark, sf):
    return ranges.assign(sparse_keys(spark, sf), "k", _plan(spark, sf))


@query(_RANGE_PLAN + _ASSIGNED + " SELECT range_id, count(*) AS row_count FROM assigned GROUP BY ALL")
def range_counts(spark, sf):
    return ranges.counts_by_range(sparse_keys(spark, sf), "k", _plan(spark, sf))


@query(_FIXED_PLAN + " SELECT range_id, row_count, CAST(ceil(row_count / 1000) AS BIGINT) AS files FROM counts")
def chunk_plan(spark, sf):
    return ranges.file_plan(fixed_counts(spark, sf).select("range_id", "row_count"), 1_000)


def _at(seconds):
    return F.lit(ORDERS_AS_OF).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def range_log(spark, c):
    """A log over the fixed ranges: every third range failed, the others are done, one after the other.

    Before them lie the rows of an earlier run over the same ranges, which was closed.
    """
    rid = F.col("range_id")
    now = c.select(F.lit("export").alias("phase"), rid, F.col("row_count").alias("rows"),
                   _at((rid + 1) * 60).alias("completed_at"), F.when(rid % 3 == 2, "failed").otherwise("done").alias("status"))
    old = c.select(F.lit("export").alias("phase"), rid, F.col("row_count").alias("rows"),
                   _at((rid + 1) * -60).alias("completed_at"), F.lit("done").alias("status"))
    closed = spark.createDataFrame([("export",)], "phase string").select(
        "phase", F.lit(None).cast("int").alias("range_id"), F.lit(None).cast("bigint").alias("rows"),
        F.lit(ORDERS_AS_OF).cast("timestamp_ntz").alias("completed_at"), F.lit("closed").alias("status"))
    return now.unionByName(old).unionByName(closed)


_PROGRESS = _FIXED_PLAN + f""",
done AS (SELECT range_id, row_count AS rows, TIMESTAMP '{ORDERS_AS_OF}' + to_seconds((range_id + 1) * 60) AS completed_at,
                (range_id + 1) * 60 AS secs FROM counts WHERE range_id % 3 <> 2),
prog AS (SELECT range_id, completed_at, rows, CAST(sum(rows) OVER w AS BIGINT) AS cum_rows,
                CAST(CAST(sum(rows) OVER w AS BIGINT) AS DOUBLE) / (SELECT CAST(count(*) AS DOUBLE) FROM orders) * 100 AS percent,
                CASE WHEN secs > 120 THEN CAST(sum(CASE WHEN secs > 120 THEN rows ELSE 0 END) OVER w AS DOUBLE) / CAST(secs - 120 AS DOUBLE) END AS rows_per_second
         FROM done WINDOW w AS (ORDER BY completed_at))"""


@query(_FIXED_PLAN + " SELECT * FROM counts WHERE range_id % 3 = 2")
def pending_ranges(spark, sf):
    counts = fixed_counts(spark, sf)
    return ranges.pending(counts, range_log(spark, counts), "export")


def _progress(spark, sf):
    """The session began two minutes in, after the first ranges were done by an earlier one."""
    counts = fixed_counts(spark, sf)
    return ranges.progress(counts, range_log(spark, counts), "export", "1999-01-01 00:02:00")


@query(_PROGRESS + """ SELECT *, CASE WHEN rows_per_second > 0 THEN CAST(floor(
       CAST((SELECT count(*) FROM orders) - cum_rows AS DOUBLE) / rows_per_second) AS BIGINT) END AS eta_seconds FROM prog""")
def range_progress(spark, sf):
    return _progress(spark, sf)


@query(_PROGRESS + """ SELECT milestone, min(range_id) AS range_id, min(completed_at) AS completed_at, min(cum_rows) AS cum_rows
FROM prog, (VALUES (25), (50), (75), (90), (100)) m(milestone) WHERE percent >= milestone GROUP BY milestone""")
def range_milestones(spark, sf):
    return ranges.milestones(_progress(spark, sf))


@query(_FIXED_PLAN + """, d AS (SELECT count(*) AS n FROM counts WHERE range_id % 3 <> 2)
SELECT 'no target' AS situation, n AS done_ranges, 'create' AS mode FROM d
UNION ALL SELECT 'target of this run', n, CASE WHEN n = 0 THEN 'rebuild' ELSE 'resume' END FROM d
UNION ALL SELECT 'target of a closed run', 0, 'rebuild'""")
def start_modes(spark, sf):
    """Fresh, resumed, or rebuilt, decided by the target and the current run's finished ranges."""
    log = stored(range_log(spark, fixed_counts(spark, sf)), "range_log")
    ended = log.filter(F.col("completed_at") <= F.lit(ORDERS_AS_OF).cast("timestamp_ntz"))

    def case(situation, entries, exists):
        return ranges.done_entries(entries, "export").agg(F.count(F.lit(1)).alias("done_ranges")).select(
            F.lit(situation).alias("situation"), "done_ranges",
            ranges.start_mode(F.lit(exists), F.col("done_ranges")).alias("mode"))
    return (case("no target", log, False).unionByName(case("target of this run", log, True))
            .unionByName(case("target of a closed run", ended, True)))


@query(f"SELECT greatest(max(o_orderkey), 0) AS max_id FROM ({CLEAN_ORDERS_SQL}) WHERE _reject_reason IS NULL")
def batch_max_id(spark, sf):
    return watermark.max_id(accepted(marked_orders(spark, sf)), "o_orderkey")


OUTLIER_TARGET = 1_000


@query("SELECT count(*) + 1 AS planned_rows, count(*) + 1 AS assigned_rows, CAST(0 AS BIGINT) AS crowded_ranges FROM lineitem")
def range_plan_outlier(spark, sf):
    """Lineitem's keys and one far key: no range holds more than the target and one bucket."""
    keys = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("bigint").alias("k"))
    keys = keys.unionByName(keys.limit(1).select(F.lit(10**15).cast("bigint").alias("k")))
    plan = ranges.plan_ranges(keys, "k", OUTLIER_TARGET)
    found = ranges.counts_by_range(keys, "k", plan).agg(F.sum("row_count").alias("assigned_rows"))
    of_plan = plan.agg(F.sum("row_count").alias("planned_rows"), F.count_if(F.col("row_count") > 2 * OUTLIER_TARGET).alias("crowded_ranges"))
    both = of_plan.unionByName(found, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("planned_rows", "assigned_rows", "crowded_ranges")])


TEXT_TARGET = 500


def _fit(planned, assigned, name, bound):
    """Rows planned and assigned, ranges whose counts differ, ranges over the bound that hold more than one key."""
    both = planned.join(assigned, "range_id", "full_outer")
    return both.agg(F.sum("row_count").alias("planned_rows"), F.sum("found").alias("assigned_rows"),
                    F.count_if(F.coalesce("row_count", F.lit(0)) != F.coalesce("found", F.lit(0))).alias("other_counts"),
                    F.count_if((F.col("found") > bound) & (F.col("range_id") >= 0) & (F.col("distinct_keys") > 1)).alias("crowded_ranges"),
                    F.sum("misplaced").alias("misplaced_rows")).select(F.lit(name).alias("key_name"), "*")


def _ordered(df, key, plan, name, bound):
    """Each row's range, looked up, against the plan's own bounds."""
    plan = stored(plan, "plan")
    rows = ranges.assign_ordered(df.select(key), key, plan).join(plan.select("range_id", "start_id", "end_id"), "range_id")
    inside = (F.col("start_id").isNull() | (F.col(key) >= F.col("start_id"))) & (F.col("end_id").isNull() | (F.col(key) < F.col("end_id")))
    found = rows.groupBy("range_id").agg(F.count(F.lit(1)).alias("found"), F.count_distinct(key).alias("distinct_keys"),
                                         F.count_if(~inside).alias("misplaced"))
    return _fit(plan.select("range_id", "row_count"), found, name, bound)


@query("""SELECT 'c_name' AS key_name, count(*) AS planned_rows, count(*) AS assigned_rows, 0::BIGINT AS other_counts, 0::BIGINT AS crowded_ranges,
       0::BIGINT AS misplaced_rows FROM customer
UNION ALL SELECT 'p_name', count(*), count(*), 0, 0, 0 FROM part
UNION ALL SELECT 'url', count(*), count(*), 0, 0, 0 FROM pages
UNION ALL SELECT 'o_orderdate', count(*), count(*), 0, 0, 0 FROM orders""")
def range_plan_text(spark, sf):
    """Ranges over names with a long common beginning, over part names, over urls, and over dates: every row is in the one
    range that its key lies in, and no range holds more than the target and a quarter, unless it is of one key."""
    out = None
    for name, column in (("customer", "c_name"), ("part", "p_name"), ("pages", "url")):
        df = table(spark, sf, name)
        one = _ordered(df, column, ranges.plan_text_ranges(df, column, TEXT_TARGET), column, TEXT_TARGET * 5 // 4)
        out = one if out is None else out.unionByName(one)
    orders = table(spark, sf, "orders")
    return out.unionByName(_ordered(orders, "o_orderdate", ranges.plan_time_ranges(orders, "o_orderdate", TEXT_TARGET), "o_orderdate", 2 * TEXT_TARGET))


PARTS = 24


@query(f"""SELECT count(*) AS row_count, count(*) AS read_rows, CAST(0 AS BIGINT) AS crowded_parts, CAST(0 AS BIGINT) AS overlaps FROM lineitem""")
def database_partitions(spark, sf):
    """Sparse keys with gaps, a heavy key and NULLs read by the predicates that a database would be asked with: every row
    in one part, and no part over twice the share (Spark answers the questions here)."""
    name = f"keys_{uuid.uuid4().hex}"
    keys = sparse_keys(spark, sf).withColumn("line", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    keys.createOrReplaceTempView(name)
    predicates = scan.histogram_predicates(lambda q: spark.sql(q).collect(), name, "k", PARTS, slice_by="line")
    hits = F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)])
    rows = keys.select(F.filter(hits, lambda h: h.isNotNull()).alias("parts"))
    of_part = rows.select(F.explode("parts").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.size("parts") != 1).alias("overlaps"))
    both = total.unionByName(of_part.agg(F.sum("n").alias("read_rows"), F.max("n").alias("most")), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        "row_count", "read_rows", F.when(F.col("most") > 2 * (F.col("row_count") / PARTS + 1), 1).otherwise(0).cast("bigint").alias("crowded_parts"), "overlaps")
