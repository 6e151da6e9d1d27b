"""Range planning, assignment, progress and migration on hand-made keys."""

import time
import uuid
from collections import namedtuple

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import ranges, sink
from tidemark.plans import migrate
from tidemark.session import work_root
from tidemark.sources import scan, staged

Range = namedtuple("Range", "range_id start_id end_id")
T0, T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def keys_df(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k bigint")


def folder(spark):
    return f"{work_root(spark)}/test-{uuid.uuid4().hex}"


keys = st.lists(st.one_of(st.none(), st.integers(-60, 60), st.integers(-2**62, 2**62)), max_size=40)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys, st.integers(1, 50), st.integers(1, 12))
def test_plan_covers_every_key_once(spark, ks, width, target):
    df = keys_df(spark, ks)
    plan = ranges.plan_ranges(df, "k", target, width)
    rows = sorted(plan.collect(), key=lambda r: r.range_id)
    keyed = [r for r in rows if r.range_id >= 0]
    assert [r.range_id for r in keyed] == list(range(len(keyed)))
    for a, b in zip(keyed, keyed[1:]):
        assert a.end_id == b.start_id
    if keyed:
        assert keyed[0].start_id is None and keyed[-1].end_id is None
    assert sum(r.row_count for r in rows) == len(ks) and rows[0].range_id == -1

    def where(k):
        if k is None:
            return -1
        return next(r.range_id for r in keyed if (r.start_id is None or k >= r.start_id) and (r.end_id is None or k < r.end_id))
    assigned = ranges.assign(df, "k", plan).collect()
    assert len(assigned) == len(ks) and all(r.range_id == where(r.k) for r in assigned)
    by_range = {r.range_id: r.row_count for r in ranges.counts_by_range(df, "k", plan).collect()}
    assert by_range == {r.range_id: r.row_count for r in rows if r.row_count}


def test_running_total_over_many_blocks(spark):
    df = spark.range(0, 100_000, 3).select(F.col("id").alias("k"))
    got = [r.cum for r in ranges.running_total(ranges.histogram(df, "k", 2), 2).orderBy("bucket").collect()]
    n = spark.range(0, 100_000, 3).count()
    assert got[-1] == n and all(a < b for a, b in zip(got, got[1:]))
    assert got == sorted(got) and got[0] == 1


def test_hot_key_says_how_many_slices(spark):
    df = keys_df(spark, list(range(100)) + [50] * 200)
    plan = ranges.plan_ranges(df, "k", 20, 1).collect()
    assert max(r.slices for r in plan) >= 200 // 20
    assert sum(r.row_count for r in plan) == 300


def test_fixed_plan_covers_every_key(spark):
    plan = ranges.plan_fixed(keys_df(spark, [10, 19]), "k", 5)
    assert sorted(tuple(r) for r in plan.collect()) == [(-1, None, None), (0, None, 15), (1, 15, None)]
    got = {r.k: r.range_id for r in ranges.assign(keys_df(spark, [9, 10, 19, 20, None]), "k", plan).collect()}
    assert got == {9: 0, 10: 0, 19: 1, 20: 1, None: -1}


def test_fixed_plan_of_a_single_key(spark):
    assert sorted(tuple(r) for r in ranges.plan_fixed(keys_df(spark, [7]), "k", 5).collect()) == [(-1, None, None), (0, None, None)]
    assert [tuple(r) for r in ranges.plan_fixed(keys_df(spark, []), "k", 5).collect()] == [(-1, None, None)]
    wide = ranges.plan_fixed(keys_df(spark, [0, 2**62]), "k", 2**45)   # too many starts for one row
    assert wide.count() == 2**17 + 2


def test_far_keys_do_not_spoil_plan_or_lookup(spark):
    keys = [*range(20_000), *range(10**15, 10**15 + 300), -10**15, None]
    df = keys_df(spark, keys)
    plan = ranges.plan_ranges(df, "k", 100)
    rows = plan.collect()
    assert sum(r.row_count for r in rows) == len(keys) and max(r.row_count for r in rows) <= 200
    by_id = {r.range_id: r for r in rows}
    for r in ranges.assign(df, "k", plan).collect():
        own = by_id[r.range_id]
        if r.k is None:
            assert r.range_id == -1
        else:
            assert (own.start_id is None or own.start_id <= r.k) and (own.end_id is None or r.k < own.end_id)


def test_one_repeated_key_is_one_range_with_slices(spark):
    plan = ranges.plan_ranges(keys_df(spark, [5] * 1000 + list(range(10**12, 10**12 + 50))), "k", 100).collect()
    assert max(r.slices for r in plan) == 10 and sum(r.row_count for r in plan) == 1050


def test_lookup_is_a_constant_of_the_plan(spark, sf):
    """No shuffle, no join, arrays folded; 5,000 uneven ranges cost about as much as 50."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select((F.col("l_orderkey") * 7 % 15_000).alias("k"))
    took = {}
    for n in (50, 5_000):
        edges = sorted({i * i % 15_000 + i % 3 for i in range(2 * n)})[:n]
        found = [Range(i, a, b) for i, (a, b) in enumerate(zip([None, *edges], [*edges, None]))]
        df = ranges.assign_found(lines, "k", found)
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in text and "split(" not in text
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        for _ in range(3):
            start = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            took[n] = time.perf_counter() - start
    assert took[5_000] < 3 * took[50] + 0.5


def test_edges_of_gaps_empty_and_overlapping_ranges(spark):
    found = [Range(4, 20, 30), Range(1, None, 5), Range(2, 5, 5), Range(3, 5, 9), Range(9, 40, None)]
    assert ranges.edges_of(found) == ([5, 9, 20, 30, 40], [1, 3, None, 4, None, 9])
    got = {r.k: r.range_id for r in ranges.assign_found(keys_df(spark, [-9, 4, 5, 8, 9, 19, 20, 29, 30, 39, 40, 99, None]), "k", found).collect()}
    assert got == {-9: 1, 4: 1, 5: 3, 8: 3, 9: None, 19: None, 20: 4, 29: 4, 30: None, 39: None, 40: 9, 99: 9, None: None}
    for a, b in [(Range(1, 0, 9), Range(2, 5, 12)), (Range(1, None, 9), Range(2, None, 5)), (Range(1, 3, None), Range(2, 5, 9)), (Range(1, 3, 9), Range(2, 3, 5))]:
        with pytest.raises(ValueError):
            ranges.edges_of([a, b])


def test_default_width_is_bounded(spark):
    assert ranges.default_width(keys_df(spark, [0, 10**15]), "k", 160) == (10**15 + 1) // 1_000_000
    assert ranges.default_width(keys_df(spark, [0, 10]), "k", 160) == 10
    assert ranges.default_width(keys_df(spark, []), "k", 1) == 1


def test_plan_reads_the_table_once(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    plan = ranges.plan_ranges(lines, "l_orderkey", 10_000, 500)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "Reused" in final


def test_predicates_cover_the_table(spark):
    ks = [None, -5, 0, 3, 7, 7, 7, 100]
    df = keys_df(spark, ks)
    plan = ranges.plan_ranges(df, "k", 3, 1)
    assert sum(df.filter(p).count() for p in scan.range_predicates("k", plan)) == len(ks)


def test_progress_stays_within_the_plan(spark):
    plan = spark.createDataFrame([(0, 100), (1, 100), (2, 200)], "range_id int, row_count bigint")
    log = spark.sql(f"""select * from values ('load', 0, 100L, timestamp_ntz'{T0}', 'done'),
        ('load', 1, 100L, timestamp_ntz'2024-01-02 00:01:40', 'done'), ('load', 2, 5L, timestamp_ntz'2024-01-02 00:02:00', 'failed')
        as t(phase, range_id, rows, completed_at, status)""")
    p = ranges.progress(plan, log, "load", T1).orderBy("completed_at").collect()
    assert [(r.cum_rows, r.percent, r.rows_per_second, r.eta_seconds) for r in p] == [(100, 25.0, None, None), (200, 50.0, 1.0, 200)]
    m = {r.milestone: r.range_id for r in ranges.milestones(ranges.progress(plan, log, "load", T1)).collect()}
    assert m == {25: 0, 50: 1}


@pytest.fixture
def orders(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet")


def test_migration_resumes_and_closes(spark, orders):
    root = folder(spark)
    staged, log = f"{root}/staged", f"{root}/log"
    plan = ranges.plan_ranges(orders, "o_orderkey", 4_000)
    first = migrate.export_ranges(spark, orders, "o_orderkey", plan.filter("range_id = 1"), staged, log, T0)
    assert [r.status for r in first.collect()] == ["done"]
    rest = migrate.export_ranges(spark, orders, "o_orderkey", plan, staged, log, T1)
    assert 1 not in {r.range_id for r in rest.collect()}
    assert migrate.export_ranges(spark, orders, "o_orderkey", plan, staged, log, T2) is None
    assert spark.read.parquet(staged).count() == orders.count()
    migrate.load_ranges(spark, staged, f"{root}/target", log, T1)
    assert migrate.load_ranges(spark, staged, f"{root}/target", log, T2) is None
    migrate.close(spark, log, "load", T2)
    again = migrate.load_ranges(spark, staged, f"{root}/target", log, "2024-01-04 00:00:00")
    assert again is not None and spark.read.parquet(f"{root}/target").count() == orders.count()


def test_a_short_range_is_failed_and_pending(spark, orders):
    root = folder(spark)
    plan = ranges.plan_fixed(orders, "o_orderkey", 5_000)
    plan = plan.join(ranges.counts_by_range(orders, "o_orderkey", plan), "range_id")
    lossy = orders.filter("not (o_orderkey between 5000 and 5009)")
    log = migrate.export_ranges(spark, lossy, "o_orderkey", plan, f"{root}/s", f"{root}/log", T0)
    assert {r.range_id: r.status for r in log.collect()} == {0: "done", 1: "failed", 2: "done"}
    left = ranges.pending(plan, sink.read_log(spark, f"{root}/log", ranges.LOG_SCHEMA), "export")
    assert [r.range_id for r in left.collect()] == [1]
    migrate.export_ranges(spark, orders, "o_orderkey", plan, f"{root}/s", f"{root}/log", T1)
    assert spark.read.parquet(f"{root}/s").count() == orders.count()


def test_an_export_without_rows_is_failed(spark, orders):
    root = folder(spark)
    plan = spark.createDataFrame([(0, 0, 10, 5)], "range_id int, start_id bigint, end_id bigint, row_count bigint")
    log = migrate.export_ranges(spark, orders.filter("o_orderkey < 0"), "o_orderkey", plan, f"{root}/s", f"{root}/log", T0)
    assert [(r.rows, r.status) for r in log.collect()] == [(0, "failed")]


def test_rows_after_the_snapshot_come_by_id(spark, orders):
    snap = migrate.snapshot(orders.filter("o_orderkey < 10000"), "o_orderkey").first()
    inside = migrate.within_snapshot(orders, "o_orderkey", snap.snapshot_max_id)
    later = scan.above_id(orders, "o_orderkey", snap.snapshot_max_id)
    assert inside.count() == snap.row_count == 10_000 and inside.count() + later.count() == orders.count()


def test_resumed_export_cuts_the_scan(spark, orders):
    plan = ranges.plan_fixed(orders, "o_orderkey", 5_000)
    todo = [r for r in plan.collect() if r.range_id != 1]
    text = orders.filter(migrate.key_filter("o_orderkey", todo))._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderkey,5000)" in text and "GreaterThanOrEqual(o_orderkey,10000)" in text


def test_a_new_run_leaves_no_range_of_the_old_one(spark, orders):
    root = folder(spark)
    paths = (f"{root}/s", f"{root}/log")
    for at, later, width in ((T0, T1, 1_000), (T2, "2024-01-04 00:00:00", 5_000)):
        plan = ranges.plan_fixed(orders, "o_orderkey", width)
        plan = plan.join(ranges.counts_by_range(orders, "o_orderkey", plan), "range_id")
        migrate.export_ranges(spark, orders, "o_orderkey", plan, *paths, at)
        migrate.load_ranges(spark, f"{root}/s", f"{root}/t", f"{root}/log", at)
        for phase in ("export", "load"):
            migrate.close(spark, f"{root}/log", phase, later)
    for place in ("s", "t"):
        rows = spark.read.parquet(f"{root}/{place}")
        assert (rows.count(), rows.select("range_id").distinct().count()) == (orders.count(), 3)


def test_finished_jobs_stay_done_when_a_later_one_fails(spark, orders, monkeypatch):
    root = folder(spark)
    args = (f"{root}/s", f"{root}/log")
    plan = ranges.plan_fixed(orders, "o_orderkey", 5_000)
    plan = plan.join(ranges.counts_by_range(orders, "o_orderkey", plan), "range_id")
    real, calls = sink.write_ranges, []

    def breaks(*a, **kw):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("cluster gone")
        return real(*a, **kw)
    monkeypatch.setattr(sink, "write_ranges", breaks)
    with pytest.raises(OSError):
        migrate.export_ranges(spark, orders, "o_orderkey", plan, *args, T0, ranges_per_job=1)
    monkeypatch.setattr(sink, "write_ranges", real)
    rest = migrate.export_ranges(spark, orders, "o_orderkey", plan, *args, T1, ranges_per_job=1)
    assert [r.range_id for r in rest.collect()] == [2]
    assert spark.read.parquet(args[0]).count() == orders.count()


def test_staged_text_loads_with_a_declared_schema(spark, sf):
    root = f"{work_root(spark)}/csv-load-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "5", "a"), (2, "x", "b"), (None, "7", None)], "k bigint, n string, t string")
    plan = ranges.plan_fixed(df, "k", 1)
    staged.export_ranges_csv(ranges.assign(df, "k", plan), f"{root}/staged")
    done = migrate.load_ranges(spark, f"{root}/staged", f"{root}/target", f"{root}/log", "2024-01-01 00:00:00",
                               schema="k bigint, n int, t string", csv_schema="k bigint, n string, t string")
    assert {(r.range_id, r.rows, r.status) for r in done.collect()} == {(-1, 1, "done"), (0, 1, "done"), (1, 1, "done")}
    got = spark.read.parquet(f"{root}/target")
    assert {(r.k, r.n, r.t, r.range_id) for r in got.collect()} == {(1, 5, "a", 0), (2, None, "b", 1), (None, 7, None, -1)}


def test_rows_of_a_failed_export_are_not_loaded_nor_closed(spark, orders):
    """A range that lost rows stays pending in both phases until it is exported whole."""
    root = folder(spark)
    plan = ranges.plan_ranges(orders, "o_orderkey", 4_000).cache()
    lossy = orders.filter("not (o_orderkey between 5000 and 5009)")
    migrate.export_ranges(spark, lossy, "o_orderkey", plan, f"{root}/s", f"{root}/log", T0)
    migrate.load_ranges(spark, f"{root}/s", f"{root}/t", f"{root}/log", T0, plan=plan)
    log = sink.read_log(spark, f"{root}/log", ranges.LOG_SCHEMA)
    assert migrate.unfinished(plan, log) == 2
    assert {r.range_id for r in ranges.pending(plan, log, "load").collect()} == {1}
    assert migrate.load_ranges(spark, f"{root}/s", f"{root}/t", f"{root}/log", T1, plan=plan) is None
    migrate.export_ranges(spark, orders, "o_orderkey", plan, f"{root}/s", f"{root}/log", T1)
    migrate.load_ranges(spark, f"{root}/s", f"{root}/t", f"{root}/log", T1, plan=plan)
    assert migrate.unfinished(plan, sink.read_log(spark, f"{root}/log", ranges.LOG_SCHEMA)) == 0
    assert spark.read.parquet(f"{root}/t").count() == orders.count()


def test_staged_rows_that_get_lost_fail_the_load(spark, orders):
    root = folder(spark)
    plan = ranges.plan_ranges(orders, "o_orderkey", 4_000).cache()
    migrate.export_ranges(spark, orders, "o_orderkey", plan, f"{root}/s", f"{root}/log", T0)
    sink.write_ranges(ranges.assign(orders, "o_orderkey", plan).filter("range_id = 1 and o_orderkey % 2 = 0"), f"{root}/s")
    done = migrate.load_ranges(spark, f"{root}/s", f"{root}/t", f"{root}/log", T0, plan=plan)
    assert {r.range_id for r in done.collect() if r.status == "failed"} == {1}


def test_rows_without_a_key_after_planning_are_exported(spark, orders):
    root = folder(spark)
    plan = ranges.plan_ranges(orders, "o_orderkey", 4_000).cache()
    more = orders.unionByName(orders.limit(7).withColumn("o_orderkey", F.lit(None).cast("bigint")))
    migrate.export_ranges(spark, more, "o_orderkey", plan, f"{root}/s", f"{root}/log", T0)
    migrate.load_ranges(spark, f"{root}/s", f"{root}/t", f"{root}/log", T0, plan=plan)
    assert spark.read.parquet(f"{root}/t").filter("range_id = -1").count() == 7
    assert spark.read.parquet(f"{root}/t").count() == orders.count() + 7


def test_an_export_has_one_shuffle(spark, orders, monkeypatch):
    plans = []
    monkeypatch.setattr(sink, "write_ranges", lambda df, *a, **kw: plans.append(df.hint("rebalance", "range_id")._jdf.queryExecution().executedPlan().toString()))
    plan = ranges.plan_ranges(orders, "o_orderkey", 1_000).cache()
    migrate.export_ranges(spark, orders, "o_orderkey", plan, f"{folder(spark)}/s", f"{folder(spark)}/log", T0)
    assert plans[0].count("Exchange") == 1 and "Join" not in plans[0]


def asked(spark, keys):
    """A database that answers in Spark's SQL, and how often it was asked."""
    spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, v int").createOrReplaceTempView("keys_table")
    questions = []

    def ask(query):
        questions.append(query)
        rows = spark.sql(query).collect()
        assert len(rows) <= scan._BUCKETS + 1
        return rows
    return ask, questions


@pytest.mark.parametrize("keys, parts, at_most", [
    ([*range(5000)], 10, 600), ([*range(3000), 10**15, None], 8, 500), ([*range(1000)] + [*range(-10**12, -10**12 + 1000)], 10, 300),
    ([7] * 3000 + [*range(1000)] + [None] * 2000, 12, 600), ([None] * 50, 5, 10), ([5], 4, 1), ([], 4, 0), ([-2**62, 2**62, 0], 3, 1)])
def test_database_partitions_follow_the_keys(spark, keys, parts, at_most):
    ask, questions = asked(spark, keys)
    predicates = scan.histogram_predicates(ask, "keys_table", "k", parts, slice_by="v")
    counts = [spark.sql(f"SELECT v FROM keys_table WHERE {p}").collect() for p in predicates]
    assert sorted(r.v for part in counts for r in part) == list(range(len(keys)))
    assert max(map(len, counts), default=0) <= at_most and len(questions) < 10


def test_slices_of_a_plan_cut_a_hot_key(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate([*range(100)] + [50] * 200 + [None] * 30)], "k bigint, v int")
    plan = ranges.plan_ranges(df, "k", 20, 1)
    whole, cut = scan.range_predicates("k", plan), scan.range_predicates("k", plan, slice_by="v")
    assert len(cut) > len(whole)
    for predicates in (whole, cut):
        assert sorted(r.v for p in predicates for r in df.filter(p).collect()) == list(range(330))
    assert max(df.filter(p).count() for p in cut) <= 45 < max(df.filter(p).count() for p in whole)
