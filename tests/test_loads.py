"""Scans, sinks, text files, whole runs and streams."""

import glob
import random
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import relocate, sink, watermark
from tidemark.operators.stamp import stamp
from tidemark.operators.validate import REASON, Rules, mark
from tidemark.plans import audit, control, migrate, monitoring, sync
from tidemark.queries.loads import stream_late
from tidemark.session import work_root
from tidemark.sources import scan, staged
from tidemark.streaming import ingest, late

T0, T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def folder(spark):
    return f"{work_root(spark)}/test-{uuid.uuid4().hex}"


def pushed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet")


def test_scans_push_their_filters(orders):
    assert "GreaterThanOrEqual(o_orderdate,1998-06-01T00:00)" in pushed(scan.since(orders, "o_orderdate", "1998-06-01 00:00:00"))
    both = pushed(scan.window(orders, "o_orderdate", "1998-06-01 00:00:00", "1999-01-01 00:00:00"))
    assert "GreaterThanOrEqual(o_orderdate" in both and "LessThan(o_orderdate" in both
    assert "GreaterThan(o_orderkey,5)" in pushed(scan.above_id(orders, "o_orderkey", 5))
    assert "LessThan(o_orderkey,9)" in pushed(scan.key_range(orders, "o_orderkey", 3, 9))


def test_windows_meet_without_overlap(orders):
    cuts = ["1995-01-01 00:00:00", "1997-03-04 00:00:00", "2100-01-01 00:00:00"]
    assert sum(scan.window(orders, "o_orderdate", a, b).count() for a, b in zip(cuts, cuts[1:])) == orders.count()


@pytest.mark.parametrize("n", [1, 7, 60, 99, 100, 299, 300, 350])
def test_first_rows_against_sorting(spark, n):
    """A key with a third of all rows, exact copies, NULL keys, negative keys."""
    rng = random.Random(5)
    rows = [(5, rng.randint(0, 3)) for _ in range(100)] + [(rng.randint(-50, 10**6), i) for i in range(150)] + [(None, i) for i in range(50)]
    df = spark.createDataFrame(rows, "k bigint, v int").repartition(4)
    got = scan.first_rows(df, "k", n).collect()
    last = 2**63
    want_keys = sorted(last if k is None else k for k, _ in rows)[:n]
    assert sorted(last if r.k is None else r.k for r in got) == want_keys
    left = list(rows)
    for r in got:
        left.remove(tuple(r))   # each row at most as often as it is there


def test_small_tables_are_not_sampled(orders):
    assert scan.sample(orders, "o_orderkey", 20_000).count() == 15_000
    assert scan.sample(orders, "o_orderkey", 10).count() == 10


def batch(df, name, at, rules=Rules(pk="id", date="day")):
    return mark(stamp(df, name, at, 1), rules, at)


def rows(spark, data):
    return spark.createDataFrame(data, "id bigint, day string")


def test_repeating_a_batch_changes_nothing(spark):
    path = folder(spark)
    sink.write_batch(batch(rows(spark, [(1, T0), (2, T0)]), "b1", T1), path, "b1")
    for _ in range(2):
        counts = sink.write_batch(batch(rows(spark, [(3, T0), (None, T0), (4, T2)]), "b2", T1), path, "b2", gather=True)
        assert {(r.status, r.reason, r.rows) for r in counts.collect()} == {
            ("accepted", None, 1), ("rejected", "null_pk", 1), ("rejected", "future_date", 1)}
    assert sorted(r.id for r in sink.read_accepted(spark, path).collect()) == [1, 2, 3]
    assert sink.read_rejected(spark, path).count() == 2 and REASON in sink.read_rejected(spark, path).columns


def test_a_repeat_that_leaves_a_side_empty_clears_it(spark):
    path = folder(spark)
    sink.write_batch(batch(rows(spark, [(1, T0), (None, T0)]), "b1", T1), path, "b1")
    sink.write_batch(batch(rows(spark, [(9, T0)]), "b2", T1), path, "b2")
    counts = sink.write_batch(batch(rows(spark, [(None, T0)]), "b1", T1), path, "b1")
    assert [(r.status, r.rows) for r in counts.collect()] == [("rejected", 1)]
    assert [r.id for r in sink.read_accepted(spark, path).collect()] == [9]


def test_full_load_swaps_versions(spark):
    root = folder(spark)
    assert sink.current_path(spark, root, "t") is None
    sink.replace_table(batch(rows(spark, [(1, T0), (2, T0)]), "v1", T1), root, "t", "v1", T1)
    # A version that was written but never published is not seen.
    sink.write_batch(batch(rows(spark, [(7, T0)]), "v2", T1), sink.version_path(root, "t", "v2"), "v2")
    assert sink.current_version(spark, root, "t") == "v1"
    sink.replace_table(batch(rows(spark, [(3, T0)]), "v3", T2), root, "t", "v3", T2)
    assert [r.id for r in sink.read_accepted(spark, sink.current_path(spark, root, "t")).collect()] == [3]


def test_files_hold_at_most_the_asked_rows(spark):
    path = folder(spark)
    df = spark.range(0, 1_000, numPartitions=1).select("id", F.lit(T0).alias("day"))
    sink.write_batch(batch(df, "b1", T1), path, "b1", rows_per_file=300)
    assert sink.batch_files(spark, path, "b1") == 4


@pytest.mark.parametrize("header", [True, False])
def test_text_files_round_trip(spark, header):
    path = folder(spark)
    data = [(1, 'a|b"c"\nd\\e', 1.5, 3.0), (2, "", None, 4.0), (3, None, 2.25, None), (4, "null", float("inf"), 5.0)]
    df = spark.createDataFrame(data, "id bigint, s string, x double, whole double")
    staged.export_csv(df, path, header=header)
    got = staged.read_csv(spark, path, "id bigint, s string, x double, whole bigint", header).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, data[0][1], 1.5, 3), (2, None, None, 4), (3, None, 2.25, None), (4, None, None, 5)]


def test_relocation(spark):
    root = folder(spark)
    src, tgt = f"{root}/a", f"{root}/b"
    spark.range(10).write.parquet(src)
    spark.range(4).write.parquet(tgt)
    assert relocate.relocate(spark, "t", src, tgt).first().verdict == "moved"
    r = relocate.relocate(spark, "t", src, tgt).first()
    assert (r.verdict, r.drop_source, spark.read.parquet(tgt).count()) == ("already_moved", True, 10)
    assert relocate.relocate(spark, "t", f"{root}/x", f"{root}/y").first().verdict == "absent"


def test_control_sheet(spark):
    data = [("s", "FactA", "t", "A", " d ", "id", " y "), ("s", "FactB", "t", "B", "  ", None, "Y"),
            ("s", "DimC", "t", "C", "d", "id", "y"), ("s", "DimD", "t", "D", None, None, None), ("s", "DimE", "t", "E", None, None, "yes")]
    sheet = spark.createDataFrame(data, "Source_Schema string, Source_table_name string, Target_Schema string, "
                                        "Target_Table_Name string, Date_Column_Name string, PK_Column_Name string, `Enabled ` string")
    got = {r.table_name: (r.load_type, r.date_column, r.pk_column) for r in control.read_control(sheet).collect()}
    assert got == {"s.FactA": ("DELTA", "d", "id"), "s.FactB": ("FULL", None, None), "s.DimC": ("FULL", "d", "id")}
    with pytest.raises(ValueError, match="Target_Schema"):
        control.read_control(sheet.drop("Target_Schema"))


def test_watermark_merge_keeps_insert_and_replaces(spark):
    schema = watermark.WATERMARK_SCHEMA

    def mark_row(name, value):
        return (name, "DELTA", None, value, None, 1, "b", None, None)
    cur = spark.createDataFrame([mark_row("a", "1"), mark_row("b", "1")], schema)
    upd = spark.createDataFrame([mark_row("b", None), mark_row("c", "2")], schema)
    assert {r.table_name: r.last_delta_value for r in watermark.merge(cur, upd).collect()} == {"a": "1", "b": None, "c": "2"}


def test_max_id_floor(spark):
    assert watermark.max_id(spark.createDataFrame([(-5,), (None,)], "k int"), "k").first().max_id == 0
    assert watermark.max_id(spark.createDataFrame([(None,)], "k int"), "k").first().max_id is None


def make_run(spark, root, as_of, meta=None, **kw):
    return sync.Run(as_of, f"run {as_of}", f"{root}/target", meta or audit.MetaStore(spark, f"{root}/meta"), **kw)


CFG = sync.TableConfig("src", "FactX", "stg", "X", "DELTA", "day", "id")


def source(spark, data):
    df = spark.createDataFrame(data, "id bigint, day string")
    return df.withColumn("day", F.col("day").cast("timestamp_ntz"))


def test_delta_runs_follow_the_watermark(spark):
    root = folder(spark)
    data = [(1, "2023-12-20 00:00:00"), (2, "2023-12-30 00:00:00"), (3, T1), (4, "2024-01-02 12:00:00"), (5, T2)]
    one = sync.sync_table(spark, lambda c: source(spark, data), CFG, make_run(spark, root, T1))
    assert (one.read, one.loaded, one.rejected, one.error) == (3, 1, 2, None)   # 1 is before the look-back, 3 opens the next window
    two = sync.sync_table(spark, lambda c: source(spark, data), CFG, make_run(spark, root, T2))
    assert (two.loaded, two.rejected) == (2, 0)
    run = make_run(spark, root, "2024-01-04 00:00:00")
    sync.sync_table(spark, lambda c: source(spark, data), CFG, run)
    got = sync.read_target(spark, run, CFG)
    assert sorted(r.id for r in got.collect()) == [2, 3, 4, 5]
    marks = run.meta.watermarks().first()
    assert (marks.last_delta_value, marks.last_max_id) == ("2024-01-04 00:00:00", 5)


def test_a_run_that_died_before_its_watermark_is_replaced(spark, monkeypatch):
    root, data = folder(spark), [(1, "2023-12-30 00:00:00"), (2, "2024-01-02 12:00:00")]
    run = make_run(spark, root, T1)
    real = run.meta.append
    monkeypatch.setattr(run.meta, "append", lambda name, df: (_ for _ in ()).throw(RuntimeError("lost")) if name == "watermark" else real(name, df))
    dead = sync.sync_table(spark, lambda c: source(spark, data), CFG, run)
    assert dead.error == "lost" and dead.loaded == 1
    again = make_run(spark, root, T2)
    sync.sync_table(spark, lambda c: source(spark, data), CFG, again)
    assert sorted(r.id for r in sync.read_target(spark, again, CFG).collect()) == [1, 2]
    assert {r.success for r in again.meta.read("load_stats").collect()} == {True, False}


def test_blocked_watermark_and_adjusted_count(spark):
    root, data = folder(spark), [(1, "2023-12-30 00:00:00"), (None, "2023-12-30 00:00:00")]
    run = make_run(spark, root, T1, block_on_mismatch=True)
    sync.sync_table(spark, lambda c: source(spark, data), CFG, run)
    checks = {r.check_type: r.is_valid for r in run.meta.read("data_quality").collect()}
    assert checks == {"ROW_COUNT": False, "ROW_COUNT_ADJUSTED": True} and run.meta.watermarks().count() == 1


def test_nothing_accepted_is_success_without_watermark(spark):
    root = folder(spark)
    full = sync.TableConfig("src", "DimY", "stg", "Y", "FULL", None, "id")
    run = make_run(spark, root, T1)
    sync.sync_table(spark, lambda c: source(spark, [(1, T0)]), full, run)
    later = make_run(spark, root, T2)
    out = sync.sync_table(spark, lambda c: source(spark, [(None, T0)]), full, later)
    assert out.error is None and out.loaded == 0
    assert [r.id for r in sync.read_target(spark, later, full).collect()] == [1]   # the old version stays


def test_one_bad_table_does_not_stop_the_others(spark):
    root = folder(spark)
    tables = [sync.TableConfig("s", n, "t", n, "FULL", None, "id") for n in ("a", "bad", "c")]

    def open_source(cfg):
        if cfg.source_table == "bad":
            raise OSError("no such table" * 1000)
        return source(spark, [(1, T0)])
    run = make_run(spark, root, T1)
    got = sync.sync_all(spark, tables, open_source, run, parallel=3)
    assert {k: v.error is None for k, v in got.items()} == {"s.a->t.a": True, "s.bad->t.bad": False, "s.c->t.c": True}
    stats = run.meta.read("load_stats")
    assert stats.count() == 3 and len(stats.filter("not success").first().error_message) == 4000
    summary = monitoring.run_summary(stats, run.meta.read("data_quality")).first()
    assert (summary.tables, summary.succeeded, summary.failed) == (3, 2, 1)
    monitoring.register_views(spark, stats, run.meta.read("data_quality"), T2)
    assert spark.sql("select count(*) n from v_latest_runs").first().n == 3


def test_issues_keep_checks_of_unknown_runs(spark):
    q = spark.createDataFrame([("r1", "s.t", "ROW_COUNT", "1", "2", -1, 1.0, False, None), ("r2", "s.t", "ROW_COUNT", "1", "1", 0, 0.0, True, None)], audit.QUALITY_SCHEMA)
    stats = spark.createDataFrame([], audit.LOAD_STATS_SCHEMA)
    assert [(r.run_id, r.pipeline_name) for r in monitoring.quality_issues(q, stats).collect()] == [("r1", None)]


def test_stream_takes_new_files_only(spark, sf):
    root = folder(spark)
    events = spark.read.parquet(f"{sf}/events.parquet")
    inbox = f"{root}/inbox"

    def run():
        stream = ingest.file_stream(spark, inbox, events.schema, max_files=1)
        ingest.start_ingest(stream, f"{root}/t", f"{root}/c", Rules(pk="event_id", date="ts"), lambda: "2024-01-20 00:00:00").awaitTermination()
    events.filter("event_id < 4000").write.mode("append").parquet(inbox)
    run()
    run()
    events.filter("event_id >= 4000").write.mode("append").parquet(inbox)
    run()
    whole = sink.read_accepted(spark, f"{root}/t").count() + sink.read_rejected(spark, f"{root}/t").count()
    assert whole == events.count()
    assert sink.read_accepted(spark, f"{root}/t").select("event_id").distinct().count() == sink.read_accepted(spark, f"{root}/t").count()


def test_stream_drops_repeats(spark, sf):
    root, events = folder(spark), spark.read.parquet(f"{sf}/events.parquet")
    events.limit(100).unionAll(events.limit(100)).write.parquet(f"{root}/inbox")
    stream = late.drop_repeats(ingest.file_stream(spark, f"{root}/inbox", events.schema), "event_id", "ts", "1 day")
    q = stream.writeStream.format("parquet").option("path", f"{root}/o").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/o").count() == 100


@pytest.mark.parametrize("fixed_dates", [True, False])
def test_late_rows(spark, fixed_dates):
    schema = "id bigint, day string"
    src = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-09"), (3, "2024-01-09"), (3, "2024-01-09"), (4, "2024-01-11")], schema)
    src = src.withColumn("day", F.col("day").cast("timestamp_ntz"))
    got = late.late_rows(src, src.filter("id = 2"), "id", "day", "2024-01-10 00:00:00", 3, fixed_dates)
    assert [r.id for r in got.collect()] == [3, 3]


def test_old_versions_expire(spark):
    root = folder(spark)
    for i in range(4):
        sink.replace_table(batch(rows(spark, [(i, T0)]), f"v{i}", T1), root, "t", f"v{i}", f"2024-01-0{i + 1} 00:00:00")
    assert sorted(sink.expire_versions(spark, root, "t", keep=2)) == ["v0", "v1"]
    assert sink.expire_versions(spark, root, "t", keep=2) == []
    assert [r.id for r in sink.read_accepted(spark, sink.current_path(spark, root, "t")).collect()] == [3]


def test_a_target_that_gained_a_column(spark):
    path = folder(spark)
    sink.write_batch(batch(rows(spark, [(1, T0)]), "b1", T1), path, "b1")
    sink.write_batch(batch(rows(spark, [(2, T0)]).withColumn("extra", F.lit("x")), "b2", T1), path, "b2")
    assert {r.id: r.extra for r in sink.read_accepted(spark, path, merge_schema=True).collect()} == {1: None, 2: "x"}


def test_an_empty_source_is_success(spark):
    run = make_run(spark, folder(spark), T1)
    out = sync.sync_table(spark, lambda c: source(spark, []), CFG, run)
    assert (out.error, out.read, out.loaded) == (None, 0, 0) and sync.read_target(spark, run, CFG) is None
    assert run.meta.watermarks().count() == 0 and run.meta.read("load_stats").first().success


def test_a_half_written_target_is_no_table(spark):
    root = folder(spark)
    spark.range(10).write.parquet(f"{root}/a")
    spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration()).mkdirs(
        spark._jvm.org.apache.hadoop.fs.Path(f"{root}/b/_temporary/0"))
    row = relocate.relocate(spark, "t", f"{root}/a", f"{root}/b").first()
    assert (row.target_rows, row.moved_rows, row.verdict) == (None, 10, "moved")


def test_rerun_of_one_window_after_the_source_changed(spark):
    """The window is read again under the same name: rows that left the source leave the target."""
    root = folder(spark)
    first = make_run(spark, root, T1, block_on_mismatch=True, tolerance=-1.0)   # never moves the watermark
    sync.sync_table(spark, lambda c: source(spark, [(1, "2023-12-30 00:00:00"), (2, "2023-12-30 00:00:00")]), CFG, first)
    assert first.meta.watermarks().count() == 0
    second = make_run(spark, root, T2)
    sync.sync_table(spark, lambda c: source(spark, [(2, "2023-12-30 00:00:00")]), CFG, second)
    assert [r.id for r in sync.read_target(spark, second, CFG).collect()] == [2]


def test_two_targets_of_one_source(spark):
    root = folder(spark)
    tables = [sync.TableConfig("s", "a", t, "a", "DELTA", CFG.date_column, CFG.pk_column) for t in ("t", "u")]
    run = make_run(spark, root, T1)
    got = sync.sync_all(spark, tables, lambda c: source(spark, [(1, T0), (2, T0)]), run)
    assert {k: v.loaded for k, v in got.items()} == {"s.a->t.a": 2, "s.a->u.a": 2}


def test_short_full_load_is_not_published_when_blocked(spark, monkeypatch):
    root = folder(spark)
    full = sync.TableConfig("s", "a", "t", "a", "FULL", None, "id")
    run = make_run(spark, root, T1)
    sync.sync_table(spark, lambda c: source(spark, [(1, T0), (2, T0)]), full, run)
    before = sync.read_target(spark, run, full).count()
    sync.sync_table(spark, lambda c: source(spark, [(3, T0)]), full, run)   # the same clock: another version, not the same one
    assert (before, sync.read_target(spark, run, full).count()) == (2, 1)
    blocked = replace(make_run(spark, root, T2), block_on_mismatch=True)
    real = sync.sink.write_batch
    monkeypatch.setattr(sync.sink, "write_batch", lambda rows, *a, **k: real(rows.filter("id = 1"), *a, **k))
    sync.sync_table(spark, lambda c: source(spark, [(1, T0), (2, T0), (4, T0)]), full, blocked)
    assert [r.id for r in sync.read_target(spark, run, full).collect()] == [3]


def test_key_predicates_cover_every_row_once():
    got = scan.key_predicates("id", 0, 99, 4)
    assert got == ["id < 25 OR id IS NULL", "id >= 25 AND id < 50", "id >= 50 AND id < 75", "id >= 75"]
    assert scan.key_predicates("id", 5, 5, 64) == ["1 = 1"] and len(scan.key_predicates("id", 0, 2, 64)) == 3


def test_more_spans_than_are_pushed_stay_a_filter(spark):
    todo = [spark.createDataFrame([(i, 10 * i, 10 * i + 5)], "range_id int, start_id bigint, end_id bigint").first() for i in range(60)]
    df = spark.range(700).withColumnRenamed("id", "k")
    kept = {r.k for r in df.filter(migrate.key_filter("k", todo)).collect()}
    assert {k for k in range(600) if k % 10 < 5} <= kept and max(kept) < 600


def test_late_events_are_written_and_read_by_all_cores(spark, sf):
    """A part of the arriving events is several files, all of them in one micro-batch."""
    def folders():
        return set(glob.glob(f"{work_root(spark)}/stream_late-*"))
    before = folders()
    stream_late(spark, sf)
    root = (folders() - before).pop()
    parts = glob.glob(f"{root}/in/part*")
    assert all(len(glob.glob(f"{p}/*.parquet")) == spark.sparkContext.defaultParallelism > 1 for p in parts) and len(parts) > 2
    # the source's log has an entry per micro-batch that read files
    assert len(glob.glob(f"{root}/checkpoint/sources/0/[0-9]*")) == len(parts)
