"""What lets tables and logs grow: key trees, counter words, upserts, wider types, checkpoints of logs, footers, text ranges."""

import datetime as dt
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators import profile, quality, ranges, reconcile, sink, upsert, widen
from tidemark.operators.stamp import stamp
from tidemark.operators.validate import Rules, mark
from tidemark.plans import audit, sync
from tidemark.session import work_root

T0, T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def folder(spark):
    return f"{work_root(spark)}/test-{uuid.uuid4().hex}"


def shuffled_rows(df):
    """Rows written by all exchanges of an executed plan."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            found += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


# --- key tree

def sides(spark):
    """A hot key with a third of all rows, NULL keys, far keys, copies, changes."""
    rng = random.Random(1)
    rows = [(rng.choice([7, rng.randint(-10**6, 10**6), 2**61 + rng.randint(0, 99)]), rng.randint(0, 3)) for _ in range(3000)] + [(None, 1), (None, 2)]
    other = [r for r in rows if r[0] is None or r[0] % 97] + [(None, 1), (10**9, 5), (7, 99)]
    schema = "k bigint, v int"
    return spark.createDataFrame(rows, schema).repartition(4), spark.createDataFrame(other, schema).repartition(3)


@pytest.mark.parametrize("fanout, leaf_rows", [(16, 1), (16, 50), (4096, 10), (4096, 10**9)])
def test_tree_gives_the_same_differences(spark, fanout, leaf_rows):
    a, b = sides(spark)
    want = Counter(map(tuple, reconcile.differences(a, b, ["k"]).collect()))
    assert want and Counter(map(tuple, reconcile.tree_differences(a, b, ["k"], None, fanout, leaf_rows).collect())) == want
    assert Counter(map(tuple, reconcile.tree_differences(a, b.withColumn("k", F.col("k").cast("string")), ["k"], None, fanout, leaf_rows).collect())) == want


def test_tree_of_equal_empty_and_wholly_different_sides(spark):
    a, b = sides(spark)
    assert reconcile.tree_differences(a, a, ["k"]).count() == 0
    none = a.limit(0)
    assert reconcile.tree_differences(none, none, ["k"]).count() == 0
    assert reconcile.tree_differences(a, none, ["k"], leaf_rows=5).count() == a.select("k").distinct().count()
    other = a.withColumn("v", F.col("v") + 1)
    assert reconcile.tree_differences(a, other, ["k"], leaf_rows=5).count() == a.select("k").distinct().count()


def test_keys_that_swap_their_rows_differ(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k bigint, v string")
    b = spark.createDataFrame([(1, "y"), (2, "x")], "k bigint, v string")
    assert reconcile.tree_differences(a, b, ["k"], fanout=16).count() == 2


def test_shuffled_rows_follow_the_differences(spark):
    a = spark.range(0, 400_000, numPartitions=4).select(F.col("id").alias("k"), (F.col("id") % 1000).alias("v"))
    b = a.withColumn("v", F.when(F.col("k").isin([5, 200_001]), -1).otherwise(F.col("v")))
    nodes, width, held = reconcile.differing_nodes(a, b, ["k"], leaf_rows=10)
    assert len(nodes) == 2 and held <= 4 * width and width <= 128
    tree, plain = reconcile.tree_differences(a, b, ["k"], leaf_rows=10), reconcile.differences(a, b, ["k"])
    assert {r.k for r in tree.collect()} == {5, 200_001}
    assert shuffled_rows(tree) <= 2 * held and shuffled_rows(plain) >= 400_000


def test_differences_everywhere_need_no_finer_nodes(spark):
    """Hashed keys with differences in nearly every node: finer nodes would hold a row each, and tens of thousands of them be looked into."""
    a = spark.range(0, 200_000, numPartitions=4).select(F.col("id").alias("k"), F.lit(1).alias("j"), (F.col("id") % 1000).alias("v"))
    b = a.filter("v <> 7")
    assert reconcile.differing_nodes(a, b, ["k", "j"], fanout=64, leaf_rows=10) == ([], 0, -1)
    nodes, width, held = reconcile.differing_nodes(a, b, ["k", "j"], fanout=1024, leaf_rows=10)
    assert len(nodes) < 1024 and 2 * held < 400_000 and width > 1 << 50   # one level: the next one had more nodes than rows
    want = {(k, 1, 1, 0, "missing") for k in range(7, 200_000, 1000)}
    for fanout in (64, 1024):
        assert set(map(tuple, reconcile.tree_differences(a, b, ["k", "j"], None, fanout, 10).collect())) == want


def test_many_nodes_are_a_table_and_keep_rows_without_a_key(spark):
    df = spark.createDataFrame([(i,) for i in range(-500, 500)] + [(None,)], "k bigint")
    nodes = list(range(-400, 400, 8))
    got = lambda nodes: sorted((r.k for r in reconcile._inside(df, F.col("k"), nodes, 4).collect()), key=str)
    want = [k for k in range(-400, 400) if k % 8 < 4]
    assert got(nodes) == sorted(want, key=str) and got([*nodes, None]) == sorted([*want, None], key=str)


# --- duplicates in two passes

@pytest.mark.parametrize("keys", [["a"], ["a", "b"], ["t"], ["a", "t"], ["wide"]])
def test_two_passes_find_the_same_duplicates(spark, keys):
    rng = random.Random(2)
    rows = [(rng.randint(-500, 500) if rng.random() < 0.95 else None, rng.choice([0, 1, None]), f"t{rng.randint(0, 700)}",
             rng.choice([-2**63, 2**63 - 1, rng.randint(-2**62, 2**62)])) for _ in range(2000)] + [(5, 1, "hot", 1)] * 1000
    df = spark.createDataFrame(rows, "a int, b smallint, t string, wide bigint").repartition(4)
    want = Counter(map(tuple, quality.duplicate_keys(df, keys).collect()))
    assert want and Counter(map(tuple, quality.duplicate_keys_two_pass(df, keys).collect())) == want
    assert quality.duplicate_check(df.limit(0), "t", keys, two_pass=True).first().is_valid


def test_unique_keys_are_hardly_shuffled(spark):
    df = spark.range(10**12, 10**12 + 400_000, numPartitions=4).select((F.col("id") * 1 + 5).alias("k"))
    words, _ = quality.counter_words(df, ["k"])
    assert shuffled_rows(words) <= 400_000 // 60
    assert shuffled_rows(quality.duplicate_check(df, "t", ["k"])) >= 400_000
    assert shuffled_rows(quality.duplicate_check(df, "t", ["k"], two_pass=True)) <= 10


# --- upserts

def files(spark, root):
    return {f for f in upsert.read(spark, root).inputFiles()}


def test_upsert_replaces_adds_and_leaves_other_buckets(spark):
    root, schema = folder(spark), "k bigint, v string, n int"
    assert upsert.read(spark, root) is None
    first = spark.createDataFrame([(i, "old", 1) for i in range(500)] + [(None, "old", 1)], schema)
    assert len(upsert.upsert(first, root, ["k"], "a", T0, "n", buckets=32)) == 32
    before = files(spark, root)
    updates = spark.createDataFrame([(3, "new", 2), (3, "newest", 3), (900, "more", 1), (None, "none", 2)], schema)
    touched = upsert.upsert(updates, root, ["k"], "b", T1, "n", buckets=7)
    assert 1 <= len(touched) <= 3
    got = {r.k: r.v for r in upsert.read(spark, root).collect()}
    assert len(got) == upsert.read(spark, root).count() == 502
    assert (got[3], got[900], got[None], got[4]) == ("newest", "more", "none", "old")
    after = files(spark, root)
    assert len(before - after) == len(touched) and all("_version=b" in f for f in after - before)
    assert upsert.upsert(updates, root, ["k"], "b", T2, "n") == [] and files(spark, root) == after
    assert upsert.upsert(updates.limit(0), root, ["k"], "c", T2, "n") == []
    assert len(upsert.expire(spark, root)) == len(touched) and upsert.read(spark, root).count() == 502


def test_an_upsert_that_dies_before_its_entry_changes_nothing(spark, monkeypatch):
    root, rows = folder(spark), spark.createDataFrame([(i, i) for i in range(50)], "k int, v int")
    upsert.upsert(rows, root, ["k"], "a", T0, buckets=4)
    with monkeypatch.context() as m:
        m.setattr(sink, "append_log", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            upsert.upsert(rows.withColumn("v", F.lit(-1)), root, ["k"], "b", T1)
    assert upsert.read(spark, root).filter("v = -1").count() == 0
    upsert.upsert(rows.withColumn("v", F.lit(-1)).withColumn("w", F.lit("x")), root, ["k"], "b", T1)
    assert upsert.read(spark, root).filter("v = -1 and w = 'x'").count() == 50


# --- wider types

@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("bigint", "decimal(10,2)", "decimal(21,2)"), ("decimal(12,0)", "decimal(14,4)", "decimal(16,4)"),
    ("float", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"), ("int", "double", "double"), ("bigint", "double", None), ("string", "int", None),
    ("decimal(38,0)", "decimal(38,10)", None), ("string", "string", "string"), ("date", "int", None)])
def test_wider(a, b, want):
    for x, y in ((a, b), (b, a)):
        found = widen.wider(T.DataType.fromDDL(x), T.DataType.fromDDL(y))
        assert (found and found.simpleString()) == want


def batch(df, name, at):
    return mark(stamp(df, name, at, 1), Rules(pk="id"), at)


def test_batches_of_different_types_are_read_as_one(spark):
    path = folder(spark)
    data = [("b1", T0, "id bigint, x int, d date, m decimal(8,2)", [(1, 5, dt.date(2024, 1, 1), None)]),
            ("b2", T1, "id bigint, x bigint, d timestamp_ntz, extra string", [(2, 2**40, dt.datetime(2024, 1, 2, 3), "e")]),
            ("b3", T2, "id bigint, x smallint, m decimal(12,4)", [(3, 7, None)])]
    for name, at, schema, rows in data:
        widen.write_widening(batch(spark.createDataFrame(rows, schema), name, at), path, name, at)
    got = widen.read_widened(spark, path)
    assert dict(got.dtypes)["x"] == "bigint" and dict(got.dtypes)["d"] == "timestamp_ntz" and dict(got.dtypes)["m"] == "decimal(12,4)"
    assert {(r.id, r.x, r.d, r.extra) for r in got.collect()} == {
        (1, 5, dt.datetime(2024, 1, 1), None), (2, 2**40, dt.datetime(2024, 1, 2, 3), "e"), (3, 7, None, None)}
    with pytest.raises(ValueError, match="column x"):
        widen.write_widening(batch(spark.createDataFrame([(4, "text")], "id bigint, x string"), "b4", T2), path, "b4", T2)
    assert widen.read_widened(spark, path).count() == 3


def test_a_delta_target_takes_wider_types(spark):
    root = folder(spark)
    cfg = sync.TableConfig("src", "FactX", "stg", "X", "DELTA", "day", "id")
    meta = audit.MetaStore(spark, f"{root}/meta")
    for as_of, dtype, day in ((T1, "int", "2024-01-01 12:00:00"), (T2, "bigint", "2024-01-02 12:00:00")):
        rows = spark.createDataFrame([(1, day, 9)], f"id bigint, day string, x {dtype}").withColumn("day", F.col("day").cast("timestamp_ntz"))
        run = sync.Run(as_of, f"run {as_of}", f"{root}/target", meta)
        assert sync.sync_all(spark, [cfg], lambda c: rows, run)[cfg.key].error is None
    assert [r.x for r in sync.read_target(spark, run, cfg).collect()] == [9, 9]


# --- logs

SCHEMA = "n int"


def one(spark, n):
    return spark.createDataFrame([(n,)], SCHEMA)


def numbers(spark, path):
    return sorted(r.n for r in sink.read_log(spark, path, SCHEMA).collect())


def test_checkpoints_of_a_log(spark):
    path = folder(spark)
    assert sink.compact_log(spark, path, SCHEMA) == 0
    for n in range(6):
        sink.append_log(one(spark, n), path)
    assert sink.compact_log(spark, path, SCHEMA, at_least=7) == 0
    old = sink.read_log(spark, path, SCHEMA)
    assert sink.compact_log(spark, path, SCHEMA) == 6
    assert len(sink.read_log(spark, path, SCHEMA).inputFiles()) == 1
    assert sorted(r.n for r in old.collect()) == list(range(6))   # a reader from before still finds its files
    for n in range(6, 9):
        sink.append_log(one(spark, n), path)
    assert numbers(spark, path) == list(range(9))
    assert sink.compact_log(spark, path, SCHEMA) == 3 and numbers(spark, path) == list(range(9))
    assert len(sink._entries(spark, path)) == 3   # what the first checkpoint held is gone
    sink.append_log(one(spark, 9), path)
    assert sink.compact_log(spark, path, SCHEMA) == 1 and numbers(spark, path) == list(range(10))


def test_a_crash_between_the_steps_loses_nothing(spark, monkeypatch):
    path = folder(spark)
    for n in range(4):
        sink.append_log(one(spark, n), path)
    real = sink._hadoop
    with monkeypatch.context() as m:
        m.setattr(sink, "_hadoop", lambda s, p: (_ for _ in ()).throw(OSError("gone")) if p.endswith(".done") else real(s, p))
        with pytest.raises(OSError):
            sink.compact_log(spark, path, SCHEMA)
    assert numbers(spark, path) == [0, 1, 2, 3]
    with monkeypatch.context() as m:   # after the rename, before what is held is deleted
        sink.compact_log(spark, path, SCHEMA)
        sink.append_log(one(spark, 4), path)
        m.setattr(sink, "delete", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            sink.compact_log(spark, path, SCHEMA)
    assert numbers(spark, path) == [0, 1, 2, 3, 4]
    sink.append_log(one(spark, 5), path)
    sink.compact_log(spark, path, SCHEMA)
    assert numbers(spark, path) == [0, 1, 2, 3, 4, 5]


def test_versions_never_published_are_expired(spark):
    root = folder(spark)
    rows = spark.createDataFrame([(1, T0)], "id bigint, day string")
    for name, at in (("v1", T0), ("v2", T1)):
        sink.replace_table(batch(rows, name, at), root, "t", name, at)
    sink.write_batch(batch(rows, "lost", T1), sink.version_path(root, "t", "lost"), "lost")
    assert sink.expire_versions(spark, root, "t", 2, "2001-01-01 00:00:00") == []
    assert sink.expire_versions(spark, root, "t", 1, "2100-01-01 00:00:00") == ["v1", "lost"]
    assert sink.read_accepted(spark, sink.current_path(spark, root, "t")).count() == 1


# --- footers

def test_footers_answer_without_pages(spark, sf):
    df = profile.from_footers(spark, f"{sf}/orders.parquet", F.min("o_orderkey"), F.max("o_orderkey"), F.count(F.lit(1)))
    assert "PushedAggregation: [MIN(o_orderkey), MAX(o_orderkey), COUNT(*)]" in df._jdf.queryExecution().executedPlan().toString()
    text = profile.footer_row(spark, f"{sf}/orders.parquet", F.min("o_orderstatus").alias("s"))
    assert text.s == spark.read.parquet(f"{sf}/orders.parquet").agg(F.min("o_orderstatus")).first()[0]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


# --- ranges over text

def where(plan, k):
    keyed = [r for r in plan if r.range_id >= 0]
    return -1 if k is None else next(r.range_id for r in keyed if (r.start_id is None or k >= r.start_id) and (r.end_id is None or k < r.end_id))


@pytest.mark.parametrize("keys, target", [
    ([f"Customer#{i:09d}" for i in range(400)], 40), (["same"] * 100 + ["samf", "sam", "", "z"], 10), (["é" * i for i in range(30)] + ["e", "漢字", "\U0001F600"], 5),
    ([None] * 5 + ["a"], 3), ([None], 3), ([], 3), (["a" * 300 + str(i) for i in range(50)] + ["b"], 8)])
def test_text_ranges_hold_every_key_once(spark, keys, target):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    plan = sorted(ranges.plan_text_ranges(df, "k", target).collect(), key=lambda r: r.range_id)
    assert sum(r.row_count for r in plan) == len(keys) and plan[0].range_id == -1
    got = ranges.assign_ordered(df, "k", spark.createDataFrame(plan, "range_id int, start_id string, end_id string, row_count bigint, slices int")).collect()
    assert len(got) == len(keys) and all(r.range_id == where(plan, r.k) for r in got)
    counts = Counter(r.range_id for r in got)
    for r in plan:
        assert counts[r.range_id] == r.row_count
        if r.range_id >= 0:
            hot = max(Counter(g.k for g in got if g.range_id == r.range_id).values())
            assert r.row_count <= target + max(1, target // 4, hot)
