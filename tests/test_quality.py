"""Checks and row comparison on hand-made rows."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import quality, reconcile
from tidemark.queries.quality import BIG, dq_aggregates


def paired(spark, src, tgt):
    schema = "table_name string, src_row_count bigint, tgt_row_count bigint"
    return spark.createDataFrame([("t", src, tgt)], schema)


@pytest.mark.parametrize("src,tgt,pct,valid", [(100, 100, 0, True), (100, 99, 1, True), (1000, 989, 1.1, False),
                                               (100, 103, 3, False), (0, 0, 0, True), (0, 5, 100, False)])
def test_row_count(spark, src, tgt, pct, valid):
    r = quality.row_count_check(paired(spark, src, tgt)).first()
    assert (r.difference, r.is_valid) == (src - tgt, valid) and r.difference_percent == pytest.approx(pct)


def test_row_count_at_least(spark):
    assert quality.row_count_at_least(paired(spark, 10, 11)).first().is_valid
    assert not quality.row_count_at_least(paired(spark, 10, 9)).first().is_valid


def test_duplicates_count_null_keys_as_one_group(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (None,)], "k int")
    r = quality.duplicate_check(df, "t", ["k"]).first()
    assert (r.duplicate_keys, r.rows_involved, r.is_valid) == (2, 5, False)
    assert [tuple(x) for x in quality.top_duplicates(df, ["k"], 1).collect()] == [(None, 3)]


def test_all_checks_on_a_clean_copy(spark):
    df = spark.createDataFrame([(1, 2.5), (2, -2.5)], "id bigint, v double")
    checks = quality.all_checks(df, df, "t", "id", ["id", "gone"], ["v", "lost"]).collect()
    assert len(checks) == 8
    # what was asked for and is not there cannot pass
    assert {(c.check_type, c.target_value) for c in checks if not c.is_valid} == {("NULL_CHECK", "absent"), ("SUM_CHECK", "absent")}


def test_sums_hold_big_values_and_say_what_does_not_fit(spark):
    a = spark.createDataFrame([(5.0, "1"), (2e13, "2")], "v double, t string")
    b = spark.createDataFrame([(5.0, "1"), (9e13, "x")], "v double, t string")
    pair = quality.pair_sides(*[quality.side_metrics(d, "t", s, numeric=["v", "t"]) for d, s in ((a, "source"), (b, "target"))])
    got = {r.column_name: r for r in quality.aggregate_check(pair, ["v", "t"]).collect()}
    assert not got["v"].is_valid and got["v"].source_sum != got["v"].target_sum
    assert not got["t"].is_valid and (got["t"].source_unfit, got["t"].target_unfit) == (0, 1)
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (float("inf"),)], "v double")
    assert quality.side_metrics(nan, "t", "source", numeric=["v"]).first().unfit_v == 2


def test_comparison_sees_columns_and_types_of_both_sides(spark):
    src = spark.createDataFrame([(1, 5), (2, 6)], "id int, v int")
    wide = spark.createDataFrame([(1, "5", "new"), (2, "oops", None)], "id bigint, v string, extra string")
    assert {r.id: r.status for r in reconcile.compare_rows(src, wide, ["id"]).collect()} == {1: "changed", 2: "changed"}
    assert {r.id: r.status for r in reconcile.compare_rows(src, wide, ["id"], ["v"]).collect()} == {1: "same", 2: "changed"}
    assert {r.column_name for r in reconcile.schema_differences(src, wide).collect()} == {"id", "v", "extra"}


def test_all_checks_scan_each_side_once_for_plain_metrics(spark, sf):
    src, tgt = spark.read.parquet(f"{sf}/orders.parquet"), spark.read.parquet(f"{sf}/customer.parquet")
    checks = quality.all_checks(src, tgt.withColumnRenamed("c_custkey", "o_orderkey"), "t", "o_orderkey", ["o_orderkey"], ["o_totalprice"])
    plan = checks._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("FileScan") == 3   # source, target, and the target's keys for the duplicate check


def test_sum_check_survives_zero_and_negative_sums(spark):
    src = spark.createDataFrame([(-5.0, 0.0), (-5.0, 0.0)], "a double, b double")
    tgt = spark.createDataFrame([(-5.0, 1.0)], "a double, b double")
    got = {r.column_name: (r.difference_percent, r.is_valid) for r in quality.aggregate_check(quality.pair_sides(
        quality.side_metrics(src, "t", "source", numeric=["a", "b"]),
        quality.side_metrics(tgt, "t", "target", numeric=["a", "b"])), ["a", "b"]).collect()}
    assert got == {"a": (50.0, False), "b": (100.0, False)}


def test_id_range_of_empty_tables_agrees(spark):
    e = spark.createDataFrame([], "id bigint")
    r = quality.id_range_check(quality.pair_sides(
        quality.side_metrics(e, "t", "source", "id"), quality.side_metrics(e, "t", "target", "id"))).first()
    assert r.is_valid


def test_scorecard(spark):
    rows = [("a", "NULL_CHECK", True), ("a", "NULL_CHECK", False), ("a", "ID_RANGE", True), ("b", "ID_RANGE", True), ("b", "SUM_CHECK", False)]
    df = spark.createDataFrame(rows, "table_name string, check_type string, is_valid boolean")
    assert {tuple(r) for r in quality.scorecard(df).collect()} == {("a", 1, 2, "FAIL"), ("b", 1, 1, "PASS")}


def test_table_equals_itself(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    shuffled = lines.repartition(5, "l_partkey")
    assert reconcile.differences(lines, shuffled, ["l_orderkey", "l_linenumber"]).count() == 0


def test_swapped_nulls_are_a_change(spark):
    s = spark.createDataFrame([(1, None, 5)], "k int, a int, b int")
    t = spark.createDataFrame([(1, 5, None)], "k int, a int, b int")
    assert reconcile.differences(s, t, ["k"]).first().status == "changed"


def test_widened_target_is_not_a_change(spark):
    s = spark.createDataFrame([(1, 5)], "k int, a int")
    t = spark.createDataFrame([(1, 5)], "k bigint, a bigint")
    assert reconcile.differences(s, t, ["k"]).count() == 0


rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 2)), max_size=14)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows, rows)
def test_against_brute_force(spark, left, right):
    """Keys repeat, are NULL and exist on one side only."""
    schema = "k int, v int"
    got = {tuple(r) for r in reconcile.compare_rows(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"]).collect()}
    want = set()
    for k in {k for k, _ in left + right}:
        a, b = sorted(v for x, v in left if x == k), sorted(v for x, v in right if x == k)
        status = "missing" if not b else "extra" if not a else "same" if a == b else "changed"
        want.add((k, len(a), len(b), status))
    assert got == want


def test_hot_key_is_combined_before_the_shuffle(spark):
    hot = spark.range(0, 60_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    got = reconcile.compare_rows(hot, hot.filter("id <> 30000"), ["k"]).filter("status <> 'same'").collect()
    assert [tuple(r) for r in got] == [(0, 20_000, 19_999, "changed")]


def test_big_products_of_large_keys_are_summed(spark, sf, tmp_path):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").limit(50).withColumn("l_orderkey", F.col("l_orderkey") + 10**6)
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    row = next(r for r in dq_aggregates(spark, str(tmp_path)).collect() if r.column_name == "l_big")
    keys = [r.l_orderkey for r in spark.read.parquet(str(tmp_path / "lineitem.parquet")).select("l_orderkey").collect()]
    assert row.source_sum == f"{sum(keys) * BIG}.000000" and row.source_unfit == 0
