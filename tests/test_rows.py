"""Cleaning, stamping, validation and conforming on hand-made rows."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions.columns import ntz, round_places, seconds_between
from tidemark.operators import clean, conform, stamp, validate

INF, NAN = float("inf"), float("nan")


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_nonfinite_and_rounding(spark):
    df = spark.createDataFrame([(INF,), (-INF,), (NAN,), (None,), (0.12345678905,), (2.0,)], "x double")
    got = values(clean.clean_table(df), "x")
    assert got[:4] == [None] * 4 and got[4] == pytest.approx(0.1234567890, abs=1e-10) and got[5] == 2.0


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.00000000005,), (0.00000000015,)], "x double")
    assert values(clean.round_floats(df), "x") == [0.0, 0.0000000002]


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.floats(), st.integers(-10**17, 10**17).map(lambda k: k / 1e6), st.integers(-10**17, 10**17).map(lambda k: k / 1e11),
                          st.floats(-1e10, 1e10)), min_size=1, max_size=80))
def test_short_cut_in_rounding_changes_nothing(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    bad = df.filter(~round_places(F.col("x")).eqNullSafe(F.bround("x", 10)))
    assert bad.collect() == []


def test_integral_is_a_property_of_the_column(spark):
    df = spark.createDataFrame([(1.0, 1.0, None, 1e300), (NAN, 2.5, None, 2.0), (3.0, 4.0, None, 3.0)],
                               "a double, b double, empty double, huge double")
    report = {r.column_name: (r.non_null, r.integral) for r in clean.integral_report(df).collect()}
    assert report == {"a": (2, True), "b": (3, False), "empty": (0, False), "huge": (3, False)}
    narrowed = clean.narrow_integral(df)
    assert dict(narrowed.dtypes) == {"a": "bigint", "b": "double", "empty": "double", "huge": "double"}
    assert values(narrowed, "a") == [1, None, 3]


def test_integral_beyond_double_precision_is_not_touched(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big,), (None,)], "k bigint")
    assert values(clean.clean_table(df, None), "k") == [big, None]


def test_null_tokens_are_exact(spark):
    df = spark.createDataFrame([("nan",), ("None",), ("NULL",), ("null",), ("NaN",), (" null",), ("",), (None,)], "s string")
    assert values(clean.null_tokens(df), "s") == [None] * 4 + ["NaN", " null", "", None]


def test_clip_keeps_null_and_skips_stamp_columns(spark):
    df = spark.createDataFrame([("é" * 10, "x" * 10), (None, None)], "s string, _batch_id string")
    got = clean.clip_texts(df, 4).collect()
    assert got[0] == ("éééé", "x" * 10) and got[1] == (None, None)


def test_fixed_text(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "x double")
    assert values(clean.floats_as_text(df), "x") == ["1.5000000000", None]


def test_first_rule_wins_and_counts_add_up(spark):
    df = spark.createDataFrame(
        [(None, "2030-01-01 00:00:00"), (1, "2030-01-01 00:00:00"), (2, "not a date"), (3, None), (4, "1999-01-01 00:00:00"),
         (5, "9999-12-31 00:00:00")], "id bigint, day string")
    rules = validate.Rules(pk="id", date="day")
    marked = validate.mark(df, rules, "1999-01-01 00:00:00")
    assert values(marked, validate.REASON) == ["null_pk", "future_date", None, None, None, "future_date"]
    c = validate.reason_counts(marked).first()
    assert c.rows_read == c.rows_accepted + c.rows_rejected == 6
    assert validate.accepted(marked).count() == 3 and validate.rejected(marked).count() == 3
    assert values(marked, "day")[2] is None


def test_rules_without_their_column_do_nothing(spark):
    df = spark.createDataFrame([(None,)], "id bigint")
    assert values(validate.mark(df, validate.Rules(pk="other", date="gone"), "1999-01-01"), validate.REASON) == [None]


def test_nan_key_is_missing(spark):
    df = spark.createDataFrame([(NAN,), (1.0,)], "id double")
    assert values(validate.mark(df, validate.Rules(pk="id"), "1999-01-01"), validate.REASON) == ["null_pk", None]


def test_latest_by_key(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d")], "k int, t int, v string")
    got = {tuple(r) for r in validate.latest_by_key(df, ["k"], [F.desc("t")]).collect()}
    assert got == {(1, 7, "c"), (2, None, "d")}


def test_latest_by_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = validate.latest_by_key(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("bad", ["", "1abc", "2024-01-01", "a/b", "a b", "x" * 51, "é1"])
def test_batch_ids_that_would_not_read_back(bad):
    with pytest.raises(ValueError):
        stamp.check_batch_id(bad)


def test_stamp_and_evolution(spark):
    df = spark.createDataFrame([(1,)], "k int")
    new = stamp.stamp(df, "b1", "2024-01-20 12:34:56.789", 7)
    row = new.first()
    assert (str(row._loaded_at), row._batch_id, row._source_system_id) == ("2024-01-20 12:34:56", "b1", 7)
    assert [f.dataType for f in new.schema][1:] == [f.dataType for f in stamp.STAMP_SCHEMA]
    both = stamp.append_evolved(stamp.ensure_stamp(df), new)
    assert sorted(values(both, "_batch_id"), key=str) == [None, "b1"]


def test_conform(spark):
    df = spark.createDataFrame([("12", 70000, "abcdef", 1), ("x", 5, None, 2)], "a string, b int, c string, e int")
    schema = "a int, b smallint, c varchar(3), d date"
    assert [tuple(r) for r in conform.conform(df, schema).collect()] == [(12, None, "abc", None), (None, 5, None, None)]
    report = {r.column_name: (r.status, r.non_null, r.lost) for r in conform.conform_report(df, schema).collect()}
    assert report == {"a": ("ok", 2, 1), "b": ("ok", 2, 1), "c": ("ok", 1, 1), "d": ("missing", None, None), "e": ("extra", None, None)}


def test_nan_stays_out_of_comparisons(spark):
    assert math.isnan(spark.sql("select double('nan') x").first().x)
    df = spark.createDataFrame([(NAN,)], "x double")
    assert values(clean.null_nonfinite(df), "x") == [None]


def test_seconds_do_not_know_clock_changes(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(
            seconds_between(ntz("2024-03-09 23:00:00"), ntz("2024-03-10 12:00:00.9")).alias("a"),
            seconds_between(ntz("2024-01-01 00:00:00"), ntz("2024-02-01 01:02:03")).alias("b"))
        assert tuple(row.first()) == (13 * 3600, 31 * 86400 + 3723)
        one = stamp.stamp(spark.range(1), "b1", "2024-03-10 02:30:00.5", 1).first()
        assert str(one._loaded_at) == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
