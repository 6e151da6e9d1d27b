"""The guarded cast gives the answer of try_cast, whatever the value."""

import decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tidemark.functions.casts import cast_or_null

TARGETS = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(5,2)", "decimal(5,5)", "decimal(19,6)",
           "decimal(38,0)", "date", "timestamp_ntz", "timestamp", "string", "boolean"]
DATES = ["2024-01-20", " 2024-1-2 ", "2024", "2024-12", "2024-13-01", "2024-02-30", "2024-01-20T12:30:01.5", "2024-01-20 25:00:00",
         "2024-01-20 x", "0000-00-00", "+12024-01-01", "99999999-01-01", "\t2024-01-20\n", "12:30:00", "T12:30", "N/A", "",
         "2024-01-20 12:30:00 UTC", "2024-01-20 12:30:00+01:00", "2024-01-20Z", "\x012024-01-20"]
NUMBERS = ["1", " 1 ", "+1", "-1.5", "1e3", "1E3", ".5", "5.", "inf", "-Infinity", "NaN", "1d", "1f", "0x1F", "1L", "abc", "12abc",
           "\t7\n", "99999999999999999999", "1_000", "१", "\x7f1"]
EDGES = [s * v for s in (1, -1) for e in (7, 15, 31, 63) for v in (2**e - 1, 2**e)] + [0, 999, 1000, 99999, 10**13]


def same(spark, rows, source, target):
    df = spark.createDataFrame([(r,) for r in rows], T.StructType([T.StructField("x", source)]))
    got = df.select(cast_or_null(F.col("x"), source, target).cast("string").alias("a"), F.col("x").try_cast(target).cast("string").alias("b"), "x")
    assert got.filter("not (a <=> b)").collect() == []


@pytest.mark.parametrize("target", [t for t in TARGETS if t != "string"])
def test_texts(spark, target):
    same(spark, [*DATES, *NUMBERS, None], T.StringType(), target)


@pytest.mark.parametrize("target", [t for t in TARGETS if t not in ("date", "timestamp_ntz")])
def test_numbers(spark, target):
    fits = [e for e in EDGES if -(2**63) <= e < 2**63]
    same(spark, [*fits, None], T.LongType(), target)
    fractions = [float(e) + d for e in EDGES for d in (0, 0.5, -0.5, 0.005, 0.995)] + [float("nan"), float("inf"), -float("inf"), 1e300, 999.995, 999.994999]
    same(spark, [*fractions, None], T.DoubleType(), target)
    if target != "boolean":
        same(spark, [decimal.Decimal(e) + d for e in EDGES for d in (0, decimal.Decimal("0.005"), decimal.Decimal("-0.005"))], T.DecimalType(30, 3), target)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789-+:. TZeEinfNa\t\n", max_size=12), min_size=1, max_size=60))
def test_random_texts(spark, texts):
    for target in ("int", "double", "decimal(5,2)", "date", "timestamp_ntz"):
        same(spark, texts, T.StringType(), target)
