"""Row validation: accept, or reject with a reason. Rejected rows are kept."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import coerce_timestamp, is_missing, ntz
from tidemark.operators.clean import clip_texts

REASON = "_reject_reason"
NULL_PK = "null_pk"
FUTURE_DATE = "future_date"


@dataclass(frozen=True)
class Rules:
    """Which rules to apply; a rule whose column is not set, or not in the table, does nothing."""

    pk: str | None = None
    date: str | None = None
    reject_null_pk: bool = True
    reject_future: bool = True
    max_text: int | None = None   # a load cuts text only when told to


def coerce_date(df: DataFrame, date: str | None) -> DataFrame:
    if date is None or date not in df.columns:
        return df
    return df.withColumn(date, coerce_timestamp(F.col(date), df.schema[date].dataType))


def null_pk(df: DataFrame, pk: str) -> Column:
    return is_missing(F.col(pk), df.schema[pk].dataType)


def future(date: str, as_of: str | dt.datetime) -> Column:
    """A NULL date passes, so the test must not be NULL."""
    return F.coalesce(F.col(date) > ntz(as_of), F.lit(False))


def mark(df: DataFrame, rules: Rules, as_of: str | dt.datetime) -> DataFrame:
    """Coerce, clip, and add the reject reason (NULL if accepted). The first rule that fires wins."""
    df = coerce_date(df, rules.date)
    reason = F.lit(None).cast("string")
    if rules.reject_future and rules.date in df.columns:
        reason = F.when(future(rules.date, as_of), FUTURE_DATE).otherwise(reason)
    if rules.reject_null_pk and rules.pk in df.columns:
        reason = F.when(null_pk(df, rules.pk), NULL_PK).otherwise(reason)
    df = df.withColumn(REASON, reason)
    return clip_texts(df, rules.max_text) if rules.max_text else df


def accepted(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REASON).isNotNull())


def reason_counts(marked: DataFrame) -> DataFrame:
    """One row: rows read, accepted, rejected, and rejected per reason."""
    reason = F.col(REASON)
    return marked.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(reason.isNull()).alias("rows_accepted"),
        F.count_if(reason.isNotNull()).alias("rows_rejected"),
        F.count_if(reason == NULL_PK).alias("rejected_null_pk"),
        F.count_if(reason == FUTURE_DATE).alias("rejected_future_date"),
    )


def latest_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in `order`, made total by all other columns.

    Spark turns the `= 1` filter into a group limit before the shuffle, so a task sends one row per
    key it saw; a key that holds much of the table does not gather in one task.
    """
    rest = [F.col(f"`{c}`").desc_nulls_last() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
