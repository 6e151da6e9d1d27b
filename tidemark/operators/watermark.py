"""Watermarks: how far each table has been loaded."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import ntz

# Fixed value
WATERMARK_SCHEMA = (
    "table_name string, last_load_type string, last_delta_column string, last_delta_value string, "
    "last_max_id bigint, last_row_count bigint, last_batch_id string, "
    "last_success_at timestamp_ntz, updated_at timestamp_ntz"
)
LOOKBACK_DAYS = 7


def latest(log: DataFrame) -> DataFrame:
    """The newest entry per table of an append-only log; the batch id breaks ties."""
    w = Window.partitionBy("table_name").orderBy(F.desc("updated_at"), F.desc("last_batch_id"))
    return log.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def merge(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert by table name; both sides hold one row per table."""
    cols = current.columns
    c, u = current.alias("c"), updates.alias("u")
    hit = F.col("u.table_name").isNotNull()
    return c.join(u, F.col("c.table_name") == F.col("u.table_name"), "full_outer").select(*[
        F.when(hit, F.col(f"u.{name}")).otherwise(F.col(f"c.{name}")).alias(name) for name in cols])


def first_start(as_of: str | dt.datetime, lookback_days: int = LOOKBACK_DAYS) -> Column:
    """Without a watermark: midnight, `lookback_days` before `as_of`."""
    return F.date_sub(ntz(as_of).cast("date"), lookback_days).cast("timestamp_ntz")


def start_value(watermark: Column, as_of: str | dt.datetime, lookback_days: int = LOOKBACK_DAYS) -> Column:
    return F.coalesce(watermark.try_cast("timestamp_ntz"), first_start(as_of, lookback_days))


def start_plan(control: DataFrame, marks: DataFrame, as_of: str | dt.datetime,
               lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """(table_name, load_type, delta_start, delta_end, first_run) per control row.

    `control` has table_name and load_type. FULL loads have no window.
    """
    delta = F.col("load_type") == "DELTA"
    mark = F.col("last_delta_value")
    joined = control.join(marks.select("table_name", "last_delta_value"), "table_name", "left")
    return joined.select(
        "table_name", "load_type",
        F.when(delta, start_value(mark, as_of, lookback_days)).alias("delta_start"),
        F.when(delta, ntz(as_of)).alias("delta_end"),
        (delta & mark.try_cast("timestamp_ntz").isNull()).alias("first_run"))


def max_id(df: DataFrame, pk: str) -> DataFrame:
    """The batch's largest id, never below 0; NULL for a batch without ids."""
    return df.agg(F.greatest(F.max(pk).cast("bigint"), F.max(F.when(F.col(pk).isNotNull(), F.lit(0)))).alias("max_id"))
