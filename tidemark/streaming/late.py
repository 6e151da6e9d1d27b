"""Rows that turn up dated before the watermark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import ntz


def late_rows(source: DataFrame, target: DataFrame, pk: str, date: str, watermark: str | dt.datetime,
              overlap_days: int, dates_never_change: bool = False) -> DataFrame:
    """Source rows dated in the `overlap_days` before the watermark whose key the target does not have.

    The target's keys are first cut to those of the overlap (Spark can prune that scan by the few keys it is joined
    with), so no shuffle of all keys is made distinct. If a row never changes its date, the target is read in the
    overlap only.
    """
    mark = ntz(watermark)
    low = mark - F.make_dt_interval(F.lit(overlap_days))
    overlap = (F.col(date) >= low) & (F.col(date) < mark)
    rows = source.filter(overlap)
    keys = rows.select(pk).distinct()
    known = (target.filter(overlap) if dates_never_change else target).select(pk).join(keys, pk, "left_semi").distinct()
    return rows.join(known, pk, "left_anti").select(*source.columns)


def drop_repeats(stream: DataFrame, pk: str, date: str, delay: str) -> DataFrame:
    """Streaming form: a key that comes again within `delay` of event time is dropped; state stays bounded.

    Spark takes event time only from a timestamp with zone, so the date is cast for it in a column of its own.
    """
    timed = stream.withColumn("_event_time", F.col(date).cast("timestamp")).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark([pk]).drop("_event_time")
