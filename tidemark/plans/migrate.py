"""First load of a big table by key ranges, in a form that can stop and go on.

Pending ranges run together in one Spark job or in a few. A range is logged as done only after its
rows are counted where they were written; one that failed, or that was cut off, is pending again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import literal_like, ntz
from tidemark.operators import ranges, sink
from tidemark.operators.clean import clean_table
from tidemark.operators.conform import conform
from tidemark.operators.ranges import LOG_SCHEMA, NULL_RANGE
from tidemark.session import one_row
from tidemark.sources.staged import read_csv

_MAX_PUSHED = 50   # spans of a pushed filter


def snapshot(source: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key and row count when the migration starts; later rows come by `scan.above_id`."""
    return source.agg(F.min(key).alias("min_id"), F.max(key).alias("snapshot_max_id"), F.count(F.lit(1)).alias("row_count"))


def within_snapshot(source: DataFrame, key: str, snapshot_max_id: int) -> DataFrame:
    """Rows that belong to the migration. Without this the open last range would also take later rows,
    and the catch-up would load them a second time."""
    return source.filter((F.col(key) <= literal_like(snapshot_max_id, source.schema[key].dataType)) | F.col(key).isNull())


def key_filter(key: str, todo: list) -> Column:
    """A filter for the scan that keeps the pending ranges, neighbours joined; with many spans a little more than them."""
    spans: list[list] = []
    for r in sorted((r for r in todo if r.range_id != NULL_RANGE), key=lambda r: r.range_id):
        if spans and spans[-1][1] is not None and spans[-1][1] == r.start_id:
            spans[-1][1] = r.end_id
        else:
            spans.append([r.start_id, r.end_id])
    while len(spans) > _MAX_PUSHED:   # close the smallest gap: a little more is read, the join drops it
        at = min(range(1, len(spans)), key=lambda i: spans[i][0] - spans[i - 1][1])
        spans[at - 1][1] = spans.pop(at)[1]
    out = F.col(key).isNull() if any(r.range_id == NULL_RANGE for r in todo) else F.lit(False)
    for start, end in spans:
        part = F.col(key).isNotNull()
        if start is not None:
            part = part & (F.col(key) >= start)
        if end is not None:
            part = part & (F.col(key) < end)
        out = out | part
    return out


def verify(expected: DataFrame, counted: DataFrame, phase: str, at: str | dt.datetime) -> DataFrame:
    """Log rows for the ranges just written: done if at least the expected rows are there, else failed."""
    rows = F.coalesce("row_count_written", F.lit(0))
    return expected.select("range_id", "row_count").join(
        counted.select("range_id", F.col("row_count").alias("row_count_written")), "range_id", "left").select(
        F.lit(phase).alias("phase"), F.col("range_id").cast("int").alias("range_id"), rows.alias("rows"),
        ntz(at).alias("completed_at"), F.when(rows >= F.col("row_count"), "done").otherwise("failed").alias("status"))


def _in(wave: list) -> Column:
    return F.col("range_id").isin([r.range_id for r in wave])   # on a folder column this opens the folders of these ranges only


def _written(spark: SparkSession, path: str, wave: list) -> DataFrame:
    if not sink.has_data(spark, path):   # ranges without rows leave nothing
        return spark.createDataFrame([], "range_id int, row_count bigint")
    rows = spark.read.schema("range_id int").parquet(path).filter(_in(wave))
    return rows.groupBy("range_id").agg(F.count(F.lit(1)).alias("row_count"))


def _expected(spark: SparkSession, wave: list) -> DataFrame:
    return spark.createDataFrame([(r.range_id, r.row_count) for r in wave], "range_id int, row_count bigint")


def _record(spark: SparkSession, wave: list, path: str, log_path: str, phase: str, at) -> None:
    sink.append_log(verify(_expected(spark, wave), _written(spark, path, wave), phase, at), log_path)


def _waves(todo: list, size: int | None) -> list[list]:
    """Pending ranges in order, `size` per job, or all in one."""
    todo = sorted(todo, key=lambda r: r.range_id)
    size = size or len(todo)
    return [todo[i:i + size] for i in range(0, len(todo), size)]


def _logged(spark: SparkSession, log_path: str, phase: str, at) -> DataFrame:
    return sink.read_log(spark, log_path, LOG_SCHEMA).filter((F.col("phase") == phase) & (F.col("completed_at") == ntz(at)))


def _is_fresh(spark: SparkSession, path: str, log: DataFrame, phase: str) -> bool:
    """Whether what lies at `path` is of an earlier run, whose ranges need not be those of this one."""
    done = ranges.done_entries(log, phase).limit(1).count()
    mode = ranges.start_mode(F.lit(sink.has_data(spark, path)), F.lit(done))
    return one_row(spark, mode=mode).first().mode == "rebuild"


def export_ranges(spark: SparkSession, source: DataFrame, key: str, plan: DataFrame, path: str, log_path: str,
                  at: str | dt.datetime, rows_per_file: int = sink.ROWS_PER_RANGE_FILE,
                  ranges_per_job: int | None = None, cleaned: bool = True) -> DataFrame | None:
    """Clean and write every pending range to its folder and log it. None if nothing is pending.

    The scan is cut to the pending keys, so going on after a stop does not read the table again. With
    `ranges_per_job` the ranges go in several jobs, and those of a finished job stay done if a later
    one fails; that pays if the table lies in key order, for else every job reads all of it.
    """
    log = sink.read_log(spark, log_path, LOG_SCHEMA)
    todo = ranges.pending(plan, log, "export").collect()   # a row per range
    if not todo:
        return None
    fresh = _is_fresh(spark, path, log, "export")
    for wave in _waves(todo, ranges_per_job):
        rows = source.filter(key_filter(key, wave))
        if cleaned:
            rows = clean_table(rows)
        sink.write_ranges(ranges.assign_found(rows, key, wave).filter("range_id is not null"), path, rows_per_file, fresh=fresh)
        _record(spark, wave, path, log_path, "export", at)
        fresh = False
    return _logged(spark, log_path, "export", at)


def load_ranges(spark: SparkSession, staged: str, target: str, log_path: str, at: str | dt.datetime,
                rows_per_file: int = sink.ROWS_PER_RANGE_FILE, ranges_per_job: int | None = None,
                schema: str | None = None, csv_schema: str | None = None, plan: DataFrame | None = None) -> DataFrame | None:
    """Load every staged range the log does not show as loaded. None if nothing is pending.

    With `plan`, the ranges whose export is done are loaded, and each must hold the rows that the plan counted: a
    range whose export failed, or lost rows since, is not loaded, or logged as failed, and stays pending. Without
    it (files from elsewhere) every staged range is, and what it must hold is counted in the files.

    Staged are parquet folders, or text files if `csv_schema` says what they hold (staged.export_ranges_csv).
    With `schema` the rows are cast to the declared columns; what does not fit becomes NULL, and
    conform_report says how much that is. A range's folder in the target is
    replaced, so a repeat adds nothing. A job opens the folders of its own ranges only.
    """
    log = sink.read_log(spark, log_path, LOG_SCHEMA)
    if plan is not None:
        exported = ranges.done_entries(log, "export").select("range_id").distinct()
        todo = ranges.pending(plan, log, "load").join(exported, "range_id", "left_semi").collect()   # a row per range
        if not todo or not sink.has_data(spark, staged):   # no file at all: no range has rows
            if todo:
                sink.append_log(verify(_expected(spark, todo), _written(spark, staged, todo), "load", at), log_path)
            return _logged(spark, log_path, "load", at) if todo else None
    if csv_schema is not None:
        files = read_csv(spark, staged, f"{csv_schema}, range_id int")
    else:
        files = spark.read.parquet(staged)
    if schema is not None:
        files = conform(files, f"{schema}, range_id int")
    if plan is None:
        counts = files.groupBy("range_id").agg(F.count(F.lit(1)).alias("row_count"))
        todo = ranges.pending(counts, log, "load").collect()   # a row per range
        if not todo:
            return None
    fresh = _is_fresh(spark, target, log, "load")
    for wave in _waves(todo, ranges_per_job):
        sink.write_ranges(files.filter(_in(wave)), target, rows_per_file, gather=False, fresh=fresh)
        _record(spark, wave, target, log_path, "load", at)
        fresh = False
    return _logged(spark, log_path, "load", at)


def unfinished(plan: DataFrame, log: DataFrame) -> int:
    """How many ranges still have to be exported or loaded; a run with any is not closed."""
    return sum(ranges.pending(plan, log, phase).count() for phase in ("export", "load"))


def close(spark: SparkSession, log_path: str, phase: str, at: str | dt.datetime) -> None:
    """End a run without errors: what is logged so far no longer counts for the next run."""
    row = one_row(spark, phase=F.lit(phase), range_id=F.lit(None).cast("int"), rows=F.lit(None).cast("bigint"),
                  completed_at=ntz(at), status=F.lit("closed"))
    sink.append_log(row, log_path)
