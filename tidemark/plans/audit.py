"""Audit, watermark and quality rows, and where they are kept."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import clip_text, ntz
from tidemark.operators import watermark
from tidemark.operators.sink import append_log, compact_log, read_log
from tidemark.session import one_row

# Fixed values
LOAD_STATS_SCHEMA = (
    "run_id string, pipeline_name string, trigger_type string, source_system_id int, source_system_name string, "
    "run_started timestamp_ntz, run_ended timestamp_ntz, source_schema string, source_table string, "
    "target_schema string, target_table string, load_type string, delta_column string, delta_start_value string, "
    "delta_end_value string, rows_read bigint, rows_loaded bigint, rows_rejected bigint, chunks_processed int, "
    "duration_ms bigint, success boolean, error_message string"
)
QUALITY_SCHEMA = (
    "run_id string, table_name string, check_type string, source_value string, target_value string, "
    "difference bigint, difference_percent double, is_valid boolean, checked_at timestamp_ntz"
)
SOURCE_SYSTEM_SCHEMA = (
    "source_system_id int, source_system_name string, source_system_type string, description string, "
    "is_active boolean, created_at timestamp_ntz"
)
LOGS = {"load_stats": LOAD_STATS_SCHEMA, "data_quality": QUALITY_SCHEMA, "watermark": watermark.WATERMARK_SCHEMA,
        "source_systems": SOURCE_SYSTEM_SCHEMA}


class MetaStore:
    """The four meta tables as append-only parquet logs below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return read_log(self.spark, f"{self.root}/{name}", LOGS[name])

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows; columns are put in the table's order and types."""
        want = self.spark.createDataFrame([], LOGS[name]).schema
        append_log(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want]), f"{self.root}/{name}")

    def compact(self, at_least: int = 1) -> None:
        """Put what the logs hold in few files, each log that gained `at_least` entries since the last time."""
        for name, schema in LOGS.items():
            compact_log(self.spark, f"{self.root}/{name}", schema, at_least)

    def watermarks(self) -> DataFrame:
        """The newest watermark per table; a log entry replaces an update in place."""
        return watermark.latest(self.read("watermark"))

    def views(self) -> None:
        """Register the logs as temporary views."""
        for name in LOGS:
            self.read(name).createOrReplaceTempView(name)


def audit_row(counts: DataFrame, run_started: str, run_ended: str, error_message: str | None = None, **fields) -> DataFrame:
    """Complete a one-row (rows_read, rows_loaded, rows_rejected, chunks_processed) frame to an audit row.

    Duration comes from the two times; error text is cut to 4000 characters.
    """
    took = dt.datetime.fromisoformat(run_ended) - dt.datetime.fromisoformat(run_started)
    return counts.withColumns({
        **{k: F.lit(v) for k, v in fields.items()},
        "run_started": ntz(run_started), "run_ended": ntz(run_ended),
        "duration_ms": F.lit(took // dt.timedelta(milliseconds=1)).cast("bigint"),
        "error_message": clip_text(F.lit(error_message).cast("string")),
    })


def quality_rows(checks: DataFrame, run_id: str, checked_at: str | dt.datetime) -> DataFrame:
    return checks.withColumns({"run_id": F.lit(run_id), "checked_at": ntz(checked_at)})


def active_sources(systems: DataFrame) -> DataFrame:
    return systems.filter("is_active")


def add_source_system(meta: MetaStore, system_id: int, name: str, kind: str, created_at: str | dt.datetime,
                      description: str | None = None, active: bool = True) -> None:
    """Write a source system's entry; the newest of an id counts."""
    meta.append("source_systems", one_row(
        meta.spark, source_system_id=F.lit(system_id), source_system_name=F.lit(name), source_system_type=F.lit(kind),
        description=F.lit(description).cast("string"), is_active=F.lit(active), created_at=ntz(created_at)))


def with_source_system(df: DataFrame, systems: DataFrame) -> DataFrame:
    """Look up name and type of each row's system; there are few systems."""
    ref = active_sources(systems).select("source_system_id", "source_system_name", "source_system_type")
    return df.join(ref, "source_system_id", "left")
