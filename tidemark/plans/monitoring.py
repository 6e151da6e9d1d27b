"""Monitoring views over the audit and quality logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import ntz


def _flag(c: Column) -> Column:
    """Count of true rows; NULL counts as neither success nor failure."""
    return F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("bigint")


def _avg_ms() -> Column:
    """Average as an integer, cut, as in integer arithmetic."""
    return F.floor(F.avg("duration_ms")).cast("bigint").alias("avg_duration_ms")


def _recent(stats: DataFrame, as_of: str | dt.datetime, days: int) -> DataFrame:
    return stats.filter(F.col("run_started") >= ntz(as_of) - F.make_dt_interval(F.lit(days)))


def latest_runs(stats: DataFrame) -> DataFrame:
    """The newest run of each source table and target. Newer first, then by run id, so that ties have one answer."""
    w = Window.partitionBy("source_schema", "source_table", "target_schema", "target_table").orderBy(F.desc("run_started"), F.desc("run_id"))
    return stats.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(
        "source_schema", "source_table", "target_schema", "target_table", "load_type", "pipeline_name", "trigger_type", "source_system_id",
        "rows_read", "rows_loaded", "rows_rejected",
        (F.col("duration_ms").cast("double") / 1000).alias("duration_seconds"),
        F.when(F.col("success"), "Success").otherwise("Failed").alias("status"),
        "error_message", "run_started", "run_ended", "run_id")


def daily_summary(stats: DataFrame) -> DataFrame:
    return stats.groupBy(F.col("run_started").cast("date").alias("run_date"), "pipeline_name", "trigger_type").agg(
        F.count(F.lit(1)).alias("total_tables"),
        _flag(F.col("success")).alias("successful"), _flag(~F.col("success")).alias("failed"),
        F.sum("rows_read").alias("total_rows_read"), F.sum("rows_loaded").alias("total_rows_loaded"),
        F.sum("rows_rejected").alias("total_rows_rejected"),
        (F.sum("duration_ms").cast("double") / 1000).alias("total_duration_seconds"),
        F.count_distinct("run_id").alias("batch_count"))


def quality_issues(quality: DataFrame, stats: DataFrame) -> DataFrame:
    """Failed checks with the run they belong to; a check whose run is not logged stays."""
    runs = stats.select("run_id", F.concat_ws(".", "source_schema", "source_table").alias("table_name"),
                        "pipeline_name", "trigger_type")
    return quality.filter(~F.col("is_valid")).join(runs, ["run_id", "table_name"], "left").select(
        "run_id", "table_name", "check_type", "source_value", "target_value", "difference", "difference_percent",
        "checked_at", "pipeline_name", "trigger_type")


def trend(stats: DataFrame, as_of: str | dt.datetime, days: int = 30) -> DataFrame:
    recent = _recent(stats, as_of, days)
    return recent.groupBy(F.col("run_started").cast("date").alias("run_date"), "source_schema", "source_table", "load_type").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"), _avg_ms(),
        _flag(F.col("success")).alias("success_count"), _flag(~F.col("success")).alias("failure_count"))


def by_trigger(stats: DataFrame, as_of: str | dt.datetime, days: int = 7) -> DataFrame:
    return _recent(stats, as_of, days).groupBy("trigger_type").agg(
        _avg_ms(), F.sum("rows_loaded").alias("total_rows"), F.count(F.lit(1)).alias("run_count"))


def failed_runs(stats: DataFrame) -> DataFrame:
    return stats.filter(~F.col("success")).select(
        "run_id", "pipeline_name", "trigger_type", "source_table", "target_table", "rows_read", "rows_loaded",
        "rows_rejected", "error_message", "run_started").orderBy(F.desc("run_started"), "run_id", "source_table")


def run_summary(stats: DataFrame, quality: DataFrame) -> DataFrame:
    """One row per run: tables by load type, outcome, rows, time, and tables with quality issues."""
    runs = stats.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("tables"),
        _flag(F.col("load_type") == "FULL").alias("full_loads"), _flag(F.col("load_type") == "DELTA").alias("delta_loads"),
        _flag(F.col("success")).alias("succeeded"), _flag(~F.col("success")).alias("failed"),
        F.sum("rows_loaded").alias("total_rows_loaded"), F.sum("rows_rejected").alias("total_rows_rejected"),
        (F.sum("duration_ms").cast("double") / 1000).alias("total_seconds"))
    issues = quality.filter(~F.col("is_valid")).groupBy("run_id").agg(F.count_distinct("table_name").alias("_issues"))
    return runs.join(issues, "run_id", "left").select(
        *runs.columns, F.coalesce("_issues", F.lit(0)).cast("bigint").alias("quality_issues"))


def alerts(stats: DataFrame, quality: DataFrame) -> DataFrame:
    """Rows worth an alert (run_id, severity, title, facts): failed tables, quality issues, runs with failures."""
    def facts(**cols: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(k) for k, c in cols.items()])).alias("facts")

    table = F.concat_ws(".", "source_schema", "source_table")
    failed = stats.filter(~F.col("success")).select(
        "run_id", F.lit("error").alias("severity"), F.concat(F.lit("Sync failed: "), "source_table").alias("title"),
        facts(table=table, load_type=F.col("load_type"), rows_read=F.col("rows_read"), error=F.col("error_message")))
    issues = quality.filter(~F.col("is_valid")).select(
        "run_id", F.lit("warning").alias("severity"), F.concat(F.lit("Quality issue: "), "table_name").alias("title"),
        facts(table=F.col("table_name"), check=F.col("check_type"), source=F.col("source_value"),
              target=F.col("target_value"), difference=F.col("difference")))
    runs = stats.groupBy("run_id").agg(
        _flag(F.col("success")).alias("ok"), _flag(~F.col("success")).alias("bad"),
        F.sum("rows_loaded").alias("rows")).filter("bad > 0").select(
        "run_id", F.lit("error").alias("severity"), F.lit("Run completed with failures").alias("title"),
        facts(succeeded=F.col("ok"), failed=F.col("bad"), total_rows=F.col("rows")))
    return failed.unionByName(issues).unionByName(runs)


def register_views(spark, stats: DataFrame, quality: DataFrame, as_of: str | dt.datetime) -> None:
    """The four standing views, for SQL users."""
    latest_runs(stats).createOrReplaceTempView("v_latest_runs")
    daily_summary(stats).createOrReplaceTempView("v_daily_summary")
    quality_issues(quality, stats).createOrReplaceTempView("v_data_quality_issues")
    trend(stats, as_of).createOrReplaceTempView("v_30day_trend")
