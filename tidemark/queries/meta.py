"""Watermarks, audit rows and the monitoring views over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import sink, watermark
from tidemark.operators.validate import reason_counts
from tidemark.plans import audit, monitoring
from tidemark.queries.cleaning import marked_orders
from tidemark.queries.fixtures import (
    CLEAN_ORDERS_SQL, EVENTS_AS_OF, LOAD_STATS_SQL, ORDERS_AS_OF, QUALITY_LOG_SQL, WATERMARK_LOG_SQL, load_stats,
    fresh_folder, plain, quality_log, table, watermark_log,
)
from tidemark.queries.registry import query
from tidemark.session import stored

_SPLIT = "2024-01-15 00:00:00"   # older watermark entries are the current table, newer ones the updates

_LATEST = "SELECT * FROM ({}) QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY updated_at DESC, last_batch_id DESC) = 1"


@query(_LATEST.format(WATERMARK_LOG_SQL))
def watermark_latest(spark, sf):
    return watermark.latest(watermark_log(spark, sf)).orderBy(F.desc("last_success_at"))


def _cut(spark, sf):
    """Current watermarks without one table, updates without another."""
    log, split = watermark_log(spark, sf), F.lit(_SPLIT).cast("timestamp_ntz")
    current = watermark.latest(log.filter(F.col("updated_at") < split)).filter("table_name <> 'src.signup'")
    updates = watermark.latest(log.filter(F.col("updated_at") >= split)).filter("table_name <> 'src.view'")
    return current, updates


_CUT = f"""
WITH log AS ({WATERMARK_LOG_SQL}),
cur AS (SELECT * FROM ({_LATEST.format(f"SELECT * FROM log WHERE updated_at < TIMESTAMP '{_SPLIT}'")}) WHERE table_name <> 'src.signup'),
upd AS (SELECT * FROM ({_LATEST.format(f"SELECT * FROM log WHERE updated_at >= TIMESTAMP '{_SPLIT}'")}) WHERE table_name <> 'src.view')"""


@query(_CUT + " SELECT * FROM upd UNION ALL SELECT * FROM cur WHERE table_name NOT IN (SELECT table_name FROM upd)")
def watermark_merge(spark, sf):
    return watermark.merge(*_cut(spark, sf))


@query(_CUT + f""", control AS (SELECT DISTINCT source_schema || '.' || source_table AS table_name, load_type FROM ({LOAD_STATS_SQL}))
SELECT c.table_name, load_type,
       CASE WHEN load_type = 'DELTA' THEN coalesce(try_cast(last_delta_value AS TIMESTAMP), TIMESTAMP '2024-01-13 00:00:00') END AS delta_start,
       CASE WHEN load_type = 'DELTA' THEN TIMESTAMP '{EVENTS_AS_OF}' END AS delta_end,
       load_type = 'DELTA' AND last_delta_value IS NULL AS first_run
FROM control c LEFT JOIN cur ON c.table_name = cur.table_name""")
def delta_start_plan(spark, sf):
    control = load_stats(spark, sf).select(
        F.concat_ws(".", "source_schema", "source_table").alias("table_name"), "load_type").distinct()
    return watermark.start_plan(control, _cut(spark, sf)[0], EVENTS_AS_OF)


@query(f"""SELECT source_schema, source_table, target_schema, target_table, load_type, pipeline_name, trigger_type, source_system_id, rows_read, rows_loaded,
       rows_rejected, CAST(duration_ms AS DOUBLE) / 1000 AS duration_seconds,
       CASE WHEN success THEN 'Success' ELSE 'Failed' END AS status, error_message, run_started, run_ended, run_id
FROM ({LOAD_STATS_SQL}) QUALIFY row_number() OVER (PARTITION BY source_schema, source_table, target_schema, target_table ORDER BY run_started DESC, run_id DESC) = 1""")
def v_latest_runs(spark, sf):
    return monitoring.latest_runs(load_stats(spark, sf)).orderBy(F.desc("run_started"))


@query(f"""SELECT CAST(CAST(run_started AS DATE) AS VARCHAR) AS run_date, pipeline_name, trigger_type, count(*) AS total_tables,
       count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed, CAST(sum(rows_read) AS BIGINT) AS total_rows_read,
       CAST(sum(rows_loaded) AS BIGINT) AS total_rows_loaded, CAST(sum(rows_rejected) AS BIGINT) AS total_rows_rejected,
       CAST(sum(duration_ms) AS DOUBLE) / 1000 AS total_duration_seconds, count(DISTINCT run_id) AS batch_count
FROM ({LOAD_STATS_SQL}) GROUP BY ALL""")
def v_daily_summary(spark, sf):
    return plain(monitoring.daily_summary(load_stats(spark, sf)).orderBy(F.desc("run_date")))


@query(f"""SELECT q.run_id, q.table_name, check_type, source_value, target_value, difference, difference_percent, checked_at,
       pipeline_name, trigger_type
FROM ({QUALITY_LOG_SQL}) q LEFT JOIN ({LOAD_STATS_SQL}) s
     ON q.run_id = s.run_id AND q.table_name = s.source_schema || '.' || s.source_table
WHERE NOT is_valid""")
def v_dq_issues(spark, sf):
    return monitoring.quality_issues(quality_log(spark, sf), load_stats(spark, sf)).orderBy(F.desc("checked_at"))


@query(f"""SELECT CAST(CAST(run_started AS DATE) AS VARCHAR) AS run_date, source_schema, source_table, load_type, CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded,
       CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected, CAST(floor(avg(duration_ms)) AS BIGINT) AS avg_duration_ms,
       count(*) FILTER (success) AS success_count, count(*) FILTER (NOT success) AS failure_count
FROM ({LOAD_STATS_SQL}) WHERE run_started >= TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAY GROUP BY ALL""")
def v_trend_30d(spark, sf):
    return plain(monitoring.trend(load_stats(spark, sf), "2024-02-10 00:00:00").orderBy(F.desc("run_date"), "source_table"))


@query(f"""SELECT trigger_type, CAST(floor(avg(duration_ms)) AS BIGINT) AS avg_duration_ms,
       CAST(sum(rows_loaded) AS BIGINT) AS total_rows, count(*) AS run_count
FROM ({LOAD_STATS_SQL}) WHERE run_started >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 7 DAY GROUP BY ALL""")
def perf_by_trigger(spark, sf):
    return monitoring.by_trigger(load_stats(spark, sf), EVENTS_AS_OF)


@query(f"""SELECT run_id, pipeline_name, trigger_type, source_table, target_table, rows_read, rows_loaded, rows_rejected,
       error_message, run_started FROM ({LOAD_STATS_SQL}) WHERE NOT success""")
def failed_runs(spark, sf):
    return monitoring.failed_runs(load_stats(spark, sf))


@query(f"""
WITH s AS ({LOAD_STATS_SQL}), q AS ({QUALITY_LOG_SQL})
SELECT run_id, count(*) AS tables, count(*) FILTER (load_type = 'FULL') AS full_loads, count(*) FILTER (load_type = 'DELTA') AS delta_loads,
       count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed, CAST(sum(rows_loaded) AS BIGINT) AS total_rows_loaded,
       CAST(sum(rows_rejected) AS BIGINT) AS total_rows_rejected, CAST(sum(duration_ms) AS DOUBLE) / 1000 AS total_seconds,
       (SELECT count(DISTINCT table_name) FROM q WHERE q.run_id = s.run_id AND NOT is_valid) AS quality_issues
FROM s GROUP BY run_id""")
def run_summary(spark, sf):
    return monitoring.run_summary(load_stats(spark, sf), quality_log(spark, sf))


@query(f"""
WITH s AS ({LOAD_STATS_SQL}), q AS ({QUALITY_LOG_SQL}),
r AS (SELECT run_id, count(*) FILTER (success) AS ok, count(*) FILTER (NOT success) AS bad, CAST(sum(rows_loaded) AS BIGINT) AS rows FROM s GROUP BY run_id)
SELECT run_id, 'error' AS severity, 'Sync failed: ' || source_table AS title,
       CAST(json_object('table', source_schema || '.' || source_table, 'load_type', load_type, 'rows_read', rows_read, 'error', error_message) AS VARCHAR) AS facts
FROM s WHERE NOT success
UNION ALL SELECT run_id, 'warning', 'Quality issue: ' || table_name,
       CAST(json_object('table', table_name, 'check', check_type, 'source', source_value, 'target', target_value, 'difference', difference) AS VARCHAR)
FROM q WHERE NOT is_valid
UNION ALL SELECT run_id, 'error', 'Run completed with failures',
       CAST(json_object('succeeded', ok, 'failed', bad, 'total_rows', rows) AS VARCHAR) FROM r WHERE bad > 0""")
def alert_rows(spark, sf):
    return monitoring.alerts(load_stats(spark, sf), quality_log(spark, sf))


_AUDIT = {
    "run_id": "run_1", "pipeline_name": "sync_orders", "trigger_type": "manual", "source_system_name": "web",
    "source_schema": "src", "source_table": "orders", "target_schema": "stg", "target_table": "orders", "load_type": "FULL",
}


@query(f"""SELECT {', '.join(f"'{v}' AS {k}" for k, v in _AUDIT.items())}, 1 AS source_system_id,
       TIMESTAMP '{ORDERS_AS_OF}' AS run_started, TIMESTAMP '1999-01-01 00:01:30.25' AS run_ended,
       'o_orderdate' AS delta_column, CAST(NULL AS VARCHAR) AS delta_start_value, CAST(NULL AS VARCHAR) AS delta_end_value,
       count(*) AS rows_read, count(*) FILTER (_reject_reason IS NULL) AS rows_loaded, count(*) FILTER (_reject_reason IS NOT NULL) AS rows_rejected,
       1 AS chunks_processed, CAST(90250 AS BIGINT) AS duration_ms, false AS success, repeat('x', 4000) AS error_message
FROM ({CLEAN_ORDERS_SQL})""")
def audit_row(spark, sf):
    """The audit row of a load that failed after validation, with an error text that is too long."""
    counts = reason_counts(marked_orders(spark, sf)).select(
        "rows_read", F.col("rows_accepted").alias("rows_loaded"), "rows_rejected", F.lit(1).alias("chunks_processed"))
    return audit.audit_row(
        counts, **_AUDIT, source_system_id=1, run_started=ORDERS_AS_OF, run_ended="1999-01-01 00:01:30.25",
        delta_column="o_orderdate", delta_start_value=None, delta_end_value=None, success=False,
        error_message="x" * 5000).withColumns({c: F.col(c).cast("string") for c in ("delta_start_value", "delta_end_value")})


def _systems(spark, sf):
    """Each supplier is a source system; those with a negative balance are switched off."""
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("source_system_id"), F.col("s_name").alias("source_system_name"),
        F.lit("DATABASE").alias("source_system_type"), (F.col("s_acctbal") >= 0).alias("is_active"))


_SYSTEMS = """SELECT CAST(s_suppkey AS INTEGER) AS source_system_id, s_name AS source_system_name, 'DATABASE' AS source_system_type,
       s_acctbal >= 0 AS is_active FROM supplier"""


@query(f"SELECT * FROM ({_SYSTEMS}) WHERE is_active")
def active_sources(spark, sf):
    return audit.active_sources(_systems(spark, sf))


@query(f"""SELECT CAST(l_suppkey AS INTEGER) AS source_system_id, source_system_name, source_system_type, count(*) AS row_count
FROM lineitem LEFT JOIN ({_SYSTEMS}) s ON l_suppkey = s.source_system_id AND is_active GROUP BY ALL""")
def rows_by_source(spark, sf):
    """Rows per source system; rows of a system that is switched off keep no name."""
    counted = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").cast("int").alias("source_system_id")).agg(
        F.count(F.lit(1)).alias("row_count"))
    return audit.with_source_system(counted, _systems(spark, sf)).select(
        "source_system_id", "source_system_name", "source_system_type", "row_count")


@query(LOAD_STATS_SQL)
def log_compacted(spark, sf):
    """Audit rows appended in many small files, put in checkpoints twice on the way, with appends before, between and after."""
    path, rows = fresh_folder(spark, "log"), stored(load_stats(spark, sf), "stats")
    days = sorted(r.day for r in rows.select(F.dayofmonth("run_started").alias("day")).distinct().collect())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    for i, day in enumerate(days):
        sink.append_log(rows.filter(F.dayofmonth("run_started") == day), path)
        if i in (len(days) // 3, 2 * len(days) // 3):
            sink.compact_log(spark, path, schema)
    return sink.read_log(spark, path, schema)
