"""Inputs of the registered queries: the given tables, and dirty or derived forms of them.

Each derived form is written twice, as a DataFrame and as SQL, over every row of its table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import work_root

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

ORDERS_AS_OF = "1999-01-01 00:00:00"
ORDERS_MARK = "1998-06-01 00:00:00"
EVENTS_AS_OF = "2024-01-20 00:00:00"
BATCH = "b_orders_001"
SYSTEM = 1


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf, name) for name in TABLES}


def plain(df: DataFrame) -> DataFrame:
    """Dates and decimals as text, which every engine and client shows alike."""
    odd = {n: F.col(n).cast("string") for n, t in df.dtypes if t == "date" or t.startswith("decimal")}
    return df.withColumns(odd) if odd else df


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)


def dirty_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with NULL keys, bad date texts, non-finite prices and texts that spell NULL."""
    k = F.col("o_orderkey")
    token = (F.when(k % 73 == 0, "nan").when(k % 73 == 1, "None").when(k % 73 == 2, "NULL").when(k % 73 == 3, "null")
             .otherwise(F.col("o_orderpriority")))
    price = (F.when(k % 83 == 0, F.lit(float("inf"))).when(k % 79 == 0, F.lit(float("nan")))
             .otherwise(F.col("o_totalprice")))
    day = F.when(k % 89 == 0, "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf, "orders").select(
        F.when(k % 97 != 0, k).alias("o_orderkey"), "o_custkey", "o_orderstatus", price.alias("o_totalprice"),
        day.alias("o_orderdate"), token.alias("o_orderpriority"))


DIRTY_ORDERS_SQL = """
SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 83 = 0 THEN 'inf'::DOUBLE WHEN o_orderkey % 79 = 0 THEN 'nan'::DOUBLE
            ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 89 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_orderdate,
       CASE o_orderkey % 73 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN 'NULL' WHEN 3 THEN 'null'
            ELSE o_orderpriority END AS o_orderpriority
FROM orders"""

CLEAN_ORDERS_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN isfinite(o_totalprice) THEN round_even(o_totalprice, 10) END AS o_totalprice,
       try_cast(o_orderdate AS TIMESTAMP) AS o_orderdate,
       CASE WHEN o_orderpriority NOT IN ('nan', 'None', 'NULL', 'null') THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey IS NULL THEN 'null_pk'
            WHEN try_cast(o_orderdate AS TIMESTAMP) > TIMESTAMP '{ORDERS_AS_OF}' THEN 'future_date' END AS _reject_reason
FROM ({DIRTY_ORDERS_SQL})"""


def dirty_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem with NaN and both infinities among the prices."""
    k = F.col("l_orderkey")
    price = (F.when(k % 83 == 0, F.lit(float("inf"))).when(k % 83 == 1, F.lit(float("-inf")))
             .when(k % 79 == 0, F.lit(float("nan"))).otherwise(F.col("l_extendedprice")))
    return table(spark, sf, "lineitem").withColumn("l_extendedprice", price)


DIRTY_PRICES_SQL = """
SELECT * REPLACE (CASE WHEN l_orderkey % 83 = 0 THEN 'inf'::DOUBLE WHEN l_orderkey % 83 = 1 THEN '-inf'::DOUBLE
                       WHEN l_orderkey % 79 = 0 THEN 'nan'::DOUBLE ELSE l_extendedprice END AS l_extendedprice)
FROM lineitem"""


def lossy(df: DataFrame, key: str, every: int) -> DataFrame:
    """A target that lost the rows whose key is a multiple of `every`."""
    return df.filter(F.col(key) % every != 0)


def changed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """A target of orders with lost, changed and extra rows."""
    o = table(spark, sf, "orders")
    price = F.when(F.col("o_orderkey") % 101 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    extra = o.filter(F.col("o_orderkey") % 103 == 0).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)
    return lossy(o, "o_orderkey", 211).withColumn("o_totalprice", price).unionByName(extra)


CHANGED_ORDERS_SQL = """
SELECT * REPLACE (CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
FROM orders WHERE o_orderkey % 211 <> 0
UNION ALL SELECT * REPLACE (o_orderkey + 1000000000 AS o_orderkey) FROM orders WHERE o_orderkey % 103 = 0"""


def sparse_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem keys with wide gaps, a heavy key and NULLs, for range planning."""
    k = F.col("l_orderkey")
    key = (F.when((k % 97 == 0) & (F.col("l_linenumber") == 1), F.lit(None))
           .when(k % 10 == 3, F.lit(777)).otherwise(k + 100_000 * F.expr("l_orderkey div 5000")))
    return table(spark, sf, "lineitem").select(key.cast("bigint").alias("k"), "l_orderkey", "l_linenumber")


SPARSE_KEYS_SQL = """
SELECT CAST(CASE WHEN l_orderkey % 97 = 0 AND l_linenumber = 1 THEN NULL WHEN l_orderkey % 10 = 3 THEN 777
            ELSE l_orderkey + 100000 * (l_orderkey // 5000) END AS BIGINT) AS k, l_orderkey, l_linenumber
FROM lineitem"""


def load_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Audit rows: each day of events is a run, each event type a table."""
    day, kind = F.col("ts").cast("date"), F.col("event_type")
    counted = table(spark, sf, "events").groupBy(day.alias("day"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    n, kind = F.col("n"), F.col("kind")
    started = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.length(kind))
    ok = (F.dayofmonth("day") + F.length(kind)) % 5 != 0
    return counted.select(
        F.date_format("day", "yyyy-MM-dd").alias("run_id"), F.lit("sync_events").alias("pipeline_name"),
        F.when(F.dayofmonth("day") % 2 == 0, "scheduled").otherwise("manual").alias("trigger_type"),
        F.lit(1).alias("source_system_id"), F.lit("web").alias("source_system_name"),
        started.alias("run_started"), (started + F.make_dt_interval(secs=(n * 10 / 1000).cast("decimal(18,6)"))).alias("run_ended"),
        F.lit("src").alias("source_schema"), kind.alias("source_table"), F.lit("stg").alias("target_schema"),
        kind.alias("target_table"), F.when(F.length(kind) % 2 == 0, "DELTA").otherwise("FULL").alias("load_type"),
        F.lit("ts").alias("delta_column"), n.alias("rows_read"), (n - n % 7).alias("rows_loaded"),
        (n % 7).alias("rows_rejected"), F.lit(1).alias("chunks_processed"), (n * 10).alias("duration_ms"),
        ok.alias("success"), F.when(~ok, F.concat(F.lit("could not load "), kind)).alias("error_message"))


LOAD_STATS_SQL = """
SELECT strftime(day, '%Y-%m-%d') AS run_id, 'sync_events' AS pipeline_name,
       CASE WHEN day(day) % 2 = 0 THEN 'scheduled' ELSE 'manual' END AS trigger_type,
       1 AS source_system_id, 'web' AS source_system_name,
       CAST(day AS TIMESTAMP) + to_hours(length(kind)) AS run_started,
       CAST(day AS TIMESTAMP) + to_hours(length(kind)) + to_milliseconds(n * 10) AS run_ended,
       'src' AS source_schema, kind AS source_table, 'stg' AS target_schema, kind AS target_table,
       CASE WHEN length(kind) % 2 = 0 THEN 'DELTA' ELSE 'FULL' END AS load_type, 'ts' AS delta_column,
       n AS rows_read, n - n % 7 AS rows_loaded, n % 7 AS rows_rejected, 1 AS chunks_processed, n * 10 AS duration_ms,
       (day(day) + length(kind)) % 5 <> 0 AS success,
       CASE WHEN (day(day) + length(kind)) % 5 = 0 THEN 'could not load ' || kind END AS error_message
FROM (SELECT CAST(ts AS DATE) AS day, event_type AS kind, count(*) AS n FROM events GROUP BY ALL)"""


def quality_log(spark: SparkSession, sf: str) -> DataFrame:
    """One row-count check per audit row: target short by the rejected rows, failed above 3 of them.

    Checks of odd days carry a run that is not in the audit log, so that the outer join has something to keep.
    """
    s = load_stats(spark, sf)
    return s.select(
        F.when(F.col("trigger_type") == "manual", F.concat(F.lit("lost-"), "run_id")).otherwise(F.col("run_id")).alias("run_id"),
        F.concat_ws(".", "source_schema", "source_table").alias("table_name"), F.lit("ROW_COUNT").alias("check_type"),
        F.col("rows_read").cast("string").alias("source_value"), F.col("rows_loaded").cast("string").alias("target_value"),
        F.col("rows_rejected").alias("difference"),
        (F.col("rows_rejected").cast("double") / F.col("rows_read").cast("double") * 100).alias("difference_percent"),
        (F.col("rows_rejected") <= 3).alias("is_valid"), F.col("run_ended").alias("checked_at"))


QUALITY_LOG_SQL = f"""
SELECT CASE WHEN trigger_type = 'manual' THEN 'lost-' || run_id ELSE run_id END AS run_id,
       source_schema || '.' || source_table AS table_name, 'ROW_COUNT' AS check_type,
       CAST(rows_read AS VARCHAR) AS source_value, CAST(rows_loaded AS VARCHAR) AS target_value,
       rows_rejected AS difference, CAST(rows_rejected AS DOUBLE) / CAST(rows_read AS DOUBLE) * 100 AS difference_percent,
       rows_rejected <= 3 AS is_valid, run_ended AS checked_at
FROM ({LOAD_STATS_SQL})"""


def watermark_log(spark: SparkSession, sf: str) -> DataFrame:
    """Watermark entries: one per event type and day."""
    return load_stats(spark, sf).select(
        F.concat_ws(".", "source_schema", "source_table").alias("table_name"), F.col("load_type").alias("last_load_type"),
        F.col("delta_column").alias("last_delta_column"),
        F.date_format("run_started", "yyyy-MM-dd HH:mm:ss").alias("last_delta_value"),
        F.col("rows_read").alias("last_max_id"), F.col("rows_loaded").alias("last_row_count"),
        F.col("run_id").alias("last_batch_id"), F.col("run_ended").alias("last_success_at"), F.col("run_ended").alias("updated_at"))


WATERMARK_LOG_SQL = f"""
SELECT source_schema || '.' || source_table AS table_name, load_type AS last_load_type, delta_column AS last_delta_column,
       strftime(run_started, '%Y-%m-%d %H:%M:%S') AS last_delta_value, rows_read AS last_max_id,
       rows_loaded AS last_row_count, run_id AS last_batch_id, run_ended AS last_success_at, run_ended AS updated_at
FROM ({LOAD_STATS_SQL})"""
