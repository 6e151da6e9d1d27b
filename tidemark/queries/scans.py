"""Scans, the load plan, inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import profile, watermark
from tidemark.plans import control
from tidemark.queries.fixtures import (
    COUNTS_SQL, EVENTS_AS_OF, ORDERS_AS_OF, ORDERS_MARK, TABLES, plain, table, tables,
)
from tidemark.queries.registry import query
from tidemark.sources import scan

SAMPLE_ROWS = 1_000

# The control sheet: every spelling of the enabled flag, blank and absent dates, a fact without a
# date, a dimension with one, and a table that does not exist.
SHEET = [
    ("src", "FactOrders", "Delta", "stg", "FactOrders", "o_orderdate", "o_orderkey", "Y"),
    ("src", "FactLineitem", "Delta", "stg", "FactLineitem", "  ", "l_orderkey", "y"),
    ("src", "FactEvents", "Delta", "stg", "FactEvents", "ts", " event_id ", " y "),
    ("src", "FactGone", "Delta", "stg", "FactGone", "ts", "id", "Y"),
    ("src", "DimCustomer", "Full", "stg", "DimCustomer", None, "c_custkey", "Y"),
    ("src", "DimPart", "Full", "stg", "DimPart", None, "p_partkey", "n"),
    ("src", "DimSupplier", "Full", "stg", "DimSupplier", None, "s_suppkey", None),
    ("src", "DimNation", "Full", "stg", "DimNation", "n_name", "", "y"),
]
SHEET_SCHEMA = ("Source_Schema string, Source_table_name string, Extract_Type string, Target_Schema string, "
                "Target_Table_Name string, Date_Column_Name string, PK_Column_Name string, `Enabled ` string")
SHEET_TABLES = {"FactOrders": "orders", "FactLineitem": "lineitem", "FactEvents": "events", "DimCustomer": "customer",
                "DimPart": "part", "DimSupplier": "supplier", "DimNation": "nation"}


def sheet(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SHEET, SHEET_SCHEMA)


def sheet_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_counts({f"src.{n}": table(spark, sf, t) for n, t in SHEET_TABLES.items()})


def one_mark(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("src.FactOrders", ORDERS_MARK)], "table_name string, last_delta_value string")


def _text(v) -> str:
    return "NULL" if v is None else "'" + v + "'"


PLAN_SQL = f"""
WITH sheet(ss, st, et, ts, tt, dc, pk, en) AS (VALUES {', '.join('(' + ', '.join(_text(v) for v in r) + ')' for r in SHEET)}),
counts AS ({' UNION ALL '.join(f"SELECT '{n}' AS st, count(*) AS row_count FROM {t}" for n, t in SHEET_TABLES.items())}),
on_rows AS (SELECT ss || '.' || st AS table_name, st, ts AS target_schema, tt AS target_table,
                   nullif(trim(pk), '') AS pk_column, nullif(trim(dc), '') AS date_column
            FROM sheet WHERE lower(trim(coalesce(en, ''))) = 'y'),
typed AS (SELECT *, CASE WHEN starts_with(st, 'Fact') AND date_column IS NOT NULL THEN 'DELTA' ELSE 'FULL' END AS load_type,
                 CASE WHEN st = 'FactOrders' THEN TIMESTAMP '{ORDERS_MARK}' END AS mark
          FROM on_rows),
sized AS (SELECT t.*, c.row_count,
                 CASE WHEN row_count < 1000 THEN 'small' WHEN row_count < 100000 THEN 'medium' WHEN row_count < 1000000 THEN 'large'
                      WHEN row_count < 10000000 THEN 'very large' ELSE 'massive' END AS tier
          FROM typed t JOIN counts c USING (st)),
plan AS (SELECT table_name, target_schema, target_table, pk_column, date_column, load_type,
       CASE WHEN load_type = 'DELTA' THEN coalesce(mark, TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 7 DAY) END AS delta_start,
       CASE WHEN load_type = 'DELTA' THEN TIMESTAMP '{ORDERS_AS_OF}' END AS delta_end,
       load_type = 'DELTA' AND mark IS NULL AS first_run, row_count, tier,
       CASE WHEN NOT starts_with(st, 'Fact') THEN CASE tier WHEN 'small' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END
            WHEN tier <> 'massive' THEN 4 ELSE 5 END AS phase
FROM sized)"""


@query("SELECT * FROM lineitem")
def full_scan(spark, sf):
    return table(spark, sf, "lineitem")


@query(f"SELECT * FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey) <= {SAMPLE_ROWS}")
def sample_scan(spark, sf):
    return scan.sample(table(spark, sf, "orders"), "o_orderkey", SAMPLE_ROWS)


@query(f"SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_MARK}'")
def delta_scan_date(spark, sf):
    return scan.since(table(spark, sf, "orders"), "o_orderdate", ORDERS_MARK)


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-13 00:00:00'")
def delta_first_run(spark, sf):
    start = watermark.start_value(F.lit(None).cast("string"), "2024-01-20 12:34:56")
    return table(spark, sf, "events").filter(F.col("ts") >= start)


@query(f"SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '{EVENTS_AS_OF}'")
def delta_window(spark, sf):
    return scan.window(table(spark, sf, "events"), "ts", "2024-01-10 00:00:00", EVENTS_AS_OF)


@query("SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 10 * 8 FROM orders)")
def delta_scan_id(spark, sf):
    orders = table(spark, sf, "orders")
    snapshot = profile.key_stats(orders, "o_orderkey").first().max_key // 10 * 8
    return scan.above_id(orders, "o_orderkey", snapshot)


@query("""SELECT * FROM lineitem WHERE l_orderkey >= (SELECT max(l_orderkey) // 4 FROM lineitem)
          AND l_orderkey < (SELECT max(l_orderkey) // 2 FROM lineitem)""")
def range_scan(spark, sf):
    lines = table(spark, sf, "lineitem")
    top = profile.key_stats(lines, "l_orderkey").first().max_key
    return scan.key_range(lines, "l_orderkey", top // 4, top // 2)


def _plan(spark, sf):
    return control.load_plan(control.read_control(sheet(spark)), sheet_counts(spark, sf), one_mark(spark), ORDERS_AS_OF)


@query(PLAN_SQL + " SELECT * FROM plan")
def load_plan(spark, sf):
    return _plan(spark, sf)


@query(PLAN_SQL + """ SELECT phase, count(*) AS tables, CAST(sum(row_count) AS BIGINT) AS total_rows,
       count(*) FILTER (load_type = 'DELTA') AS delta_tables, string_agg(table_name, ',' ORDER BY table_name) AS table_names
FROM plan GROUP BY phase""")
def load_phases(spark, sf):
    return control.phase_summary(_plan(spark, sf))


@query(f"""
WITH counts AS ({COUNTS_SQL}),
asked AS (SELECT table_name FROM counts WHERE table_name NOT IN ('pages', 'labels')
          UNION ALL SELECT 'returns' UNION ALL SELECT 'stores')
SELECT coalesce(c.table_name, a.table_name) AS table_name, c.table_name IS NOT NULL AS table_exists, row_count,
       CASE WHEN c.table_name IS NULL THEN 'missing' WHEN a.table_name IS NULL THEN 'extra' ELSE 'found' END AS status
FROM counts c FULL JOIN asked a ON c.table_name = a.table_name""")
def table_inventory(spark, sf):
    names = [t for t in TABLES if t not in ("pages", "labels")] + ["returns", "stores"]
    asked = spark.createDataFrame([(n,) for n in names], "table_name string")
    return profile.inventory(profile.table_counts(tables(spark, sf)), asked)


@query(f"""SELECT table_name, row_count,
       CASE WHEN row_count < 100 THEN 'small' WHEN row_count < 1000 THEN 'medium' WHEN row_count < 10000 THEN 'large'
            WHEN row_count < 50000 THEN 'very large' ELSE 'massive' END AS tier,
       CASE WHEN row_count < 1000 THEN 'full load' WHEN row_count < 10000 THEN 'full load with monitoring'
            WHEN row_count < 50000 THEN 'consider delta load' ELSE 'delta or sample' END AS strategy
FROM ({COUNTS_SQL})""")
def table_tiers(spark, sf):
    """The bounds are parameters; these split the given tables into all five tiers."""
    bounds = (100, 1_000, 10_000, 50_000, None)
    tiers = [(b, *t[1:]) for b, t in zip(bounds, profile.TIERS)]
    return profile.with_tiers(profile.table_counts(tables(spark, sf)), tiers)


@query(f"""SELECT * FROM ({COUNTS_SQL} UNION ALL SELECT 'price_floor', count(*) FROM (SELECT min(p_retailprice) FROM part))
       WHERE row_count <= 1""")
def placeholder_tables(spark, sf):
    """The given tables and one derived table of a single row."""
    floor = table(spark, sf, "part").agg(F.min("p_retailprice"))
    return profile.placeholders(profile.table_counts({**tables(spark, sf), "price_floor": floor}))


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS rows_changed FROM events GROUP BY ALL")
def daily_change(spark, sf):
    return plain(profile.daily_change(table(spark, sf, "events"), "ts"))


@query(" UNION ALL ".join(f"""
SELECT '{t}' AS table_name, count(*) AS days, CAST(sum(n) AS BIGINT) AS rows_dated,
       CAST(floor(sum(n) / count(*)) AS BIGINT) AS avg_per_day, min(n) AS min_per_day, max(n) AS max_per_day
FROM (SELECT CAST({c} AS DATE) AS day, count(*) AS n FROM {t} GROUP BY ALL)"""
                          for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))))
def change_rate(spark, sf):
    dated = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    a, b, c = [profile.change_rate(table(spark, sf, t), d, t) for t, d in dated]
    return a.unionByName(b).unionByName(c)


@query(f"""SELECT 'counts' AS what, table_name, NULL AS min_key, NULL AS max_key, row_count FROM ({COUNTS_SQL}) UNION ALL
SELECT 'keys', 'orders', min(o_orderkey), max(o_orderkey), count(*) FROM orders UNION ALL
SELECT 'keys', 'lineitem', min(l_orderkey), max(l_orderkey), count(*) FROM lineitem""")
def footer_profile(spark, sf):
    """Counts of all tables and key ends of the large ones, from file footers."""
    none = F.lit(None).cast("bigint")
    counts = profile.table_counts_from_footers(spark, {t: f"{sf}/{t}.parquet" for t in TABLES})
    out = counts.select(F.lit("counts").alias("what"), "table_name", none.alias("min_key"), none.alias("max_key"), "row_count")
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        found = profile.key_stats_from_footers(spark, f"{sf}/{name}.parquet", key)
        out = out.unionByName(found.select(F.lit("keys").alias("what"), F.lit(name).alias("table_name"), "min_key", "max_key", "row_count"))
    return out


@query("SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key, count(*) AS row_count FROM orders")
def key_stats(spark, sf):
    return profile.key_stats(table(spark, sf, "orders"), "o_orderkey")
