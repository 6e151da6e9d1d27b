"""Loads that write and read back: text files, batches, versions, ranges, streams, whole runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ranges, relocate, sink, upsert, widen
from tidemark.operators.stamp import stamp
from tidemark.operators.validate import Rules, mark
from tidemark.plans import audit, migrate, sync
from tidemark.plans.control import read_control
from tidemark.queries.cleaning import ORDER_RULES
from tidemark.queries.fixtures import (
    BATCH, CLEAN_ORDERS_SQL, DIRTY_ORDERS_SQL, EVENTS_AS_OF, ORDERS_AS_OF, ORDERS_MARK, SYSTEM, dirty_orders, fresh_folder, lossy, plain, table,
)
from tidemark.queries.ranges import FIXED, _FIXED_PLAN, fixed_counts
from tidemark.queries.registry import query
from tidemark.queries.scans import SHEET_TABLES, sheet
from tidemark.operators.clean import clean_table
from tidemark.session import stored
from tidemark.sources import scan, staged
from tidemark.streaming import ingest, late

PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
ORDER_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                "o_orderdate timestamp_ntz, o_orderpriority string")
STAMPS_SQL = f"TIMESTAMP '{ORDERS_AS_OF}' AS _loaded_at, '{BATCH}' AS _batch_id, CAST({SYSTEM} AS INTEGER) AS _source_system_id"


@query(r"""SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN p_name || '|"a"' || chr(10) || '\n' WHEN 1 THEN NULL ELSE p_name END AS p_name,
       p_brand, p_type, p_size, CAST(printf('%.10f', p_retailprice) AS DOUBLE) AS p_retailprice FROM part""")
def csv_roundtrip(spark, sf):
    """Text with quotes, separators, line breaks and blanks survives; the blank comes back as NULL."""
    folder = fresh_folder(spark, "csv")
    hard = F.concat(F.col("p_name"), F.lit('|"a"\n\\n'))
    name = F.when(F.col("p_partkey") % 7 == 0, hard).when(F.col("p_partkey") % 7 == 1, "").otherwise(F.col("p_name"))
    staged.export_csv(table(spark, sf, "part").withColumn("p_name", name), folder, rows_per_file=1_000)
    return staged.read_csv(spark, folder, PART_SCHEMA)


def _staged_orders(spark, sf, folder, rows_per_file=1_000):
    orders = table(spark, sf, "orders")
    plan = ranges.plan_fixed(orders, "o_orderkey", FIXED)
    staged.export_ranges_csv(ranges.assign(orders, "o_orderkey", plan), folder, rows_per_file=rows_per_file)


@query(_FIXED_PLAN + """ SELECT orders.*, range_id FROM orders JOIN plan ON range_id >= 0 AND (start_id IS NULL OR o_orderkey >= start_id) AND (end_id IS NULL OR o_orderkey < end_id)
WHERE range_id IN (0, 3)""")
def range_load(spark, sf):
    """Two staged ranges read as one table."""
    folder = fresh_folder(spark, "range_load")
    _staged_orders(spark, sf, folder)
    return staged.read_range(spark, folder, [0, 3], ORDER_SCHEMA)


@query(_FIXED_PLAN + " SELECT range_id, row_count AS rows, CAST(ceil(row_count / 1000) AS BIGINT) AS files FROM counts")
def staged_inventory(spark, sf):
    folder = fresh_folder(spark, "inventory")
    _staged_orders(spark, sf, folder)
    return staged.inventory(staged.read_csv(spark, folder, ORDER_SCHEMA)).select("range_id", "rows", "files")


@query(f"SELECT *, {STAMPS_SQL} FROM customer")
def full_load(spark, sf):
    """A load that lost rows, then a whole one that replaces it."""
    root, customers = fresh_folder(spark, "full_load"), table(spark, sf, "customer")
    rules = Rules(pk="c_custkey")
    for rows, batch, at in ((lossy(customers, "c_custkey", 2), "b_first", ORDERS_MARK), (customers, BATCH, ORDERS_AS_OF)):
        sink.replace_table(mark(stamp(clean_table(rows), batch, at, SYSTEM), rules, at), root, "customer", batch, at)
    return sink.read_accepted(spark, sink.current_path(spark, root, "customer"))


@query(f"""SELECT * EXCLUDE (_reject_reason), {STAMPS_SQL} FROM ({CLEAN_ORDERS_SQL}) WHERE _reject_reason IS NULL""")
def delta_load(spark, sf):
    """The same batch loaded twice; the second time replaces the first."""
    path = fresh_folder(spark, "delta_load")
    rows = mark(stamp(clean_table(dirty_orders(spark, sf)), BATCH, ORDERS_AS_OF, SYSTEM), ORDER_RULES, ORDERS_AS_OF)
    for _ in range(2):
        sink.write_batch(rows, path, BATCH)
    return sink.read_accepted(spark, path)


@query("""
WITH n AS (SELECT (SELECT count(*) FROM supplier) AS s, (SELECT count(*) FROM orders) AS o,
                  (SELECT count(*) FROM orders WHERE o_orderkey % 31 <> 0) AS l)
SELECT 'supplier' AS table_name, s AS source_rows, NULL AS target_rows, s AS moved_rows, 'moved' AS verdict, true AS drop_source FROM n
UNION ALL SELECT 'supplier_again', s, s, NULL, 'already_moved', true FROM n
UNION ALL SELECT 'supplier_gone', NULL, s, NULL, 'already_moved', false FROM n
UNION ALL SELECT 'ghost', NULL, NULL, NULL, 'absent', false FROM n
UNION ALL SELECT 'orders', o, NULL, l, 'mismatch_kept', false FROM n""")
def relocate_verify(spark, sf):
    """A move, the same move again, a source that is gone, no table at all, and a copy that lost rows."""
    root, source = fresh_folder(spark, "relocate"), f"{sf}/supplier.parquet"
    first = relocate.relocate(spark, "supplier", source, f"{root}/supplier")
    again = relocate.relocate(spark, "supplier_again", source, f"{root}/supplier")
    gone = relocate.relocate(spark, "supplier_gone", f"{root}/nothing", f"{root}/supplier")
    ghost = relocate.relocate(spark, "ghost", f"{root}/nothing", f"{root}/nowhere")
    orders = table(spark, sf, "orders")
    lost = orders.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(F.col("o_orderkey") % 31 != 0).alias("moved_rows")).select(
        F.lit("orders").alias("table_name"), "source_rows", F.lit(None).cast("bigint").alias("target_rows"), "moved_rows")
    out = relocate.decide(lost)
    for row in (first, again, gone, ghost):
        out = out.unionByName(row)
    return out


@query(_FIXED_PLAN + """ SELECT range_id, count(*) AS row_count,
       CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(19,6))) AS DECIMAL(29,6)) AS VARCHAR) AS total
FROM plan JOIN orders ON range_id >= 0 AND (start_id IS NULL OR o_orderkey >= start_id) AND (end_id IS NULL OR o_orderkey < end_id)
WHERE range_id <> 0 OR o_orderkey % 2 = 1 GROUP BY ALL""")
def range_reexport(spark, sf):
    """One range written again with fewer rows: its old files go, the other ranges stay."""
    path, orders = fresh_folder(spark, "reexport"), table(spark, sf, "orders")
    assigned = ranges.assign(orders, "o_orderkey", ranges.plan_fixed(orders, "o_orderkey", FIXED))
    sink.write_ranges(assigned, path)
    sink.write_ranges(assigned.filter("range_id = 0 and o_orderkey % 2 = 1"), path)
    total = F.sum(F.col("o_totalprice").cast("decimal(19,6)")).alias("total")
    return plain(spark.read.parquet(path).groupBy("range_id").agg(F.count(F.lit(1)).alias("row_count"), total))


@query(_FIXED_PLAN + """ SELECT range_id, row_count AS expected_rows, row_count AS exported_rows, row_count AS loaded_rows,
       'done' AS status FROM counts""")
def range_load_counts(spark, sf):
    """A range migration that stops after the first two ranges and goes on; rows per range at each step."""
    root, orders = fresh_folder(spark, "migrate"), table(spark, sf, "orders")
    plan = fixed_counts(spark, sf)
    args = (f"{root}/staged", f"{root}/log")
    migrate.export_ranges(spark, orders, "o_orderkey", plan.filter("range_id < 2"), *args, ORDERS_MARK)
    migrate.export_ranges(spark, orders, "o_orderkey", plan, *args, ORDERS_AS_OF)
    migrate.load_ranges(spark, f"{root}/staged", f"{root}/target", f"{root}/log", ORDERS_AS_OF)
    log = sink.read_log(spark, f"{root}/log", ranges.LOG_SCHEMA)
    exported = log.filter("phase = 'export'").select("range_id", F.col("rows").alias("exported_rows"))
    loaded = log.filter("phase = 'load'").select("range_id", F.col("rows").alias("loaded_rows"), "status")
    return plan.select("range_id", F.col("row_count").alias("expected_rows")).join(exported, "range_id").join(loaded, "range_id")


@query(f"""SELECT * FROM events WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 3 DAY AND ts < TIMESTAMP '{EVENTS_AS_OF}'
       AND event_id % 31 = 0""")
def late_catchup(spark, sf):
    """Rows of the last three days before the watermark that a target without every 31st row lacks."""
    events = table(spark, sf, "events")
    return late.late_rows(events, lossy(events, "event_id", 31), "event_id", "ts", EVENTS_AS_OF, 3)


@query(f"""SELECT *, TIMESTAMP '{EVENTS_AS_OF}' AS _loaded_at, CAST({SYSTEM} AS INTEGER) AS _source_system_id
FROM events WHERE ts <= TIMESTAMP '{EVENTS_AS_OF}'""")
def stream_ingest(spark, sf):
    """The stream run twice over the same folder: the second run finds nothing new."""
    root, schema = fresh_folder(spark, "stream"), table(spark, sf, "events").schema
    for _ in range(2):
        stream = ingest.file_stream(spark, sf, schema, "events.parquet")
        ingest.start_ingest(stream, f"{root}/events", f"{root}/checkpoint", Rules(pk="event_id", date="ts"),
                            lambda: EVENTS_AS_OF, SYSTEM).awaitTermination()
    return sink.read_accepted(spark, f"{root}/events").drop("_batch_id")


def _run_sync(spark, sf):
    """The control sheet's tables, one of which does not exist, loaded in one run."""
    root = fresh_folder(spark, "sync")
    meta = audit.MetaStore(spark, f"{root}/meta")
    meta.append("watermark", spark.createDataFrame(
        [("src.FactOrders->stg.FactOrders", ORDERS_MARK)], "table_name string, last_delta_value string").select(
        "*", *[F.lit(None).alias(c) for c in ("last_load_type", "last_delta_column", "last_max_id", "last_row_count")],
        F.lit("b_seed").alias("last_batch_id"), F.lit(ORDERS_MARK).alias("last_success_at"), F.lit(ORDERS_MARK).alias("updated_at")))

    def open_source(cfg):
        return scan.table(spark, f"{sf}/{SHEET_TABLES[cfg.source_table]}.parquet")
    run = sync.Run(ORDERS_AS_OF, "run_1", f"{root}/target", meta, clock=lambda: ORDERS_AS_OF)
    sync.sync_all(spark, sync.configs(read_control(sheet(spark))), open_source, run)
    return meta


@query(f"""
WITH o AS (SELECT count(*) AS r, count(*) FILTER (o_orderdate < TIMESTAMP '{ORDERS_AS_OF}') AS l FROM orders
           WHERE o_orderdate >= TIMESTAMP '{ORDERS_MARK}' AND o_orderdate <> TIMESTAMP '{ORDERS_AS_OF}'),
e AS (SELECT count(*) AS r FROM events WHERE ts >= TIMESTAMP '1998-12-25 00:00:00')
SELECT 'FactOrders' AS source_table, 'DELTA' AS load_type, r AS rows_read, l AS rows_loaded, r - l AS rows_rejected, true AS success FROM o
UNION ALL SELECT 'FactEvents', 'DELTA', r, 0, r, true FROM e
UNION ALL SELECT 'FactLineitem', 'FULL', count(*), count(*), 0, true FROM lineitem
UNION ALL SELECT 'DimCustomer', 'FULL', count(*), count(*), 0, true FROM customer
UNION ALL SELECT 'DimNation', 'FULL', count(*), count(*), 0, true FROM nation
UNION ALL SELECT 'FactGone', 'DELTA', 0, 0, 0, false""")
def sync_run(spark, sf):
    """Audit rows of a run over the control sheet: deltas from a watermark and from the look-back (all of
    whose rows lie in the future), full loads, and a table that is not there."""
    return _run_sync(spark, sf).read("load_stats").select(
        "source_table", "load_type", "rows_read", "rows_loaded", "rows_rejected", "success")


@query(f"""SELECT 'src.FactOrders->stg.FactOrders' AS table_name, '{ORDERS_AS_OF}' AS last_delta_value,
       (SELECT max(o_orderkey) FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_MARK}' AND o_orderdate < TIMESTAMP '{ORDERS_AS_OF}') AS last_max_id
UNION ALL SELECT 'src.FactLineitem->stg.FactLineitem', NULL, (SELECT max(l_orderkey) FROM lineitem)
UNION ALL SELECT 'src.DimCustomer->stg.DimCustomer', NULL, (SELECT max(c_custkey) FROM customer)
UNION ALL SELECT 'src.DimNation->stg.DimNation', NULL, NULL""")
def sync_watermarks(spark, sf):
    """Watermarks after the run; a table that loaded no row has none."""
    return _run_sync(spark, sf).watermarks().select("table_name", "last_delta_value", "last_max_id")


@query("SELECT doc_id, text, lang, source, n_chars, length(text) AS loaded_chars FROM documents")
def load_long_text(spark, sf):
    """Texts of any length come out of a load as they went in."""
    path, docs = fresh_folder(spark, "long_text"), table(spark, sf, "documents")
    rows = mark(stamp(clean_table(docs), BATCH, ORDERS_AS_OF, SYSTEM), Rules(pk="doc_id"), ORDERS_AS_OF)
    sink.write_batch(rows, path, BATCH)
    return sink.read_accepted(spark, path).select("doc_id", "text", "lang", "source", "n_chars",
                                                  F.length("text").cast("bigint").alias("loaded_chars"))


@query(f"""SELECT *, TIMESTAMP '{EVENTS_AS_OF}' AS _loaded_at, CAST({SYSTEM} AS INTEGER) AS _source_system_id
FROM events WHERE ts <= TIMESTAMP '{EVENTS_AS_OF}'""")
def stream_two_sources(spark, sf):
    """Two streams, even and odd events, into one target: neither replaces the other's rows."""
    root, events = fresh_folder(spark, "two_streams"), table(spark, sf, "events")
    for part in (0, 1):
        events.filter(F.col("event_id") % 2 == part).write.parquet(f"{root}/in{part}")
        stream = ingest.file_stream(spark, f"{root}/in{part}", events.schema)
        ingest.start_ingest(stream, f"{root}/events", f"{root}/checkpoint{part}", Rules(pk="event_id", date="ts"),
                            lambda: EVENTS_AS_OF, SYSTEM).awaitTermination()
    return sink.read_accepted(spark, f"{root}/events").drop("_batch_id")


_CLEANED = f"""SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN isfinite(o_totalprice) THEN round_even(o_totalprice, 10) END AS o_totalprice,
       CASE WHEN o_orderpriority NOT IN ('nan', 'None', 'NULL', 'null') THEN o_orderpriority END AS o_orderpriority FROM ({DIRTY_ORDERS_SQL})"""


@query(f"""WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM ({DIRTY_ORDERS_SQL}))
SELECT c.*, coalesce((o_orderkey - lo) // {FIXED}, -1)::INTEGER AS range_id FROM ({_CLEANED}) c, b""")
def migrate_clean(spark, sf):
    """Dirty orders, some without a key, exported in ranges and loaded with a declared schema: clean, and every row there."""
    root, dirty = fresh_folder(spark, "migrate_clean"), dirty_orders(spark, sf)
    plan = ranges.plan_fixed(dirty, "o_orderkey", FIXED)
    plan = plan.join(ranges.counts_by_range(dirty, "o_orderkey", plan), "range_id")
    migrate.export_ranges(spark, dirty, "o_orderkey", plan, f"{root}/staged", f"{root}/log", ORDERS_AS_OF)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    migrate.load_ranges(spark, f"{root}/staged", f"{root}/target", f"{root}/log", ORDERS_AS_OF, schema=schema)
    return spark.read.parquet(f"{root}/target")


@query(f"""SELECT o_orderkey, o_orderstatus, NULL AS o_channel FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, o_orderstatus, 'web' FROM orders WHERE o_orderkey % 2 = 1""")
def load_evolved(spark, sf):
    """Two batches, the second with one more column: the target shows it, NULL for the first."""
    path, orders = fresh_folder(spark, "evolved"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for part, batch in ((0, "b_first"), (1, "b_second")):
        rows = orders.filter(F.col("o_orderkey") % 2 == part)
        rows = rows.withColumn("o_channel", F.lit("web")) if part else rows
        sink.write_batch(mark(stamp(rows, batch, ORDERS_AS_OF, SYSTEM), Rules(pk="o_orderkey"), ORDERS_AS_OF), path, batch)
    return sink.read_accepted(spark, path, merge_schema=True).select("o_orderkey", "o_orderstatus", "o_channel")


@query(_FIXED_PLAN + """, n AS (SELECT count(*) AS n FROM orders WHERE o_orderkey % 50 = 0)
SELECT range_id, row_count AS expected_rows, 'done' AS export_status, 'done' AS load_status, row_count AS loaded_rows FROM counts WHERE range_id <> 1
UNION ALL SELECT range_id, row_count, 'failed', NULL, NULL FROM counts WHERE range_id = 1
UNION ALL SELECT -1, 0, 'done', 'done', n FROM n""")
def migrate_failed_export(spark, sf):
    """A source that lost rows of range 1 while it was exported, and gained rows without a key: range 1 is neither loaded
    nor done, so the run cannot be closed; the rows without a key are exported though the plan saw none."""
    root, orders = fresh_folder(spark, "failed_export"), table(spark, sf, "orders")
    low, high = (orders.agg(F.min("o_orderkey") + i * FIXED).first()[0] for i in (1, 2))
    keyless = orders.filter("o_orderkey % 50 = 0").withColumn("o_orderkey", F.lit(None).cast("bigint"))
    now = orders.filter(~F.col("o_orderkey").between(low + 5, high - 5)).unionByName(keyless)
    plan = ranges.plan_fixed(orders, "o_orderkey", FIXED)
    counts = ranges.counts_by_range(orders, "o_orderkey", plan)
    plan = stored(plan.join(counts, "range_id", "left").fillna(0, ["row_count"]), "plan")
    for _ in range(2):   # the second time changes nothing
        migrate.export_ranges(spark, now, "o_orderkey", plan, f"{root}/staged", f"{root}/log", ORDERS_MARK)
        migrate.load_ranges(spark, f"{root}/staged", f"{root}/target", f"{root}/log", ORDERS_AS_OF, plan=plan)
    log = sink.read_log(spark, f"{root}/log", ranges.LOG_SCHEMA)
    exported = log.filter("phase = 'export'").groupBy("range_id").agg(F.max("status").alias("export_status"))
    loaded = log.filter("phase = 'load'").select("range_id", F.col("status").alias("load_status"), F.col("rows").alias("loaded_rows"))
    return plan.select("range_id", F.col("row_count").alias("expected_rows")).join(exported, "range_id").join(loaded, "range_id", "left")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 40 = 0 THEN 'X' WHEN o_orderkey % 30 = 0 AND o_orderkey >= 3000 THEN 'Y' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 40 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""")
def upsert_load(spark, sf):
    """A target filled without the later orders, then changed: some orders twice in the updates, new ones, the same batch
    again, and a batch that falls into a few buckets."""
    root = fresh_folder(spark, "upsert")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    seq = orders.withColumn("seq", F.lit(1))
    upsert.upsert(seq.filter("o_orderkey < 9000"), root, ["o_orderkey"], "first", ORDERS_MARK, "seq", buckets=64)
    upsert.upsert(seq.filter("o_orderkey % 30 = 0 and o_orderkey >= 3000").withColumn("o_orderstatus", F.lit("Y")), root, ["o_orderkey"], "second", ORDERS_MARK, "seq")
    changed = seq.filter("o_orderkey % 40 = 0").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1, "seq": F.lit(2)})
    late = changed.unionByName(seq.filter("o_orderkey % 40 = 0")).unionByName(
        seq.filter("o_orderkey >= 9000 and o_orderkey % 40 <> 0 and o_orderkey % 30 <> 0"))
    for _ in range(2):
        upsert.upsert(late, root, ["o_orderkey"], "third", ORDERS_AS_OF, "seq")
    return upsert.read(spark, root).drop("seq")


@query("""SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS day, CAST(o_custkey AS BIGINT) AS who, CAST(round(o_totalprice)::BIGINT AS VARCHAR) || '.00' AS price,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status FROM orders WHERE o_orderkey % 2 = 1
UNION ALL SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), CAST(o_custkey AS BIGINT), CAST(round(o_totalprice)::BIGINT AS VARCHAR) || '.00', NULL
FROM orders WHERE o_orderkey % 2 = 0""")
def load_widened(spark, sf):
    """Two batches: date, int and decimal(12,0) first, then timestamp, bigint, decimal(14,2) and one more column; the first
    is read in the second's types."""
    path, orders = fresh_folder(spark, "widened"), table(spark, sf, "orders")
    whole = F.floor(F.col("o_totalprice") + 0.5)
    first = orders.filter("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
                                                       F.col("o_custkey").cast("int").alias("who"), whole.cast("decimal(12,0)").alias("price"))
    second = orders.filter("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_orderdate").alias("day"), F.col("o_custkey").cast("bigint").alias("who"),
                                                        whole.cast("decimal(14,2)").alias("price"), F.col("o_orderstatus").alias("status"))
    for rows, batch, at in ((first, "b_first", ORDERS_MARK), (second, "b_second", ORDERS_AS_OF)):
        widen.write_widening(mark(stamp(rows, batch, at, SYSTEM), Rules(pk="o_orderkey"), at), path, batch, at)
    return plain(widen.read_widened(spark, path).select("o_orderkey", "day", "who", "price", "status"))


@query("SELECT * FROM events")
def stream_late(spark, sf):
    """Events that arrive in parts of a week and a day: a fifth one part late, a seventh once more with the part after. The stream
    drops repeats with ten days of state, is stopped half way and started again; what came too late for its
    state is found by a catch-up, twice, and every event is there once."""
    root, events = fresh_folder(spark, "stream_late"), table(spark, sf, "events")
    first = events.agg(F.min(F.unix_date(F.col("ts").cast("date")))).first()[0]
    part = F.expr(f"(unix_date(cast(ts as date)) - {first or 0}) div 8") + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    arriving = events.withColumn("_part", part)
    again = arriving.filter("event_id % 7 = 0").withColumn("_part", F.col("_part") + 1)
    arriving = stored(arriving.unionByName(again), "arriving")
    parts = sorted(r["_part"] for r in arriving.select("_part").distinct().collect())
    files = spark.sparkContext.defaultParallelism   # per part, so that all cores write a part and read it as one micro-batch
    for some in (parts[:len(parts) // 2], parts[len(parts) // 2:]):
        for p in some:
            arriving.filter(F.col("_part") == p).drop("_part").repartition(files).write.parquet(f"{root}/in/part{p}")
        stream = late.drop_repeats(ingest.file_stream(spark, f"{root}/in/*", events.schema, max_files=files), "event_id", "ts", "10 days")
        ingest.start_ingest(stream, f"{root}/events", f"{root}/checkpoint", Rules(pk="event_id"), lambda: EVENTS_AS_OF, SYSTEM).awaitTermination()
    for n in (1, 2):
        missed = late.late_rows(spark.read.parquet(f"{root}/in/*"), sink.read_accepted(spark, f"{root}/events"), "event_id", "ts",
                                "2100-01-01 00:00:00", 365 * 100).dropDuplicates(["event_id"])
        batch = f"late_{n}"
        sink.write_batch(mark(stamp(missed, batch, EVENTS_AS_OF, SYSTEM), Rules(pk="event_id"), EVENTS_AS_OF), f"{root}/events", batch)
    return sink.read_accepted(spark, f"{root}/events").select(*events.columns)
