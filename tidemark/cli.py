"""Command line, for spark-submit:

    spark-submit tidemark/cli.py sync --control control.csv --source /dwh --target /stage --meta /meta
    spark-submit tidemark/cli.py migrate --source /dwh/FactX --key FactXID --staged /staged/X --target /stage/X --log /meta/x_ranges
    spark-submit tidemark/cli.py check --source /dwh/FactX --target /stage/X --table FactX --key FactXID --not-null A,B --numeric C
    spark-submit tidemark/cli.py monitor --meta /meta
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from tidemark.operators import quality, ranges, sink  # noqa: E402
from tidemark.plans import audit, control, migrate, monitoring, sync  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources import scan  # noqa: E402


def _read_sheet(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    return spark.read.json(path) if path.endswith(".json") else spark.read.parquet(path)


def cmd_sync(spark: SparkSession, a: argparse.Namespace) -> int:
    meta = audit.MetaStore(spark, a.meta)
    system = meta.read("source_systems").filter(F.col("source_system_id") == a.system).orderBy(F.desc("created_at")).first()
    run = sync.Run(a.as_of, a.run_id or f"run {a.as_of}", a.target, meta, trigger_type=a.trigger,
                   source_system_id=a.system, block_on_mismatch=a.block_on_mismatch, max_text=a.max_text,
                   source_system_name=system.source_system_name if system else None)

    def open_source(cfg: sync.TableConfig) -> DataFrame:
        if a.source.startswith("jdbc:"):
            return scan.database_table(spark, a.source, cfg.name, cfg.pk_column, a.database_partitions, slice_by=a.slice_by)
        return scan.table(spark, f"{a.source}/{cfg.source_schema}/{cfg.source_table}")
    tables = sync.configs(control.read_control(_read_sheet(spark, a.control)))
    done = sync.sync_all(spark, tables, open_source, run, a.parallel)
    stats = meta.read("load_stats").filter(F.col("run_id") == run.run_id)
    monitoring.latest_runs(stats).show(len(tables), truncate=False)
    print("Alerts")
    for row in monitoring.alerts(stats, meta.read("data_quality").filter(F.col("run_id") == run.run_id)).toLocalIterator():
        print(*row, sep=" | ")
    return 1 if any(d.error for d in done.values()) else 0


def cmd_migrate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Export and load all pending ranges.

    The plan is kept beside the log, so that a start after a stop goes on with it; a start with
    nothing done yet, or after a run that ended well, makes a new one.
    """
    if a.source.startswith("jdbc:"):
        source = scan.database_table(spark, a.source, a.table, a.key, a.database_partitions, slice_by=a.slice_by)
    else:
        source = scan.table(spark, a.source)
    plan_path = f"{a.log}_plan"
    started = ranges.done_entries(sink.read_log(spark, a.log, ranges.LOG_SCHEMA), "export").limit(1).count()
    if not started:
        top = migrate.snapshot(source, a.key).first().snapshot_max_id
        if top is None and source.isEmpty():
            print("0 ranges left; the source is empty")
            return 0
        top = 0 if top is None else top
        inside = migrate.within_snapshot(source, a.key, top)
        ranges.plan_ranges(inside, a.key, a.target_rows).selectExpr(
            "*", f"{top}L as snapshot_max_id").write.mode("overwrite").parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    inside = migrate.within_snapshot(source, a.key, plan.first().snapshot_max_id)
    migrate.export_ranges(spark, inside, a.key, plan.drop("snapshot_max_id"), a.staged, a.log, sync.utc_now(),
                          ranges_per_job=a.ranges_per_job)
    migrate.load_ranges(spark, a.staged, a.target, a.log, sync.utc_now(), schema=a.schema, plan=plan.drop("snapshot_max_id"))
    left = migrate.unfinished(plan, sink.read_log(spark, a.log, ranges.LOG_SCHEMA))
    print(f"{left} ranges left; rows after id {plan.first().snapshot_max_id} come with the next delta")
    if left == 0:
        for phase in ("export", "load"):
            migrate.close(spark, a.log, phase, sync.utc_now())
    return 1 if left else 0


def cmd_check(spark: SparkSession, a: argparse.Namespace) -> int:
    checks = quality.all_checks(scan.table(spark, a.source), scan.table(spark, a.target), a.table, a.key,
                                a.not_null, a.numeric).cache()
    for row in checks.toLocalIterator():   # every row, however many columns were asked for
        print(*row, sep=" | ")
    if a.meta:
        audit.MetaStore(spark, a.meta).append("data_quality", audit.quality_rows(checks, f"check {a.as_of}", a.as_of))
    return 1 if checks.filter("not is_valid").count() else 0


def cmd_monitor(spark: SparkSession, a: argparse.Namespace) -> int:
    meta = audit.MetaStore(spark, a.meta)
    stats, checks = meta.read("load_stats"), meta.read("data_quality")
    for title, df in (("Latest runs", monitoring.latest_runs(stats)), ("Daily summary", monitoring.daily_summary(stats)),
                      ("Quality issues", monitoring.quality_issues(checks, stats)),
                      ("30-day trend", monitoring.trend(stats, a.as_of)), ("Failed runs", monitoring.failed_runs(stats)),
                      ("By trigger, 7 days", monitoring.by_trigger(stats, a.as_of)), ("Watermarks", meta.watermarks())):
        n = df.count()
        print(title if n <= a.rows else f"{title}: {a.rows} of {n} rows, more with --rows")
        df.show(a.rows, truncate=False)
    return 0


def parser() -> argparse.ArgumentParser:
    def names(text: str) -> list[str]:
        return [t for t in text.split(",") if t]
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True)
    commands = {name: sub.add_parser(name) for name in ("sync", "migrate", "check", "monitor")}
    for c in commands.values():
        c.add_argument("--as-of", default=sync.utc_now()[:19], help="UTC time the run counts as, yyyy-mm-dd hh:mm:ss")
    s = commands["sync"]
    for name in ("--control", "--source", "--target", "--meta"):
        s.add_argument(name, required=True)
    s.add_argument("--run-id")
    s.add_argument("--trigger", default="manual", choices=("manual", "scheduled", "event-based"))
    s.add_argument("--system", type=int, default=1)
    s.add_argument("--parallel", type=int, default=4)
    s.add_argument("--block-on-mismatch", action="store_true")
    s.add_argument("--max-text", type=int, help="cut text to so many characters; by default it stays whole")
    s.add_argument("--database-partitions", type=int, default=64, help="tasks that read a table of a jdbc: source")
    s.add_argument("--slice-by", help="SQL of a whole number per row, by which a hot key of a jdbc: source is cut")
    m = commands["migrate"]
    for name in ("--source", "--key", "--staged", "--target", "--log"):
        m.add_argument(name, required=True)
    m.add_argument("--target-rows", type=int, default=50_000_000)
    m.add_argument("--schema", help="declared columns of the target, as DDL; what does not fit becomes NULL")
    m.add_argument("--database-partitions", type=int, default=64, help="tasks that read a jdbc: source, given with --table")
    m.add_argument("--table", help="table of a jdbc: source")
    m.add_argument("--slice-by", help="SQL of a whole number per row, by which a hot key of a jdbc: source is cut")
    m.add_argument("--ranges-per-job", type=int, help="export in several jobs; for tables that lie in key order")
    c = commands["check"]
    for name in ("--source", "--target", "--table", "--key"):
        c.add_argument(name, required=True)
    c.add_argument("--not-null", type=names, default=[])
    c.add_argument("--numeric", type=names, default=[])
    c.add_argument("--meta")
    commands["monitor"].add_argument("--meta", required=True)
    commands["monitor"].add_argument("--rows", type=int, default=50, help="rows to print of each view")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    return globals()[f"cmd_{a.command}"](spark or build_session(), a)


if __name__ == "__main__":
    sys.exit(main())
