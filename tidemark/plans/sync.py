"""Load tables as the control table says: scan, clean, validate, stamp, write, check, record."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tidemark.operators import quality, sink, watermark, widen
from tidemark.operators.clean import clean_table
from tidemark.operators.stamp import stamp
from tidemark.operators.validate import Rules, mark
from tidemark.plans.audit import MetaStore, audit_row, quality_rows
from tidemark.session import one_row
from tidemark.sources import scan


def utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


@dataclass(frozen=True)
class TableConfig:
    source_schema: str
    source_table: str
    target_schema: str
    target_table: str
    load_type: str = "FULL"
    date_column: str | None = None
    pk_column: str | None = None

    @property
    def name(self) -> str:
        return f"{self.source_schema}.{self.source_table}"

    @property
    def key(self) -> str:
        """What watermark, batch and result go by: one source may feed several targets."""
        return f"{self.name}->{self.target_schema}.{self.target_table}"


@dataclass(frozen=True)
class Run:
    """What holds for all tables of one run."""

    as_of: str
    run_id: str
    target_root: str
    meta: MetaStore
    job_name: str = "sync"
    trigger_type: str = "manual"
    source_system_id: int = 1
    source_system_name: str | None = None
    lookback_days: int = watermark.LOOKBACK_DAYS
    tolerance: float = quality.COUNT_TOLERANCE
    max_text: int | None = None       # cut text to so many characters; None keeps it whole
    block_on_mismatch: bool = False   # leave the watermark where it is when the row counts disagree
    keep_versions: int | None = None  # of a full load: how many versions stay; None keeps all
    orphans_after_hours: int = 48     # unpublished versions older than this go with them
    compact_after: int = 500          # log entries after which a run puts a log in one file
    clock: Callable[[], str] = utc_now


@dataclass
class Loaded:
    """What one table's load did."""

    start: str | None = None
    read: int = 0
    loaded: int = 0
    rejected: int = 0
    files: int = 0
    max_id: int | None = None
    error: str | None = None


def configs(control: DataFrame) -> list[TableConfig]:
    """Table settings from an enabled control table (see plans.control.read_control); one small row each."""
    names = list(TableConfig.__dataclass_fields__)
    return [TableConfig(**r.asDict()) for r in control.select(*names).collect()]


def batch_id(table: str, load_type: str, token: str) -> str:
    """A name for the load that a repeat of the same load gets again, so that it replaces its own rows."""
    return "b" + hashlib.sha256("|".join([table, load_type, token]).encode()).hexdigest()[:24]


def prepare(df: DataFrame, cfg: TableConfig, as_of: str, batch: str, source_system_id: int,
            max_text: int | None = None) -> DataFrame:
    """Clean, stamp and mark: one lazy projection over the scan."""
    rules = Rules(pk=cfg.pk_column, date=cfg.date_column, max_text=max_text)
    return mark(stamp(clean_table(df), batch, as_of, source_system_id), rules, as_of)


def delta_window(spark: SparkSession, cfg: TableConfig, run: Run, marks: DataFrame | None = None) -> Row:
    """Start of the delta window, and whether it is the table's first. Collects one row. marks: the run's watermarks, if
    they have been read."""
    control = one_row(spark, table_name=F.lit(cfg.key), load_type=F.lit(cfg.load_type))
    marks = (run.meta.watermarks() if marks is None else marks).filter(F.col("table_name") == cfg.key)
    return watermark.start_plan(control, marks, run.as_of, run.lookback_days).select(
        F.col("delta_start").cast("string").alias("start"), "first_run").first()


def _target(run: Run, cfg: TableConfig) -> str:
    return f"{run.target_root}/{cfg.target_schema}/{cfg.target_table}"


def read_target(spark: SparkSession, run: Run, cfg: TableConfig) -> DataFrame | None:
    """The target's accepted rows, or None before the first load."""
    path = _target(run, cfg)
    if cfg.load_type == "FULL":
        path = sink.current_path(spark, f"{run.target_root}/{cfg.target_schema}", cfg.target_table)
    if not path or not sink.has_data(spark, path):
        return None
    widened = widen.read_widened(spark, path) if cfg.load_type == "DELTA" else None
    return sink.read_accepted(spark, path, merge_schema=True) if widened is None else widened


def _load(spark: SparkSession, source: DataFrame, cfg: TableConfig, run: Run, out: Loaded, marks: DataFrame | None) -> None:
    schema_root = f"{run.target_root}/{cfg.target_schema}"
    if cfg.load_type == "DELTA":
        win = delta_window(spark, cfg, run, marks)
        out.start = win.start
        rows = scan.open_window(source, cfg.date_column, win.start, run.as_of)
        # Named by the watermark it starts from, not by the clock: a run that died before it moved the
        # watermark is repeated under the same name, even if the repeat ends later.
        batch, path = batch_id(cfg.key, "DELTA", "first" if win.first_run else win.start), _target(run, cfg)
    else:
        rows = source
        # Named by run and clock as well: a repeat must not write into the version that readers hold.
        batch = batch_id(cfg.key, "FULL", f"{run.as_of}|{run.run_id}|{run.clock()}|{uuid.uuid4().hex}")
        path = sink.version_path(schema_root, cfg.target_table, batch)

    prepared = prepare(rows, cfg, run.as_of, batch, run.source_system_id, run.max_text)
    if cfg.load_type == "DELTA":
        written = widen.write_widening(prepared, path, batch, run.as_of, gather=True, pk=cfg.pk_column)
    else:
        written = sink.write_batch(prepared, path, batch, pk=cfg.pk_column)
    for r in written.collect():
        if r.status == "accepted":
            out.loaded += r.rows
            out.max_id = None if r.max_id is None else max(r.max_id, 0)
        else:
            out.rejected += r.rows
    out.read, out.files = out.loaded + out.rejected, sink.batch_files(spark, path, batch)
    if out.loaded == 0:
        return   # success, but neither target version nor watermark moves

    source_count = rows.count()
    run.meta.append("data_quality", quality_rows(count_checks(spark, source_count, cfg, run, out), run.run_id, run.as_of))
    missing = abs(source_count - out.rejected - out.loaded)
    if run.block_on_mismatch and missing > run.tolerance * max(source_count - out.rejected, 0):
        return   # neither published nor marked
    if cfg.load_type == "FULL":
        sink.publish_version(spark, schema_root, cfg.target_table, batch, run.as_of)
        if run.keep_versions is not None:
            old = dt.datetime.fromisoformat(run.as_of) - dt.timedelta(hours=run.orphans_after_hours)
            sink.expire_versions(spark, schema_root, cfg.target_table, run.keep_versions, old)
    run.meta.append("watermark", one_row(
        spark, table_name=F.lit(cfg.key), last_load_type=F.lit(cfg.load_type), last_delta_column=F.lit(cfg.date_column),
        last_delta_value=F.lit(run.as_of if cfg.load_type == "DELTA" else None), last_max_id=F.lit(out.max_id),
        last_row_count=F.lit(out.loaded), last_batch_id=F.lit(batch), last_success_at=F.lit(run.as_of), updated_at=F.lit(run.as_of)))


def count_checks(spark: SparkSession, source_count: int, cfg: TableConfig, run: Run, out: Loaded) -> DataFrame:
    """Source count against target count, as they are and with the rejected rows taken off the source."""
    def big(n: int):
        return F.lit(n).cast("bigint")
    checks = [quality.row_count_row("ROW_COUNT", big(source_count), big(out.loaded), run.tolerance),
              quality.row_count_row("ROW_COUNT_ADJUSTED", big(source_count - out.rejected), big(out.loaded), run.tolerance)]
    return one_row(spark, table_name=F.lit(cfg.name)).select("table_name", F.inline(F.array(*checks)))


def sync_table(spark: SparkSession, open_source: Callable[[TableConfig], DataFrame], cfg: TableConfig, run: Run,
               marks: DataFrame | None = None) -> Loaded:
    """Load one table and write its audit row, also if the source cannot be opened or the load fails."""
    out, started = Loaded(), run.clock()
    try:
        _load(spark, open_source(cfg), cfg, run, out, marks)
    except Exception as e:   # the audit row must say why, and the other tables go on
        out.error = str(e) or type(e).__name__
    counts = one_row(spark, rows_read=F.lit(out.read), rows_loaded=F.lit(out.loaded), rows_rejected=F.lit(out.rejected),
                     chunks_processed=F.lit(out.files))
    run.meta.append("load_stats", audit_row(
        counts, run_id=run.run_id, pipeline_name=run.job_name, trigger_type=run.trigger_type,
        source_system_id=run.source_system_id, source_system_name=run.source_system_name,
        run_started=started, run_ended=run.clock(), source_schema=cfg.source_schema, source_table=cfg.source_table,
        target_schema=cfg.target_schema, target_table=cfg.target_table, load_type=cfg.load_type,
        delta_column=cfg.date_column, delta_start_value=out.start,
        delta_end_value=run.as_of if out.start else None, success=out.error is None, error_message=out.error))
    return out


def sync_all(spark: SparkSession, tables: Iterable[TableConfig], open_source: Callable[[TableConfig], DataFrame],
             run: Run, parallel: int = 4) -> dict[str, Loaded]:
    """Results by TableConfig.key. Load several tables, `parallel` at a time, so that small tables fill the gaps that big ones leave."""
    def one(cfg: TableConfig) -> Loaded:
        # A scheduler pool per table: within one pool a big table's tasks would go before a small one's.
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", cfg.name)
        return sync_table(spark, open_source, cfg, run, marks)

    tables = list(tables)
    # read once for the run, a row per table
    marks = spark.createDataFrame(run.meta.watermarks().collect(), watermark.WATERMARK_SCHEMA)
    with ThreadPoolExecutor(max_workers=parallel) as workers:
        done = dict(zip([t.key for t in tables], workers.map(one, tables)))
    run.meta.compact(run.compact_after)
    return done
