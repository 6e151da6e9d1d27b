"""Writes that can be repeated.

A table's folder holds `_load_status=accepted|rejected`, then `_batch_id=...`. Accepted and
rejected rows leave in the same job, so the source is read once, and both are replaced together
when a batch runs again.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.casts import cast_or_null
from tidemark.functions.columns import ntz
from tidemark.operators.stamp import check_batch_id
from tidemark.operators.validate import REASON
from tidemark.session import one_row

STATUS = "_load_status"
VERSION_LOG_SCHEMA = "table_name string, version string, committed_at timestamp_ntz, number bigint"

# Fixed values
ROWS_PER_FILE = 500_000
ROWS_PER_RANGE_FILE = 250_000


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath)


def _files(spark: SparkSession, folder: str) -> set[str]:
    """Names of data files and partition folders, as Spark itself picks them."""
    fs, jpath = _hadoop(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []
    return {n for n in names if "=" in n or not n.startswith(("_", "."))}   # partition folders may start with _


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop(spark, path)
    fs.delete(jpath, True)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether there is a table; what a write that never finished left behind does not count."""
    return bool(_files(spark, path))


def _folders(path: str, batch_id: str) -> list[str]:
    return [f"{path}/{STATUS}={status}/_batch_id={batch_id}" for status in ("accepted", "rejected")]


def write_batch(marked: DataFrame, path: str, batch_id: str, rows_per_file: int = ROWS_PER_FILE,
                gather: bool = False, pk: str | None = None) -> DataFrame:
    """Append a stamped and marked batch, replacing whatever the same batch id left before.

    With `gather` the rows are rebalanced first. A delta needs this: the few rows that a big scan
    leaves would otherwise go out as one small file per task. A full load does not shuffle.

    Dynamic overwrite leaves alone a partition that gets no rows. If an earlier try of this batch
    filled one that this try leaves empty, its old files are still there afterwards, and it is cleared.
    Returns what the batch now holds, see `batch_counts`.
    """
    spark = marked.sparkSession
    before = {f: _files(spark, f) for f in _folders(path, check_batch_id(batch_id))}
    split = marked.withColumn(STATUS, F.when(F.col(REASON).isNull(), "accepted").otherwise("rejected"))
    rows = split.hint("rebalance", STATUS) if gather else split
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", rows_per_file).partitionBy(STATUS, "_batch_id").parquet(path))
    for folder, old in before.items():
        if old & _files(spark, folder):
            marked.drop("_batch_id").limit(0).write.mode("overwrite").parquet(folder)
    return batch_counts(spark, path, batch_id, marked.drop("_batch_id").schema, pk)


def batch_counts(spark: SparkSession, path: str, batch_id: str, schema: T.StructType, pk: str | None = None) -> DataFrame:
    """(status, reason, rows, max_id) of a written batch; only its own folders are listed and two columns read.

    Counted from the committed files, not with a counter that rides along the write: a task that
    runs twice after a lost executor would count its rows twice.
    """
    there = [f for f in _folders(path, batch_id) if path_exists(spark, f)]
    if not there:
        return spark.createDataFrame([], "status string, reason string, rows bigint, max_id bigint")
    ids = cast_or_null(F.col(pk), schema[pk].dataType, "bigint") if pk in schema.names else F.lit(None).cast("bigint")
    return (spark.read.schema(schema).option("basePath", path).parquet(*there)
            .groupBy(F.col(STATUS).alias("status"), F.col(REASON).alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows"), F.max(ids).alias("max_id")))


def batch_files(spark: SparkSession, path: str, batch_id: str) -> int:
    return sum(len(_files(spark, f)) for f in _folders(path, batch_id))


def accepted_only(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(STATUS) == "accepted").drop(STATUS, REASON)


def read_accepted(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """The target's rows. `merge_schema` opens all file footers, for a target that gained columns on the way."""
    return accepted_only(spark.read.option("mergeSchema", merge_schema).parquet(path))


def read_rejected(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path).filter(F.col(STATUS) == "rejected").drop(STATUS)


def append_log(rows: DataFrame, path: str) -> None:
    """Add rows to a log table, one file in a folder of its own per append.

    Appends to one folder at the same time, from threads or from other runs, would clear each other's
    staging files.
    """
    rows.coalesce(1).write.parquet(f"{path}/{uuid.uuid4().hex}")


_CHECKPOINTS = "_checkpoints"   # below a log; readers that list all files of the log do not see it


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def _entries(spark: SparkSession, path: str) -> list[str]:
    """Folders of single appends."""
    return [n for n in _children(spark, path) if not n.startswith(("_", "."))]


def _checkpoint(spark: SparkSession, path: str) -> tuple[str | None, set[str]]:
    """Folder of the newest complete checkpoint of a log, and the appends that it holds."""
    root = f"{path}/{_CHECKPOINTS}"
    done = [n.removesuffix(".done") for n in _children(spark, root) if n.endswith(".done")]
    if not done:
        return None, set()
    covers = spark.read.text(f"{root}/{done[-1]}.done").collect()
    return f"{root}/{done[-1]}", {r.value for r in covers}


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log table, or no rows while nothing has been written: the newest checkpoint and the appends it does not hold."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    folder, held = _checkpoint(spark, path)
    if folder is None:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    later = [f"{path}/{n}" for n in _entries(spark, path) if n not in held]
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/rows", *later)


def compact_log(spark: SparkSession, path: str, schema: str, at_least: int = 1) -> int:
    """Put all appends so far into one checkpoint, if there are `at_least` outside of the last one. Returns how many were.

    First the rows are written, then a list of the appends they come from, under a hidden name, and renamed (one step on
    HDFS and local disks): from that moment readers take the checkpoint instead of these appends. A crash before leaves the log as it was. Appends that
    come meanwhile are not on the list and are read beside it. What the checkpoint before this one held is deleted
    only now, so a reader that began before the rename still finds its files.
    """
    before, held = _checkpoint(spark, path)
    names = _entries(spark, path)
    fresh = [n for n in names if n not in held and has_data(spark, f"{path}/{n}")]   # others are still being written
    if len(fresh) < max(1, at_least):
        return 0
    root = f"{path}/{_CHECKPOINTS}"
    number = 1 + max([int(n.split("-")[0]) for n in _children(spark, root) if n[:1].isdigit()], default=0)
    name = f"{number:012d}-{uuid.uuid4().hex}"
    sources = [*([f"{before}/rows"] if before else []), *[f"{path}/{n}" for n in fresh]]
    spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*sources).coalesce(1).write.parquet(f"{root}/{name}/rows")
    # what is deleted below need not be listed, as it is gone
    listed = sorted(set(fresh) | (held & set(names)))
    spark.createDataFrame([(n,) for n in listed], "value string").coalesce(1).write.text(f"{root}/{name}/_held")
    fs, done = _hadoop(spark, f"{root}/{name}.done")
    fs.rename(_hadoop(spark, f"{root}/{name}/_held")[1], done)
    for n in held & set(names):
        delete(spark, f"{path}/{n}")
    for n in _children(spark, root):   # checkpoints before the last one
        if n[:1].isdigit() and before and n.removesuffix(".done") < before.rsplit("/", 1)[1]:
            delete(spark, f"{root}/{n}")
    return len(fresh)


def version_path(root: str, table: str, version: str) -> str:
    return f"{root}/{table}/version={version}"


def publish_version(spark: SparkSession, root: str, table: str, version: str, committed_at: str | dt.datetime) -> None:
    """Make a complete version the current one, by adding a row to the version log. Of versions committed at the same
    time the one published last is current; `number` says which that is."""
    before = read_log(spark, f"{root}/_versions", VERSION_LOG_SCHEMA).filter(F.col("table_name") == table).count()
    row = one_row(spark, table_name=F.lit(table), version=F.lit(version), committed_at=ntz(committed_at),
                  number=F.lit(before).cast("bigint"))
    append_log(row, f"{root}/_versions")


def current_version(spark: SparkSession, root: str, table: str) -> str | None:
    row = (read_log(spark, f"{root}/_versions", VERSION_LOG_SCHEMA).filter(F.col("table_name") == table)
           .orderBy(F.desc("committed_at"), F.desc("number"), F.desc("version")).limit(1).collect())
    return row[0].version if row else None


def current_path(spark: SparkSession, root: str, table: str) -> str | None:
    version = current_version(spark, root, table)
    return version_path(root, table, version) if version else None


def replace_table(marked: DataFrame, root: str, table: str, batch_id: str, committed_at: str | dt.datetime,
                  rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Full load: write a new version beside the old one, then switch to it.

    Readers keep the old version until the new one is complete, and a failed write changes nothing.
    """
    path = version_path(root, table, check_batch_id(batch_id))
    counts = write_batch(marked, path, batch_id, rows_per_file)
    publish_version(marked.sparkSession, root, table, batch_id, committed_at)
    return counts


def expire_versions(spark: SparkSession, root: str, table: str, keep: int = 2, orphans_before: str | dt.datetime | None = None) -> list[str]:
    """Delete published versions older than the newest `keep`, and versions that were never published (blocked by a
    check, or cut off) whose folders were last changed before `orphans_before` (UTC). Returns their names."""
    log = read_log(spark, f"{root}/_versions", VERSION_LOG_SCHEMA).filter(F.col("table_name") == table)
    names = log.groupBy("version").agg(F.max("committed_at").alias("at"), F.max("number").alias("n")).orderBy(
        F.desc("at"), F.desc("n"), F.desc("version"))
    old = [r.version for r in names.collect()[max(keep, 1):] if path_exists(spark, version_path(root, table, r.version))]
    published = {r.version for r in log.select("version").distinct().collect()}
    fs, jpath = _hadoop(spark, f"{root}/{table}")
    for status in fs.listStatus(jpath) if orphans_before and fs.exists(jpath) else []:
        name = status.getPath().getName().removeprefix("version=")
        if name not in published and status.getPath().getName() != name and status.getModificationTime() < _millis(orphans_before):
            old.append(name)
    for version in old:
        delete(spark, version_path(root, table, version))
    return old


def _millis(at: str | dt.datetime) -> int:
    at = dt.datetime.fromisoformat(at) if isinstance(at, str) else at
    return int((at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)).timestamp() * 1000)


def write_ranges(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_RANGE_FILE, gather: bool = True,
                 fresh: bool = False) -> None:
    """Write rows with a `range_id`, one folder per range, replacing the ranges that are written, or with
    `fresh` everything that is there.

    The rebalance hint gathers each range into few files and lets Spark split a range with many rows
    over several tasks, by the sizes it measured. Rows that lie by range already need no `gather`.
    """
    rows = df.hint("rebalance", "range_id") if gather else df
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static" if fresh else "dynamic")
     .option("maxRecordsPerFile", rows_per_file).partitionBy("range_id").parquet(path))
