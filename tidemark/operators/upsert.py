"""Upsert of a large target: rows by key over buckets, of which only the touched ones are written again.

A target is a folder of versions and a log. A version holds whole buckets, `_version=.../_bucket=...`; the log says, per
bucket, which version is current. An upsert reads the buckets that its rows fall into, replaces or adds the rows, writes
these buckets under a version of its own, and then adds one entry to the log, which makes all of them current at once.
Buckets that no row falls into keep their files. Readers see the state of before or of after.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.columns import ntz
from tidemark.functions.digests import row_hash
from tidemark.operators import sink
from tidemark.operators.stamp import check_batch_id

BUCKETS = 1_024
LOG_SCHEMA = "version string, bucket int, buckets int, number bigint, committed_at timestamp_ntz"
_BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A NULL key has a bucket, too; whole numbers of different width have the same one."""
    return F.pmod(F.hash(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _log(spark: SparkSession, root: str) -> DataFrame:
    return sink.read_log(spark, f"{root}/_log", LOG_SCHEMA)


def current_buckets(spark: SparkSession, root: str) -> list:
    """(bucket, version, buckets) of the target as it is: a row per bucket that holds rows."""
    newest = F.max(F.struct("number", "version", "buckets")).alias("n")
    return _log(spark, root).groupBy("bucket").agg(newest).select("bucket", "n.version", "n.buckets").collect()


def _read(spark: SparkSession, root: str, found: list) -> DataFrame | None:
    paths = [f"{root}/_version={r.version}/{_BUCKET}={r.bucket}" for r in found]
    paths = [p for p in paths if sink.path_exists(spark, p)]   # a bucket may have lost all its rows
    return spark.read.option("mergeSchema", "true").option("basePath", root).parquet(*paths).drop("_version", _BUCKET) if paths else None


def read(spark: SparkSession, root: str) -> DataFrame | None:
    """The target's rows, or None before the first upsert."""
    return _read(spark, root, current_buckets(spark, root))


def newest_per_key(rows: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the one with the greatest `order`, NULL last; of equals, by a hash of the row."""
    by = [F.desc_nulls_last(order)] if order else []
    w = Window.partitionBy(*keys).orderBy(*by, row_hash(rows.columns))
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(updates: DataFrame, root: str, keys: Sequence[str], batch_id: str, committed_at: str | dt.datetime,
           order: str | None = None, buckets: int = BUCKETS, rows_per_file: int = sink.ROWS_PER_FILE) -> list[int]:
    """Bring the target up to date with `updates`; returns the buckets that were written.

    Rows of the target whose key is among the updates are replaced, other updates are added; NULL keys are equal to
    each other. Of several updates of a key the newest by `order` counts. A batch that is in the log already changes
    nothing. A batch that died before its entry is written again under the same version. `buckets` counts for a new
    target only; one that exists keeps its own. Columns that only one side has are NULL on the other.
    """
    spark = updates.sparkSession
    log = _log(spark, root)
    if not log.filter(F.col("version") == check_batch_id(batch_id)).isEmpty():
        return []
    found = current_buckets(spark, root)
    n = found[0].buckets if found else buckets
    new = newest_per_key(updates, keys, order).withColumn(_BUCKET, bucket_of(keys, n))
    touched = {r[_BUCKET] for r in new.select(_BUCKET).distinct().collect()}   # at most a row per bucket
    if not touched:
        return []
    old = _read(spark, root, [r for r in found if r.bucket in touched])
    rows = new
    if old is not None:
        same = F.lit(True)
        named = new.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
        for i, k in enumerate(keys):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}"))
        kept = old.join(named, same, "left_anti").withColumn(_BUCKET, bucket_of(keys, n))
        rows = kept.unionByName(new, allowMissingColumns=True)
    (rows.hint("rebalance", _BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option("maxRecordsPerFile", rows_per_file).partitionBy(_BUCKET).parquet(f"{root}/_version={batch_id}"))
    number = log.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    entry = spark.createDataFrame([(batch_id, b, n, number) for b in sorted(touched)], "version string, bucket int, buckets int, number bigint")
    sink.append_log(entry.withColumn("committed_at", ntz(committed_at)), f"{root}/_log")
    return sorted(touched)


def expire(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of buckets that are no longer current, for when no reader is left on them. Returns them."""
    current = {(r.version, r.bucket) for r in current_buckets(spark, root)}
    old = [f"{root}/_version={r.version}/{_BUCKET}={r.bucket}" for r in _log(spark, root).select("version", "bucket").distinct().collect()
           if (r.version, r.bucket) not in current]
    gone = [p for p in old if sink.path_exists(spark, p)]
    for p in gone:
        sink.delete(spark, p)
    return gone
