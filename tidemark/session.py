"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

# Correctness settings (time zone, ANSI) plus the adaptive features the write paths rely on:
# `rebalance` hints are only honoured, and skewed joins only split, when AQE is on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Tables loaded at the same time share the cluster instead of queueing; see plans.sync.sync_all.
    "spark.scheduler.mode": "FAIR",
    # Keep a writer open per output partition instead of sorting every task's rows by it.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written below the work root and read back, so that nothing computes it again."""
    path = f"{work_root(df.sparkSession)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row(spark: SparkSession, **columns: Column) -> DataFrame:
    """A single row of constants."""
    return spark.sql("SELECT 1").select(*[c.alias(name) for name, c in columns.items()])


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only a local session, where there is one machine, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root
