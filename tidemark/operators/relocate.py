"""Move a table, and give up the old copy only once the counts agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.sink import has_data


def verdict(source: Column, target: Column, moved: Column) -> Column:
    """What to do, from row counts (NULL: no such table) before and, if a copy was made, after.

    absent: neither exists. already_moved: no source, or an equal target. moved: the copy is equal.
    mismatch_kept: the copy differs, so the source stays. pending: no copy has been made yet.
    """
    return (F.when(source.isNull() & target.isNull(), "absent")
            .when(source.isNull() | source.eqNullSafe(target), "already_moved")
            .when(moved.isNull(), "pending")
            .when(moved == source, "moved").otherwise("mismatch_kept"))


def decide(counts: DataFrame) -> DataFrame:
    """Rows (table_name, source_rows, target_rows, moved_rows) with verdict and drop_source."""
    v = verdict(F.col("source_rows"), F.col("target_rows"), F.col("moved_rows"))
    return counts.withColumn("verdict", v).withColumn(
        "drop_source", F.col("verdict").isin("moved", "already_moved") & F.col("source_rows").isNotNull())


def _rows(spark: SparkSession, path: str) -> int | None:
    return spark.read.parquet(path).count() if has_data(spark, path) else None


def relocate(spark: SparkSession, table: str, source: str, target: str) -> DataFrame:
    """Copy `source` to `target` unless an equal copy is there. Returns the decision row.

    Nothing is deleted here: the caller drops the source where drop_source says so.
    """
    src, tgt, moved = _rows(spark, source), _rows(spark, target), None
    if src is not None and src != tgt:
        spark.read.parquet(source).write.mode("overwrite").parquet(target)
        moved = _rows(spark, target)
    row = spark.createDataFrame([(table, src, tgt, moved)],
                                "table_name string, source_rows bigint, target_rows bigint, moved_rows bigint")
    return decide(row)
