"""Table profiles: counts, size tiers, change rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tidemark.session import one_row

# Upper bound (exclusive) of rows, tier, strategy
TIERS = (
    (1_000, "small", "full load"),
    (100_000, "medium", "full load"),
    (1_000_000, "large", "full load with monitoring"),
    (10_000_000, "very large", "consider delta load"),
    (None, "massive", "delta or sample"),
)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table; a parquet count reads no column data."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _ladder(rows: Column, tiers: Sequence[tuple], pick: int) -> Column:
    *bounded, top = tiers
    out = None
    for tier in bounded:
        out = (F if out is None else out).when(rows < tier[0], tier[pick])
    return F.lit(top[pick]) if out is None else out.otherwise(top[pick])


def tier(rows: Column, tiers: Sequence[tuple] = TIERS) -> Column:
    return _ladder(rows, tiers, 1)


def strategy(rows: Column, tiers: Sequence[tuple] = TIERS) -> Column:
    return _ladder(rows, tiers, 2)


def with_tiers(counts: DataFrame, tiers: Sequence[tuple] = TIERS) -> DataFrame:
    rows = F.col("row_count")
    return counts.withColumns({"tier": tier(rows, tiers), "strategy": strategy(rows, tiers)})


def placeholders(counts: DataFrame, max_rows: int = 1) -> DataFrame:
    """Tables with at most `max_rows` rows, which may in truth be empty."""
    return counts.filter(F.col("row_count") <= max_rows)


def inventory(counts: DataFrame, configured: DataFrame) -> DataFrame:
    """Configured tables against present ones: found, missing or extra, with the row count if present."""
    here, asked = counts.withColumn("_here", F.lit(True)), configured.select("table_name").withColumn("_asked", F.lit(True))
    status = F.when(F.col("_here").isNull(), "missing").when(F.col("_asked").isNull(), "extra").otherwise("found")
    return asked.join(here, "table_name", "full_outer").select(
        "table_name", F.col("_here").isNotNull().alias("table_exists"), "row_count", status.alias("status"))


def daily_change(df: DataFrame, date: str) -> DataFrame:
    """Rows per day."""
    return df.groupBy(F.col(date).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("rows_changed"))


def change_rate(df: DataFrame, date: str, table: str) -> DataFrame:
    """Days with rows, rows dated, average, smallest and largest day of a table."""
    per_day = daily_change(df, date).filter("day is not null")
    return per_day.agg(
        F.count(F.lit(1)).alias("days"), F.sum("rows_changed").alias("rows_dated"),
        F.floor(F.sum("rows_changed") / F.count(F.lit(1))).cast("bigint").alias("avg_per_day"),
        F.min("rows_changed").alias("min_per_day"), F.max("rows_changed").alias("max_per_day"),
    ).select(F.lit(table).alias("table_name"), "*")


def key_stats(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"), F.count(F.lit(1)).alias("row_count"))


def from_footers(spark: SparkSession, path: str, *aggregates: Column) -> DataFrame:
    """Counts, smallest and largest values of a parquet table, a plan that reads file footers and no pages where Spark can.

    Spark answers count(*), and count, min and max of number, boolean and date columns, from the footers if the newer
    reader may; of other columns (text, timestamps) it reads the pages as usual. The settings are those of a session of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(*aggregates)


def footer_row(spark: SparkSession, path: str, *aggregates: Column) -> Row:
    """The row of from_footers; files whose footers cannot tell (written without statistics) are read instead."""
    try:
        return from_footers(spark, path, *aggregates).first()
    except Exception as e:   # the reader says so only when it meets such a file
        if "statistics" not in str(e):
            raise
        return spark.read.parquet(path).agg(*aggregates).first()


def key_stats_from_footers(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Like key_stats, of a parquet table and a whole-number key."""
    r = footer_row(spark, path, F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n"))
    return one_row(spark, min_key=F.lit(r.lo).cast("bigint"), max_key=F.lit(r.hi).cast("bigint"), row_count=F.lit(r.n).cast("bigint"))


def table_counts_from_footers(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Like table_counts, of parquet tables by path."""
    rows = [(name, footer_row(spark, path, F.count(F.lit(1)).alias("n")).n) for name, path in paths.items()]
    return spark.createDataFrame(rows, "table_name string, row_count bigint")
