"""Staged pipe-separated files: the text form in which tables travel between systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.clean import clean_table, floats_as_text
from tidemark.operators.sink import ROWS_PER_FILE, ROWS_PER_RANGE_FILE

# Fixed values
CSV_OPTIONS = {"sep": "|", "encoding": "UTF-8", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""}


def export_csv(df: DataFrame, path: str, header: bool = True, rows_per_file: int = ROWS_PER_FILE,
               infer_integral: bool = True) -> None:
    """Clean, render and write as text: whole-number floats without a point, other floats with ten places.

    Each file carries its own header if there is one, so no file loses its first row on reading.
    """
    cleaned = clean_table(df, None if infer_integral else ())
    (floats_as_text(cleaned).write.mode("overwrite").options(**CSV_OPTIONS)
     .option("header", header).option("maxRecordsPerFile", rows_per_file).csv(path))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str, header: bool = True,
             line_breaks: bool = True) -> DataFrame:
    """Staged files, folders or wildcards read as one table. Empty text is NULL.

    A file with line breaks inside values cannot be split, so a task reads it whole; exports therefore cut files by
    rows. For files from elsewhere without such values, `line_breaks=False` lets Spark split them.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=str(line_breaks), mode="FAILFAST", header=str(header)).csv(path)


def export_ranges_csv(df: DataFrame, path: str, header: bool = True, rows_per_file: int = ROWS_PER_RANGE_FILE) -> None:
    """Rows with a `range_id`, one folder per range; the ranges written replace their old files."""
    (floats_as_text(clean_table(df)).hint("rebalance", "range_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").options(**CSV_OPTIONS).option("header", header)
     .option("maxRecordsPerFile", rows_per_file).partitionBy("range_id").csv(path))


def read_range(spark: SparkSession, path: str, range_ids: list[int], schema: str, header: bool = True) -> DataFrame:
    """Several ranges as one table; only their folders are opened."""
    return (read_csv(spark, path, f"{schema}, range_id int", header)
            .filter(F.col("range_id").isin([int(i) for i in range_ids])))


def inventory(files: DataFrame) -> DataFrame:
    """(range_id, files, rows) from the names of the files that the rows came from."""
    name = F.col("_metadata.file_path")
    rng = F.regexp_extract(name, r"range_?(?:id=)?(-?\d+)", 1).try_cast("int")
    return (files.select(name.alias("file"), rng.alias("range_id")).groupBy("range_id", "file")
            .agg(F.count(F.lit(1)).alias("rows"))
            .groupBy("range_id").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")))
