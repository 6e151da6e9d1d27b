"""The control table and the load plan made from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import blank_to_null, is_yes
from tidemark.operators.profile import tier
from tidemark.operators.watermark import LOOKBACK_DAYS, start_plan

# Fixed values; the sheet's `Enabled ` header carries a blank, so names are trimmed before use
CONTROL_COLUMNS = {
    "Source_Schema": "source_schema", "Source_table_name": "source_table", "Extract_Type": "extract_type",
    "Target_Schema": "target_schema", "Target_Table_Name": "target_table", "Date_Column_Name": "date_column",
    "PK_Column_Name": "pk_column", "Enabled": "enabled",
}
REQUIRED = ("Source_Schema", "Source_table_name", "Target_Schema", "Target_Table_Name", "Enabled")
FACT_PREFIX = "Fact"


def read_control(sheet: DataFrame) -> DataFrame:
    """Enabled rows of the control sheet with tidy names, blank cells as NULL, and the load type."""
    names = {c.strip(): c for c in sheet.columns}
    missing = [c for c in REQUIRED if c not in names]
    if missing:
        raise ValueError(f"control table lacks {missing}")
    cols = [(F.col(f"`{names[old]}`") if old in names else F.lit(None)).cast("string").alias(new)
            for old, new in CONTROL_COLUMNS.items()]
    tidy = sheet.select(*cols).filter(is_yes(F.col("enabled")))
    tidy = tidy.withColumns({"date_column": blank_to_null(F.col("date_column")),
                             "pk_column": blank_to_null(F.col("pk_column"))})
    return tidy.drop("enabled").withColumns({
        "load_type": load_type(F.col("source_table"), F.col("date_column")),
        "table_name": F.concat_ws(".", "source_schema", "source_table")})


def load_type(table: Column, date_column: Column) -> Column:
    """Only a fact table with a date column is loaded by delta."""
    return F.when(table.startswith(FACT_PREFIX) & date_column.isNotNull(), "DELTA").otherwise("FULL")


def phase(table: Column, size: Column) -> Column:
    """Order of first loads: small tables, medium dimensions, growing dimensions, smaller facts, large facts."""
    fact = table.startswith(FACT_PREFIX)
    return (F.when(~fact & (size == "small"), 1).when(~fact & (size == "medium"), 2).when(~fact, 3)
            .when(size != "massive", 4).otherwise(5))


def load_plan(control: DataFrame, counts: DataFrame, marks: DataFrame, as_of: str | dt.datetime,
              lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """One row per enabled table that exists: load type, delta window, size tier, phase."""
    starts = start_plan(control.select("table_name", "load_type"), marks, as_of, lookback_days)
    joined = control.drop("load_type").join(starts, "table_name").join(counts, "table_name")
    sized = joined.withColumn("tier", tier(F.col("row_count")))
    return sized.select(
        "table_name", "target_schema", "target_table", "pk_column", "date_column", "load_type", "delta_start",
        "delta_end", "first_run", "row_count", "tier", phase(F.col("source_table"), F.col("tier")).alias("phase"))


def phase_summary(plan: DataFrame) -> DataFrame:
    """Tables and rows per phase, with the table names in order."""
    return plan.groupBy("phase").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("total_rows"),
        F.count_if(F.col("load_type") == "DELTA").alias("delta_tables"),
        F.array_join(F.array_sort(F.collect_list("table_name")), ",").alias("table_names"))
