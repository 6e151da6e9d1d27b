"""Stamp columns: when, by which batch and from which system a row was loaded."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.columns import ntz

# Fixed values
STAMP_SCHEMA = T.StructType([
    T.StructField("_loaded_at", T.TimestampNTZType()),
    T.StructField("_batch_id", T.StringType()),
    T.StructField("_source_system_id", T.IntegerType()),
])
MAX_BATCH_ID = 50


def check_batch_id(batch_id: str) -> str:
    """Batch ids name folders and are read back as text, so they must not look like numbers or dates."""
    ok = batch_id[:1].isalpha() and all(ch.isalnum() or ch in "_-" for ch in batch_id)
    if not ok or len(batch_id) > MAX_BATCH_ID or not batch_id.isascii():
        raise ValueError(f"batch id must be a letter, then letters, digits, _ or -, at most {MAX_BATCH_ID}: {batch_id!r}")
    return batch_id


def stamp(df: DataFrame, batch_id: str, loaded_at: str | dt.datetime, source_system_id: int) -> DataFrame:
    """Add the stamp columns; the load time is UTC, cut to whole seconds."""
    return df.withColumns({
        "_loaded_at": F.substring(ntz(loaded_at).cast("string"), 1, 19).cast("timestamp_ntz"),
        "_batch_id": F.lit(check_batch_id(batch_id)),
        "_source_system_id": F.lit(source_system_id).cast("int"),
    })


def ensure_stamp(df: DataFrame) -> DataFrame:
    """Add stamp columns that are missing, as NULL."""
    missing = [f for f in STAMP_SCHEMA if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def append_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows plus new rows; columns only one side has read NULL on the other."""
    return old.unionByName(new, allowMissingColumns=True)
