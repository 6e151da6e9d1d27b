"""Targets whose columns change to a wider type: a log of their schemas, and reads in the widest one.

Batches are never rewritten. What each batch was written with is logged once per change; the table's schema is the
merge of the log, and parquet files of the narrower types are read in it directly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import ntz
from tidemark.operators import sink

SCHEMA_LOG = "_schemas"
LOG_SCHEMA = "batch_id string, position int, column_name string, column_type string, logged_at timestamp_ntz"

# Whole numbers, from narrow to wide, with the digits that hold all their values
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrower type that holds every value of both, or None: whole numbers to wider ones and to decimals, those to
    longer ones, float to double, date to timestamp. Whole numbers up to 32 bits also go into double."""
    if a == b:
        return a
    names = {a.simpleString(), b.simpleString()}
    if names <= _WHOLE.keys():
        return max((a, b), key=lambda t: _WHOLE[t.simpleString()])
    if names == {"float", "double"}:
        return T.DoubleType()
    if "double" in names and (names - {"double"}) <= _WHOLE.keys() - {"bigint"}:
        return T.DoubleType()
    if names == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    if any(isinstance(t, T.DecimalType) for t in (a, b)):
        digits = []
        for t in (a, b):
            if isinstance(t, T.DecimalType):
                digits.append((t.precision - t.scale, t.scale))
            elif t.simpleString() in _WHOLE:
                digits.append((_WHOLE[t.simpleString()], 0))
            else:
                return None
        before, after = (max(d) for d in zip(*digits))
        return T.DecimalType(before + after, after) if before + after <= 38 else None
    return None


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """old's columns in the wider type of both, then new's own. A pair of types without a wider one is refused."""
    fields, have = [], {f.name: f.dataType for f in new}
    for f in old:
        wide = wider(f.dataType, have[f.name]) if f.name in have else f.dataType
        if wide is None:
            raise ValueError(f"column {f.name} is {f.dataType.simpleString()} and cannot become {have[f.name].simpleString()}")
        fields.append(T.StructField(f.name, wide))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new if f.name not in set(old.names)])


def logged_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The merge of all logged schemas; None if none is. A row per column and change is read."""
    rows = sink.read_log(spark, f"{path}/{SCHEMA_LOG}", LOG_SCHEMA).orderBy("logged_at", "batch_id", "position").collect()
    out: T.StructType | None = None
    batches: dict[tuple, T.StructType] = {}
    for r in rows:
        batches.setdefault((r.logged_at, r.batch_id), T.StructType()).add(r.column_name, T.DataType.fromDDL(r.column_type))
    for schema in batches.values():
        out = schema if out is None else merged(out, schema)
    return out


def log_schema(spark: SparkSession, path: str, schema: T.StructType, batch_id: str, at: str | dt.datetime) -> T.StructType:
    """Log a batch's schema if the table's does not cover it yet; to be called before the batch is written. Returns the table's.

    A column whose types do not go together raises, and nothing is written."""
    known = logged_schema(spark, path)
    table = schema if known is None else merged(known, schema)
    if known is None or table != known:
        rows = [(batch_id, i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema)]
        sink.append_log(spark.createDataFrame(rows, "batch_id string, position int, column_name string, column_type string")
                        .withColumn("logged_at", ntz(at)), f"{path}/{SCHEMA_LOG}")
    return table


def write_widening(marked: DataFrame, path: str, batch_id: str, at: str | dt.datetime, **options) -> DataFrame:
    """sink.write_batch for a target whose types may widen."""
    spark = marked.sparkSession
    known = T.StructType([T.StructField(f.name, f.dataType) for f in marked.schema if f.name != "_batch_id"])
    log_schema(spark, path, known, batch_id, at)
    return sink.write_batch(marked, path, batch_id, **options)


def read_widened(spark: SparkSession, path: str) -> DataFrame | None:
    """The target's accepted rows in the table's schema; columns a batch did not have are NULL. None without a schema log."""
    schema = logged_schema(spark, path)
    if schema is None or not sink.has_data(spark, path):
        return None
    whole = T.StructType([*schema.fields, T.StructField(sink.STATUS, T.StringType()), T.StructField("_batch_id", T.StringType())])
    return sink.accepted_only(spark.read.schema(whole).parquet(path))
