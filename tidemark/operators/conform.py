"""Cast a table to a declared schema and say what did not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.casts import cast_or_null


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _cast(df: DataFrame, field: T.StructField) -> Column:
    """Cast to the declared type. varchar(n) keeps the first n characters, because a Spark cast does not cut."""
    if field.name not in df.columns:
        return F.lit(None).cast(_plain(field.dataType))
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        return F.substring(c.cast("string"), 1, field.dataType.length)
    return cast_or_null(c, df.schema[field.name].dataType, field.dataType)


def _plain(dtype: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(dtype, (T.VarcharType, T.CharType)) else dtype


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The declared columns, in order, all nullable. A value that does not fit becomes NULL (text is cut)."""
    return df.select(*[_cast(df, f).alias(f.name) for f in as_schema(schema)])


def conform_report(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """(column_name, status, non_null, lost) per column, in one pass.

    status is `ok`, `missing` (declared, not in the table) or `extra` (in the table, not declared);
    lost counts values that the cast turned into NULL or cut.
    """
    schema = as_schema(schema)
    present = [f for f in schema if f.name in df.columns]
    aggs, rows = [], []
    for i, f in enumerate(present):
        c, cast = F.col(f"`{f.name}`"), _cast(df, f)
        cut = (cast != c.cast("string")) if isinstance(f.dataType, (T.VarcharType, T.CharType)) else F.lit(False)
        aggs += [F.count(c).alias(f"n{i}"), F.count_if(c.isNotNull() & (cast.isNull() | cut)).alias(f"l{i}")]
        rows.append(_report_row(f.name, "ok", F.col(f"n{i}"), F.col(f"l{i}")))
    none = F.lit(None).cast("bigint")
    rows += [_report_row(f.name, "missing", none, none) for f in schema if f.name not in df.columns]
    rows += [_report_row(c, "extra", none, none) for c in df.columns if c not in schema.fieldNames()]
    return df.agg(*(aggs or [F.count(F.lit(1))])).select(F.inline(F.array(*rows)))


def _report_row(name: str, status: str, non_null: Column, lost: Column) -> Column:
    return F.struct(F.lit(name).alias("column_name"), F.lit(status).alias("status"),
                    non_null.alias("non_null"), lost.alias("lost"))
