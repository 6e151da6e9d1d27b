"""Cleaning of whole tables: one projection, no Python per row."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.columns import (
    FLOATS, MAX_TEXT, clip_text, drop_null_tokens, finite, fixed_text, is_whole, round_places,
)


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, FLOATS)]


def text_columns(df: DataFrame) -> list[str]:
    """Text columns except stamp columns, whose names start with an underscore."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and not f.name.startswith("_")]


def _replace(df: DataFrame, columns: Collection[str], change) -> DataFrame:
    return df.withColumns({c: change(F.col(c)) for c in columns}) if columns else df


def null_nonfinite(df: DataFrame) -> DataFrame:
    return _replace(df, float_columns(df), finite)


def null_tokens(df: DataFrame) -> DataFrame:
    return _replace(df, text_columns(df), drop_null_tokens)


def round_floats(df: DataFrame) -> DataFrame:
    return _replace(df, float_columns(df), round_places)


def clip_texts(df: DataFrame, limit: int = MAX_TEXT) -> DataFrame:
    return _replace(df, text_columns(df), lambda c: clip_text(c, limit))


def integral_report(df: DataFrame) -> DataFrame:
    """(column_name, non_null, integral) per float column, for the whole table in one pass.

    A column is integral if it has a value and every finite value is whole. The scan reads the
    float columns only, and each task sends one row.
    """
    names = float_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, non_null bigint, integral boolean")
    one = df.agg(*[
        part
        for i, name in enumerate(names)
        for part in (F.count(finite(F.col(name))).alias(f"n{i}"),
                     F.coalesce(F.bool_and(is_whole(finite(F.col(name)))), F.lit(False)).alias(f"w{i}"))
    ])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"n{i}").alias("non_null"), F.col(f"w{i}").alias("integral"))
        for i, name in enumerate(names)
    ])))


def integral_columns(df: DataFrame) -> list[str]:
    """Names of the integral float columns; collects one row per float column."""
    return [r.column_name for r in integral_report(df).collect() if r.integral]


def narrow_integral(df: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """Cast whole-number float columns to BIGINT.

    The decision belongs to the column, not to a slice of rows, so it costs one extra pass unless
    the caller already knows the columns.
    """
    chosen = integral_columns(df) if columns is None else columns
    return _replace(df, chosen, lambda c: finite(c).cast("bigint"))


def clean_table(df: DataFrame, integral: Collection[str] | None = ()) -> DataFrame:
    """Non-finite to NULL, whole floats to BIGINT, the other floats rounded, NULL tokens to NULL.

    `integral=None` finds the whole-number columns with an extra pass; by default floats keep their
    type, which keeps the schema of every batch of a table the same.
    """
    return null_tokens(round_floats(narrow_integral(null_nonfinite(df), integral)))


def floats_as_text(df: DataFrame) -> DataFrame:
    """Fixed-precision text for float columns, for CSV interchange."""
    return _replace(df, float_columns(df), fixed_text)
