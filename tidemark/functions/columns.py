"""Cleaning and coercion of single columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F, types as T

from tidemark.functions.casts import cast_or_null

# Fixed values
NULL_TOKENS = ("nan", "None", "NULL", "null")
ROUND_PLACES = 10
FLOAT_FORMAT = "%.10f"
MAX_TEXT = 4000

FLOATS = (T.FloatType, T.DoubleType)
_LONG_LIMIT = float(2**63)


def ntz(value: str | dt.datetime) -> Column:
    """A timestamp without zone, as a constant the optimizer can push into the scan."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, dt.datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from one timestamp without zone to another. A timestampdiff would go through the
    session's time zone and be an hour off across a clock change."""
    gap = end - start
    parts = (("DAY", 86_400), ("HOUR", 3_600), ("MINUTE", 60), ("SECOND", 1))
    return sum((F.floor(F.extract(F.lit(p), gap)).cast("bigint") * n for p, n in parts), F.lit(0).cast("bigint"))


def literal_like(value, dtype: T.DataType) -> Column:
    """`value` as a constant of the column's own type, so that the column stays uncast in the filter."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast(dtype)


def is_missing(c: Column, dtype: T.DataType) -> Column:
    """NULL, or NaN on floats. Never NULL itself."""
    return c.isNull() | F.isnan(c) if isinstance(dtype, FLOATS) else c.isNull()


def finite(c: Column) -> Column:
    """NaN and the infinities become NULL."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def is_whole(c: Column) -> Column:
    """True for a finite whole number that a BIGINT can hold; NULL for NULL."""
    return (F.abs(c) < F.lit(_LONG_LIMIT)) & (F.rint(c) == c)


def round_places(c: Column, places: int = ROUND_PLACES) -> Column:
    """Half-even rounding.

    Spark rounds a double by way of its decimal text, which costs about a microsecond. A value that is
    the nearest double of some number with six places, as amounts are, has no tenth place to round.
    """
    if places < 7:
        return F.bround(c, places)
    return F.when(F.rint(c * F.lit(1e6)) / F.lit(1e6) == c, c).otherwise(F.bround(c, places))


def drop_null_tokens(c: Column) -> Column:
    """Text that only spells NULL becomes NULL; matching is exact."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def fixed_text(c: Column) -> Column:
    """Fixed-precision text of a float. The guard keeps NULL from turning into the text 'null'."""
    return F.when(c.isNotNull(), F.format_string(FLOAT_FORMAT, c))


def coerce_timestamp(c: Column, dtype: T.DataType) -> Column:
    """Unparseable text becomes NULL; the row stays."""
    return cast_or_null(c, dtype, T.TimestampNTZType()) if isinstance(dtype, T.StringType) else c


def clip_text(c: Column, limit: int = MAX_TEXT) -> Column:
    """First `limit` characters; NULL stays NULL."""
    return F.substring(c, 1, limit)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def is_yes(c: Column) -> Column:
    """The enabled flag: y in any case, with stray blanks. NULL counts as no."""
    return F.lower(F.trim(F.coalesce(c, F.lit("")))) == "y"
