"""Casts that give NULL for what does not fit, without paying for each failure.

try_cast reports a failure inside Spark by an exception, about ten microseconds each, so a column of
which a third does not fit would spend its whole time there. A cheap test first turns away what
cannot fit; try_cast then decides the rest, so the answer is always that of try_cast.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_INTEGRAL_BITS = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}
_FRACTIONAL = (T.FloatType, T.DoubleType)
_BLANK = r"[\s\p{Cntrl}]*"

# What a text must look like to have a chance. Each accepts everything the cast accepts, and more.
_LIKE_NUMBER = r"^[^A-DF-Za-df-z]*\p{Nd}[^A-DF-Za-df-z]*$"
_LIKE_FLOAT = r"(?i)[0-9]|inf|nan"
_LIKE_DATE = rf"(?s)^{_BLANK}[+-]?\d{{4,7}}(-(0?[1-9]|1[0-2])(-(0?[1-9]|[12]\d|3[01])({_BLANK}|[ T].*))?)?{_BLANK}$"


def cast_or_null(c: Column, source: T.DataType, target: T.DataType | str) -> Column:
    """`c`, of type `source`, as `target`; NULL where it does not fit."""
    target = T.DataType.fromDDL(target) if isinstance(target, str) else target
    if source == target:
        return c
    test = _may_fit(c, source, target)
    cast = c.try_cast(target)
    return cast if test is None else F.when(test, cast)


def _may_fit(c: Column, source: T.DataType, target: T.DataType) -> Column | None:
    if isinstance(source, T.StringType):
        return _text_may_fit(c, target)
    if not isinstance(source, T.NumericType):
        return None
    if type(target) in _INTEGRAL_BITS:
        return _within(c, source, 2 ** _INTEGRAL_BITS[type(target)])
    if isinstance(target, T.DecimalType):
        return _within(c, source, 10 ** (target.precision - target.scale))
    return None


def _within(c: Column, source: T.DataType, bound: int) -> Column | None:
    """c is within the bound or less than one off it, for fractions are cut. NaN fails."""
    bits = _INTEGRAL_BITS.get(type(source))
    if bits is not None:
        return None if 2**bits <= bound else (c <= F.lit(bound)) & (c >= F.lit(-bound))
    return (c <= F.lit(bound + 1.0)) & (c >= F.lit(-bound - 1.0))


def _text_may_fit(c: Column, target: T.DataType) -> Column | None:
    if type(target) in _INTEGRAL_BITS or isinstance(target, T.DecimalType):
        return c.rlike(_LIKE_NUMBER)
    if isinstance(target, _FRACTIONAL):
        return c.rlike(_LIKE_FLOAT)
    if isinstance(target, (T.TimestampNTZType, T.DateType)):
        return c.rlike(_LIKE_DATE)
    return None
