"""Scalar Column helpers. All are null-safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: added to denominators so that a flat series divides cleanly.
EPSILON = 1e-10


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / (denominator + EPSILON)``, null where that sum is zero."""
    return F.try_divide(numerator, denominator + F.lit(EPSILON))


def clamp(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value to [low, high]; null stays null (greatest/least would skip it)."""
    limited = value
    if high is not None:
        limited = F.least(limited, F.lit(high))
    if low is not None:
        limited = F.greatest(limited, F.lit(low))
    return F.when(value.isNotNull(), limited)


def as_price(value: Column) -> Column:
    """Number or null: unparsable text and NaN both become null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def as_volume(value: Column, missing: int | None = None) -> Column:
    """Whole number; decimals are cut off, unparsable text becomes ``missing``.

    Up to 2^53 the double holds the whole part exactly, so only larger values need the bigint
    parse, whose failures on decimal text are costly.
    """
    number = value.try_cast("double")
    large = F.coalesce(value.try_cast("bigint"), number.try_cast("bigint"))
    whole = F.when(F.abs(number) < 2.0**53, number.cast("bigint")).otherwise(large)
    return whole if missing is None else F.coalesce(whole, F.lit(missing).cast("bigint"))


def as_day(value: Column, formats: tuple[str, ...] = ()) -> Column:
    """Date or null from a date, a timestamp, ISO text, or text in an extra format."""
    stamp = value.try_cast("timestamp")
    for pattern in formats:
        stamp = F.coalesce(stamp, F.try_to_timestamp(value.cast("string"), F.lit(pattern)))
    return F.to_date(stamp)


def as_ticker(value: Column) -> Column:
    return F.upper(F.trim(value.cast("string")))


def weekday_number(day: Column) -> Column:
    """1.0 = Sunday ... 7.0 = Saturday."""
    return F.dayofweek(day).cast("double")
