"""Exact durations, exact half-up rounding and checked narrowing."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 3_600_000_000

# 200 * _WIDE + _WIDE, and twice _WIDE, are below 2^63.
_WIDE = 20_000_000_000_000_000
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def micros_between(start: Column, end: Column) -> Column:
    """``end - start`` in whole microseconds; NULL when either side is NULL.

    Subtracting two TIMESTAMP_NTZ values never looks at the session time zone,
    which ``timestampdiff`` does.
    """
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(1_000_000)).cast("decimal(18,0)")


def hundredths(total: Column, count: Column, unit: int = 1) -> Column:
    """``total / (count * unit)`` in hundredths, rounded half away from zero.

    One integer division, so no first rounding can spoil the second. ``total``
    is an integer of up to 35 digits. NULL when ``count`` is 0 or NULL.
    """
    # Nearly every value fits 64 bits; division of wide decimals is many times slower.
    size, copies = F.abs(total), count.cast("bigint")
    fits = (size < _WIDE) & (copies < _WIDE // unit)
    narrow = _quotient(size.cast("bigint"), copies * F.lit(unit), "bigint")
    wide_whole = (copies.cast("decimal(20,0)") * F.lit(unit).cast("decimal(11,0)")).cast(
        "decimal(34,0)"
    )
    wide = _quotient(size.cast("decimal(35,0)"), wide_whole, "decimal(3,0)")
    quotient = F.when(fits, narrow).otherwise(wide)
    return F.when(copies != 0, F.when(total < 0, -quotient).otherwise(quotient))


def _quotient(size: Column, whole: Column, factor: str) -> Column:
    doubled = whole * F.lit(2).cast(factor)
    return F.call_function("div", size * F.lit(200).cast(factor) + whole, doubled)


def mean_2dp(total: Column, count: Column, unit: int = 1) -> Column:
    """:func:`hundredths` as a decimal with two places."""
    return hundredths(total, count, unit).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")


def as_int(value: Column, name: str) -> Column:
    """Narrow a 64-bit total to INT; out of range is an error in any session mode."""
    fits = value.between(_INT_MIN, _INT_MAX)
    return F.when(value.isNull() | fits, value.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"{name}: integer out of range: "), value.cast("string")))
    )


def as_numeric(value: Column, precision: int, name: str) -> Column:
    """Narrow a two-place decimal to ``numeric(precision, 2)``; overflow is an error."""
    bound = 10 ** (precision - 2)
    fits = (value > -bound) & (value < bound)
    return F.when(value.isNull() | fits, value.cast(f"decimal({precision},2)")).otherwise(
        F.raise_error(F.concat(F.lit(f"{name}: numeric field overflow: "), value.cast("string")))
    )


def instant(as_of: datetime | None) -> Column:
    """The stamp of a run: ``as_of``, or now, as a UTC wall-clock literal."""
    moment = as_of or datetime.now(timezone.utc)
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
