"""Scalar column expressions. All are built-in Spark expressions; there is no Python UDF."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "as_date",
    "parse_date",
    "date_label",
    "weekday_sunday0",
    "ratio",
    "at_most",
    "infinite_to_null",
    "numbers_filled",
    "euclidean",
    "operating_days_between",
    "days_in_mask",
    "packed_order",
    "ORDER_BITS",
]

#: Bits a packed order can hold: 38 decimal digits.
ORDER_BITS = 126


def as_date(value: dt.date | str) -> Column:
    """Date literal from a date or an ISO string."""
    return F.lit(dt.date.fromisoformat(str(value)[:10]))


def parse_date(text: Column) -> Column:
    """Date from text or timestamp; unparseable text gives null instead of an ANSI error."""
    return text.cast("string").try_cast("timestamp_ntz").cast("date")


def date_label(day: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(day, pattern)


def weekday_sunday0(day: Column) -> Column:
    """Weekday number with Sunday = 0."""
    return F.dayofweek(day) - 1


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double; a zero divisor gives null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def at_most(value: Column, threshold: float) -> Column:
    """1 where value <= threshold, else 0."""
    return (value <= F.lit(threshold)).cast("int")


def infinite_to_null(value: Column) -> Column:
    """Infinities and NaN become null."""
    return F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), None).otherwise(value)


def numbers_filled(df: DataFrame) -> DataFrame:
    """Infinite, NaN and null become 0 in every numeric column; other columns are untouched."""
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.coalesce(infinite_to_null(value), F.lit(0.0))
        elif isinstance(field.dataType, T.NumericType):
            value = F.coalesce(value, F.lit(0).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def euclidean(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Distance between two points given as coordinate pairs; null coordinates count as equal."""
    total = F.lit(0.0)
    for left, right in pairs:
        total = total + F.coalesce(F.pow(left.cast("double") - right.cast("double"), F.lit(2.0)), F.lit(0.0))
    return F.sqrt(total)


def operating_days_between(first: Column, last: Column, weekdays: Column) -> Column:
    """Days in [first, last] whose weekday (Sunday = 0) is in the array, by arithmetic instead of a day list."""
    span = F.datediff(last, first)
    start = weekday_sunday0(first)

    def add(total: Column, weekday: Column) -> Column:
        offset = F.pmod(weekday - start, F.lit(7))
        return total + F.greatest(F.floor((span - offset) / F.lit(7.0)).cast("int") + 1, F.lit(0))

    return F.aggregate(weekdays, F.lit(0), add)


def days_in_mask(mask: Column, days: Column) -> Column:
    """How many of the first `days` days fall on the weekdays of a 7-bit mask whose bit 0 is the first day's weekday: whole
    weeks times the mask's bits, and the bits of the week begun."""
    begun = F.call_function("shiftleft", F.lit(1), F.pmod(days, F.lit(7))) - 1
    return F.floor(days / F.lit(7)).cast("int") * F.bit_count(mask) + F.bit_count(mask.bitwiseAND(begun))


def packed_order(parts: Sequence[tuple[Column, int]]) -> Column:
    """Whole numbers from 0 up, each with its number of bits, as one number that orders as the tuple does, nulls first.

    Up to 63 bits give a long, up to 126 a decimal: both are fixed-width, so max_by on them aggregates by hash. A value that
    needs more than its bits (all ones stand for no value) is an error, never a wrong order."""
    if sum(bits for _, bits in parts) > ORDER_BITS or any(not 0 < bits < 63 for _, bits in parts):
        raise ValueError(f"a packed order has parts of 1 to 62 bits, {ORDER_BITS} together")
    words: list[tuple[Column, int]] = []
    for value, bits in parts:
        value = value.cast("long")
        fault = F.raise_error(F.concat(F.lit(f"order value outside {bits} bits: "), value.cast("string")))
        outside = (value < 0) | (value >= F.lit(2**bits - 1))
        placed = F.when(outside, fault.cast("long")).otherwise(F.coalesce(value + 1, F.lit(0).cast("long")))
        if words and words[-1][1] + bits <= 63:
            word, held = words[-1]
            words[-1] = (F.shiftleft(word, bits) + placed, held + bits)
        else:
            words.append((placed, bits))
    (total, _), *rest = words
    for word, bits in rest:
        wide = total.cast("decimal(38,0)") * F.lit(Decimal(2**bits)).cast("decimal(20,0)")
        total = (wide + word.cast("decimal(20,0)")).cast("decimal(38,0)")
    return total
