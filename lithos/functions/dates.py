"""Partial dates: three integers of which the later ones may be missing. ``as_of`` is always given, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_partial(text: Column, strict: bool = False) -> Column:
    """A struct (year, month, day) from '', 'YYYY' or 'YYYY-MM-DD'; other lengths give nulls, or an error if ``strict``."""
    if strict:
        fault = F.raise_error(F.concat(F.lit("not a partial date: "), text)).cast("string")
        text = F.when(F.length(text).isin(0, 4, 10), text).otherwise(F.when(text.isNotNull(), fault))
    part = lambda a, n: F.substring(text, a, n).try_cast("int")
    long = F.length(text) == 10
    return F.struct(
        F.when(F.length(text).isin(4, 10), part(1, 4)).alias("year"), F.when(long, part(6, 2)).alias("month"), F.when(long, part(9, 2)).alias("day")
    )


def is_valid(year: Column, month: Column, day: Column) -> Column:
    """In range, no day without a month, no month without a year, and a day that the month has."""
    last = F.day(F.last_day(F.make_date(F.coalesce(year, F.lit(2000)), F.coalesce(month, F.lit(1)), F.lit(1))))
    right = lambda c: F.coalesce(c, F.lit(True))
    return (
        right(year.between(1700, 2100))
        & right(month.between(1, 12))
        & F.when(month.between(1, 12) | month.isNull(), right(day.between(1, last))).otherwise(F.lit(False))
        & (month.isNull() | year.isNotNull())
        & (day.isNull() | month.isNotNull())
    )


def clamp_future(year: Column, month: Column, day: Column, as_of: Column) -> Column:
    """A date after ``as_of`` gets its year, keeps the month only if it is the current one, and loses the day."""
    full = F.make_date(year, F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1)))
    late = F.coalesce(full > as_of, F.lit(False))
    return F.struct(
        F.when(late, F.year(as_of)).otherwise(year).alias("year"),
        F.when(late, F.when(month == F.month(as_of), month)).otherwise(month).alias("month"),
        F.when(~late, day).alias("day"),
    )


def epoch_noon(year: Column, month: Column, day: Column) -> Column:
    """Seconds since 1970 at noon UTC; missing parts are 2020, January and the first."""
    date = F.make_date(F.coalesce(year, F.lit(2020)), F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1)))
    return (F.unix_date(date).cast("long") * 86400 + 43200).alias("epoch")
