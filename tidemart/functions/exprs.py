"""Column expressions: keys, null handling, exact money arithmetic.

Everything here is a built-in Spark expression, so it stays inside generated code.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = dt.date | str | Column | None


def day_column(day: DateLike) -> Column:
    """A DATE column from a date, an ISO string or a column; ``None`` means today."""
    if day is None:
        return F.current_date()
    if isinstance(day, Column):
        return day.cast("date")
    return F.lit(str(day)).cast("date")


def date_key(day: Column) -> Column:
    """The yyyymmdd integer of a date or timestamp (integer arithmetic, no formatting)."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_key_ago(as_of: DateLike, days: int) -> Column:
    """The date key ``days`` before ``as_of``: a constant once Catalyst has folded it."""
    return date_key(F.date_sub(day_column(as_of), days))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def raw_line(columns: list[str]) -> Column:
    """The comma-joined values of one record; a missing value counts as empty."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def event_identity(event_id: Column, line: Column) -> Column:
    """The event's own id, or the md5 of its line when the id is missing or empty."""
    return F.coalesce(blank_to_null(event_id), F.md5(line.cast("binary")))


def surrogate_id(*keys: str) -> Column:
    """A 128-bit row id that is the same on every rerun, unlike a sequence.

    A 64-bit hash would already collide within some ten billion rows.
    """
    return F.md5(F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys]).cast("binary"))


def ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """numerator / denominator, rounded half-up; NULL instead of a division by zero.

    DECIMAL(22,2) / DECIMAL(20,0) keeps 18 decimal places, so the only rounding that
    can be seen is the last one.
    """
    num = numerator.cast("decimal(22,2)")
    den = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(num / den, places)


def percent(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """100 * numerator / denominator for counts or money, rounded half-up."""
    num = (numerator.cast("decimal(22,2)") * F.lit(100)).cast("decimal(24,2)")
    den = F.nullif(denominator.cast("decimal(22,2)"), F.lit(0).cast("decimal(22,2)"))
    return F.round(num / den, places)


def mean2(col: Column, places: int = 2) -> Column:
    """Average of an integer or money column over its non-null values, rounded half-up."""
    return ratio(F.sum(col), F.count(col), places)
