"""Column expressions built from JVM-side functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.schemas import DISTANCE_MAX, DISTANCE_MIN, EVENT_TIME_FORMAT


def bounded_distance(distance: Column) -> Column:
    """Clamp a distance to the message bounds, two decimals; NULL for NULL and NaN."""
    bounded = F.greatest(F.lit(DISTANCE_MIN), F.least(F.lit(DISTANCE_MAX), distance))
    return F.when(distance.isNotNull() & ~F.isnan(distance), F.round(bounded, 2))


def event_time_text(time: Column) -> Column:
    """Timestamp as the text form used in messages."""
    return F.date_format(time, EVENT_TIME_FORMAT)


def id_text(identifier: Column) -> Column:
    """Numeric id as text without a decimal part."""
    return identifier.cast("bigint").cast("string")


def whole_number(text: Column, sql_type: str) -> Column:
    """Text as an integer: a decimal part is cut off, text that is no number is NULL."""
    whole = F.regexp_replace(text, r"^(\s*[+-]?\d+)\.\d*\s*$", "$1")
    return F.coalesce(text.try_cast(sql_type), whole.try_cast(sql_type))


def next_weekday(date: Column, weekday: int | Column) -> Column:
    """First date on or after ``date`` that falls on ``weekday`` (0 = Monday)."""
    target = F.lit(weekday) if isinstance(weekday, int) else weekday
    return F.date_add(date, F.pmod(target - F.weekday(date), F.lit(7)))


def money(amount: Column) -> Column:
    """A double amount in exact cents; NULL where it has none (NaN, infinite, beyond 26 digits)."""
    return amount.try_cast("decimal(28,2)")


def money_sum(amount: Column) -> Column:
    """Sum of a double amount in cents-exact decimals, independent of row order."""
    return F.sum(money(amount)).cast("double")


def bad_money_count(amount: Column) -> Column:
    """How many amounts are present but have no exact cents; ``money_sum`` leaves them out."""
    return F.count_if(amount.isNotNull() & money(amount).isNull())
