"""Column helpers. Everything here is a built-in Spark expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_key(ts: str | Column) -> Column:
    """yyyyMMddHH as an int, by arithmetic so that no string is built per row."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (
        F.year(c) * 1_000_000 + F.month(c) * 10_000 + F.dayofmonth(c) * 100 + F.hour(c)
    ).cast("int")


def hour_key_date(key: str | Column) -> Column:
    """Calendar day of an hour key."""
    c = F.col(key) if isinstance(key, str) else key
    return F.make_date(
        (c / 1_000_000).cast("int"), (c / 10_000).cast("int") % 100, (c / 100).cast("int") % 100
    )


def hour_key_year(key: str | Column) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return F.floor(c / 1_000_000).cast("smallint")


def hour_key_day(key: str) -> Column:
    """yyyyMMdd of an hour key."""
    return F.expr(f"CAST(`{key}` div 100 AS INT)")


def hour_key_hour(key: str | Column) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return (c % 100).cast("tinyint")


def day_name(day_of_week: str | Column) -> Column:
    """Name of a weekday counted from Sunday, 1."""
    c = F.col(day_of_week) if isinstance(day_of_week, str) else day_of_week
    sunday = F.lit("1970-01-04").cast("date")
    return F.date_format(F.date_add(sunday, c.cast("int") - 1), "EEEE")


def hour_keys_of_years(key: str, years: Iterable[int]) -> Column:
    """Whether an hour key lies in one of the years, as ranges that a scan can prune by."""
    inside, wanted = F.lit(False), set(years)
    for first in sorted(y for y in wanted if y - 1 not in wanted):
        last = next(y for y in range(first, max(wanted) + 1) if y + 1 not in wanted)
        inside = inside | F.col(key).between(first * 1_000_000, last * 1_000_000 + 999_999)
    return inside


def hours_between(later: str, earlier: str) -> Column:
    """Hours from `earlier` to `later` with two decimals, NULL unless later > earlier."""
    seconds = F.unix_timestamp(later) - F.unix_timestamp(earlier)
    return F.when(F.col(later) > F.col(earlier), F.round(seconds / 3600, 2))


def hundredths(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


def mean_2dp(value: Column) -> Column:
    """Average of a measure that carries two decimals.

    Summing whole hundredths keeps the result independent of the order in which the
    shuffle delivers the rows; a double sum is not.
    """
    return F.sum(hundredths(value)).cast("double") / 100.0 / F.count(value)


def mean_int(value: Column) -> Column:
    """Average of an integer measure, exact until the final division."""
    return F.sum(value.cast("bigint")).cast("double") / F.count(value)


def mean_fixed(value: Column, scale: int = 9) -> Column:
    """Average of a real measure through a fixed-point sum, so that order cannot matter."""
    return F.sum(value.cast(f"decimal(28,{scale})")).cast("double") / F.count(value)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, NULL for an empty whole."""
    return F.round(
        F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits
    )


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def flag_count(condition: Column) -> Column:
    """Number of rows for which the condition holds (NULL counts as no)."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def ladder(value: Column, steps: Iterable[tuple[float, str]], otherwise: str, op: str) -> Column:
    """First label whose threshold the value meets; `op` is one of le, ge, gt."""
    tests = {"le": value.__le__, "ge": value.__ge__, "gt": value.__gt__}
    expr = F
    for bound, label in steps:
        expr = expr.when(tests[op](F.lit(bound)), F.lit(label))
    return expr.otherwise(F.lit(otherwise))
