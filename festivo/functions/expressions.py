"""Column expressions shared by the operators; all safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from festivo.config import NARROW_RANGE_COUNTRIES, NARROW_STORE_RANGE, ROLLED_UP, WIDE_STORE_RANGE


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def clamp(value: Column, low: float, high: float) -> Column:
    """Bound a value on both sides; NULL stays NULL."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def month_day(day: Column) -> Column:
    return F.date_format(day, "MM-dd")


def year_week(year: Column, week: Column) -> Column:
    return F.concat(year.cast("string"), week)


def week_monday(day: Column) -> Column:
    return F.date_sub(day, F.weekday(day))


def node_id(parts: Sequence[Column]) -> Column:
    """Hierarchy node key: the levels above the first rolled-up one, joined by '-'.

    The separator keeps 1+12 and 11+2 apart.
    """
    kept = [F.when(p != ROLLED_UP, p) for p in parts]
    return F.concat_ws("-", *kept)


def pick_by_weekday(weekday: Column, days: Sequence[Column]) -> Column:
    """Value of the weekday's column, NULL when the weekday is unknown."""
    return F.get(F.array(*days), weekday - 1)


def store_in_range(country: Column, store_number: Column) -> Column:
    """Store numbers that take part, by country."""
    narrow = country.isin(*NARROW_RANGE_COUNTRIES)
    return F.when(narrow, store_number.between(*NARROW_STORE_RANGE)).otherwise(
        store_number.between(*WIDE_STORE_RANGE)
    )


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def total_of(terms: Sequence[Column]) -> Column:
    """Sum of terms where a missing term counts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0.0)) for t in terms])
