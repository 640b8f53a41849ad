"""Event dates as a temporal dimension: what every day is to an event, by year, country and division."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from festivo.operators.calendar import COEFFICIENTS, EVENT_KEY


def easter_sunday(year: int) -> date:
    """Western Easter: the Sunday after the paschal full moon of the Gregorian tables."""
    golden, century = year % 19, year // 100
    epact = (century - century // 4 - (8 * century + 13) // 25 + 19 * golden + 15) % 30
    moon = epact - (epact // 28) * (1 - (epact // 28) * (29 // (epact + 1)) * ((21 - golden) // 11))
    weekday = (year + year // 4 + moon + 2 - century + century // 4) % 7
    return date(year, 3, 28) + timedelta(days=moon - weekday)


def control_rows(event_id: str, dates: DataFrame, values: dict[str, float | int], weeks: tuple[int, int]) -> DataFrame:
    """Raw control rows, one per row of ``dates(country, param, year, event_date)``.

    ``values``: the event's offsets and coefficients; ``weeks``: weeks before and after the event's week.
    """
    whole = {c: values[c] for c in ("offset_from", "offset_to", "offset2_from", "offset2_to")}
    whole |= {"weeks_before": weeks[0], "weeks_after": weeks[1]}
    return dates.select(
        F.lit(event_id).alias("event_id"),
        *EVENT_KEY,
        "year",
        "event_date",
        *[F.lit(v).cast("int").alias(c) for c, v in whole.items()],
        *[F.lit(float(values[c])).alias(c) for c in COEFFICIENTS],
    )


def event_timeline(controls: DataFrame, year: int, from_day: date | None = None) -> DataFrame:
    """One row per country, division and day around the event of a year.

    From the event's first day, or from ``from_day`` where that is earlier, to its last: the offset to the
    event, whether the day lies in the event weeks and whether in the peak. Steps find a day's
    offset by equality on country, division and day.
    """
    start = F.least(F.col("date_from"), F.lit(from_day)) if from_day else F.col("date_from")
    return (
        controls.filter(F.col("year") == year)
        .select(
            "country",
            F.col("param").alias("division"),
            F.explode(F.sequence(start, F.col("date_to"))).alias("iso_date"),
            "event_date",
            "date_from",
            "offset_from",
            "offset_to",
        )
        .withColumn("event_offset", F.datediff("iso_date", "event_date"))
        .select(
            "country",
            "division",
            "iso_date",
            "event_offset",
            (F.col("iso_date") >= F.col("date_from")).alias("in_event"),
            F.col("event_offset").between(F.col("offset_from"), F.col("offset_to")).cast("int").alias("is_peak"),
        )
    )


def aligned_days(controls: DataFrame, ly_year: int, years: Sequence[int]) -> DataFrame:
    """Days of each year whose offset to that year's event lies in last year's span.

    (country, division, sale_date, norm_year, event_offset, is_peak): a few hundred rows per country and group.
    """
    span = controls.filter(F.col("year") == ly_year).select(
        *EVENT_KEY,
        "offset_from",
        "offset_to",
        F.datediff("date_from", "event_date").alias("min_offset"),
        F.datediff("date_to", "event_date").alias("max_offset"),
    )
    dated = controls.filter(F.col("year").isin(*years)).select(*EVENT_KEY, F.col("year").alias("norm_year"), "event_date")
    return (
        dated.join(span, EVENT_KEY)
        .withColumn("event_offset", F.explode(F.sequence("min_offset", "max_offset")))
        .select(
            "country",
            F.col("param").alias("division"),
            "norm_year",
            "event_offset",
            F.date_add("event_date", F.col("event_offset")).alias("sale_date"),
            F.col("event_offset").between(F.col("offset_from"), F.col("offset_to")).cast("int").alias("is_peak"),
        )
    )


def event_spans(controls: DataFrame, ly_year: int, years: Sequence[int]) -> dict[int, tuple[date, date]]:
    """First and last day of the sales that each aligned year needs, for the scan's filter: one row a year."""
    days = aligned_days(controls, ly_year, years)
    rows = days.groupBy("norm_year").agg(F.min("sale_date").alias("low"), F.max("sale_date").alias("high")).collect()
    return {r.norm_year: (r.low, r.high) for r in rows}
