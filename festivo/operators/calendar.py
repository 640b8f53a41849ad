"""Fiscal calendar, event controls, holidays, trading hours and year shift."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from festivo.config import HOURS_LABEL_SHIFTS, MOVABLE_EVENT, NEVER_HOLIDAY, WIDE_STORE_RANGE
from festivo.functions.expressions import month_day, week_monday, year_week

EVENT_KEY = ["country", "param"]
DAY_COLUMNS = tuple(f"day_{n}" for n in range(1, 8))
INT_CONTROLS = ("year", "offset_from", "offset_to", "offset2_from", "offset2_to", "weeks_before", "weeks_after")
COEFFICIENTS = (
    "c_off_bh_uplift",
    "c_off_bh_seasonal",
    "c_off_bh_norm",
    "c_off_uplift",
    "c_off_offset_uplift",
    "c_off_seasonal",
    "c_off_norm",
    "c_uplift",
    "c_seasonal",
    "c_norm",
    "c_off_share_base",
    "c_off_share_offset",
    "c_share_base",
)


def fiscal_day(day: Column, fold_week_53: bool = True) -> tuple[Column, Column, Column]:
    """Fiscal year, two-digit week and weekday (Monday = 1) of a day."""
    year = F.extract(F.lit("yearofweek"), day).cast("int")
    week = F.weekofyear(day)
    folded = (week == 53) if fold_week_53 else F.lit(False)
    return (
        F.when(folded, year + 1).otherwise(year),
        F.when(folded, F.lit("01")).otherwise(F.lpad(week.cast("string"), 2, "0")),
        (F.weekday(day) + 1).cast("int"),
    )


def fiscal_calendar(days: DataFrame, day: str = "iso_date", fold_week_53: bool = True) -> DataFrame:
    """Fiscal year, two-digit week and weekday (Monday = 1) of each day.

    With ``fold_week_53`` the 53rd week counts as week 01 of the next year.
    """
    year, week, weekday = fiscal_day(F.col(day), fold_week_53)
    return days.withColumn("fiscal_year", year).withColumn("fiscal_week", week).withColumn("weekday", weekday)


def on_calendar(rows: DataFrame, calendar: DataFrame, day: str, columns: dict[str, str], how: str = "left") -> DataFrame:
    """Look up columns of a row's day (new name -> calendar's name); a day that the calendar lacks stops the run.

    Without the guard such a row would go on without a week, or drop out of an inner join. An unknown day stays unknown, or
    drops out of an inner join.
    """
    found = calendar.select(F.col("iso_date").alias(day), F.lit(True).alias("_dated"), *[F.col(c).alias(n) for n, c in columns.items()])
    known = rows if how == "left" else rows.filter(F.col(day).isNotNull())
    lacking = F.col("_dated").isNull() & F.col(day).isNotNull()
    message = F.concat(F.lit("no calendar row for "), F.col(day).cast("string"))
    joined = known.join(found, day, "left")
    guarded = {n: F.when(lacking, F.raise_error(message).cast(joined.schema[n].dataType)).otherwise(F.col(n)) for n in columns}
    return joined.withColumns(guarded).drop("_dated")


def week_lookup(calendar: DataFrame) -> DataFrame:
    """Monday of every fiscal week: (year_week, monday)."""
    return calendar.filter(F.col("weekday") == 1).select(
        year_week(F.col("fiscal_year"), F.col("fiscal_week")).alias("year_week"),
        F.col("iso_date").alias("monday"),
    )


def event_controls(controls: DataFrame, calendar: DataFrame, digit_arithmetic: bool = False) -> DataFrame:
    """Typed event parameters with the event's week range and its first and last day.

    By default the range is counted in calendar weeks. ``digit_arithmetic`` adds and
    subtracts on the ``yyyyww`` number instead, which finds no week across a year end.
    """
    typed = controls
    for name in INT_CONTROLS:
        typed = typed.withColumn(name, F.col(name).cast("int"))
    for name in COEFFICIENTS:
        typed = typed.withColumn(name, F.col(name).cast("decimal(10,3)"))
    typed = typed.withColumn("event_date", F.col("event_date").cast("date"))

    label = calendar.select(
        F.col("iso_date"), year_week(F.col("fiscal_year"), F.col("fiscal_week")).alias("year_week")
    )
    of_event = label.select(F.col("iso_date").alias("event_date"), "year_week")
    out = typed.join(of_event, "event_date", "inner")
    if digit_arithmetic:
        number = F.col("year_week").cast("int")
        out = out.withColumn("year_week_from", (number - F.col("weeks_before")).cast("string")).withColumn(
            "year_week_to", (number + F.col("weeks_after")).cast("string")
        )
        weeks = week_lookup(calendar)
        first = weeks.select(F.col("year_week").alias("year_week_from"), F.col("monday").alias("date_from"))
        last = weeks.select(
            F.col("year_week").alias("year_week_to"), F.date_add("monday", 6).alias("date_to")
        )
        return out.join(first, "year_week_from", "left").join(last, "year_week_to", "left")
    monday = week_monday(F.col("event_date"))
    out = out.withColumn("date_from", F.date_sub(monday, F.col("weeks_before") * 7)).withColumn(
        "date_to", F.date_add(monday, F.col("weeks_after") * 7 + 6)
    )
    first = label.select(F.col("iso_date").alias("date_from"), F.col("year_week").alias("year_week_from"))
    last = label.select(F.col("iso_date").alias("date_to"), F.col("year_week").alias("year_week_to"))
    return out.join(first, "date_from", "left").join(last, "date_to", "left")


def shift_calendar(calendar: DataFrame, controls: DataFrame, from_monday: date | None = None) -> DataFrame:
    """Map each last-year day to this year's day with the same offset to the event.

    ``controls`` holds one row per country, parameter group and year; a year's event is paired with
    the next year's, so an event that moves with the calendar, or falls on February 29, maps to
    where it is next year. The window runs from ``from_monday`` (default: the controls' first
    day) to the controls' last day.
    """
    start = F.least(F.lit(from_monday), "date_to") if from_monday else F.col("date_from")
    following = controls.select(*EVENT_KEY, (F.col("year") - 1).alias("year"), F.col("event_date").alias("fy_event_date"))
    ly = (
        controls.join(following, [*EVENT_KEY, "year"])
        .select(
            *EVENT_KEY,
            "event_date",
            "fy_event_date",
            F.explode(F.sequence(start, F.col("date_to"))).alias("iso_date"),
        )
        .join(
            calendar.select(
                "iso_date",
                F.col("fiscal_year").alias("ly_year"),
                F.col("fiscal_week").alias("ly_week"),
                F.col("weekday").alias("ly_weekday"),
            ),
            "iso_date",
        )
        .filter(F.col("ly_year") == F.year("event_date"))
        .withColumn("event_offset", F.datediff("iso_date", "event_date"))
        .withColumn("fy_date", F.date_add("fy_event_date", F.col("event_offset")))
    )
    fy = calendar.select(
        F.col("iso_date").alias("fy_date"),
        F.col("fiscal_year").alias("fy_year"),
        F.col("fiscal_week").alias("fy_week"),
        F.col("weekday").alias("fy_weekday"),
    )
    return (
        ly.join(fy, "fy_date")
        .filter(F.col("fy_year") == F.col("ly_year") + 1)
        .withColumn("weekday_shift", F.pmod(F.col("fy_weekday") - F.col("ly_weekday"), F.lit(7)))
        .drop("event_date", "fy_event_date")
    )


def year_offset(controls: DataFrame, event_id: str) -> DataFrame:
    """Days between last year's and this year's weekday pattern, per country and parameter group.

    Easter moves with the calendar and needs no shift; other events shift by the
    difference in day of month plus one, or plus two into a leap year.
    """
    ly = controls.select(
        *EVENT_KEY,
        F.col("year").alias("ly_year"),
        F.col("event_date").alias("ly_event_date"),
        F.col("year_week").alias("peak_year_week"),
    )
    fy = controls.select(
        *EVENT_KEY, (F.col("year") - 1).alias("ly_year"), F.col("event_date").alias("fy_event_date")
    )
    pairs = ly.join(fy, [*EVENT_KEY, "ly_year"])
    if event_id.upper() == MOVABLE_EVENT:
        days = F.lit(0)
        shift = F.lit(0)
    else:
        days = F.dayofmonth("fy_event_date") - F.dayofmonth("ly_event_date")
        next_year = F.col("ly_year") + 1
        leap = (next_year % 4 == 0) & ((next_year % 100 != 0) | (next_year % 400 == 0))
        shift = days + F.when(leap, 2).otherwise(1)
    return pairs.select(
        *EVENT_KEY,
        "ly_year",
        shift.cast("int").alias("days_shift"),
        days.cast("int").alias("days_shift_raw"),
        "peak_year_week",
        "fy_event_date",
    )


def event_holidays(holidays: DataFrame) -> DataFrame:
    """Bank holidays, without the day that never counts as one."""
    return holidays.filter(month_day(F.col("holiday_date")) != NEVER_HOLIDAY)


def holiday_flags(holidays: DataFrame, day: str) -> DataFrame:
    """(country, day, is_holiday = 1) of every country's holidays."""
    free = event_holidays(holidays).select("country", F.col("holiday_date").alias(day))
    return free.dropDuplicates().withColumn("is_holiday", F.lit(1))


def holiday_week_pivot(calendar: DataFrame, holidays: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Fiscal week to seven columns: 0 where the weekday is a bank holiday, else NULL."""
    days = calendar.select(F.col("iso_date").alias("holiday_date"), "fiscal_year", "fiscal_week", "weekday")
    return (
        event_holidays(holidays)
        .join(days, "holiday_date")
        .groupBy(*keys, "fiscal_year", "fiscal_week")
        .agg(*[F.min(F.when(F.col("weekday") == n, 0)).alias(f"day_{n}") for n in range(1, 8)])
    )


def open_day_grid(
    hours: DataFrame,
    calendar: DataFrame,
    holiday_weeks: DataFrame,
    keys: tuple[str, ...] = (),
    since: date | None = None,
) -> DataFrame:
    """Trading hours projected to concrete weeks: store x week x seven open flags.

    ``hours`` columns: country, store_number, hours_1..hours_7, label, created_date,
    snapshot_date. One pass over the table; the label decides how many weeks ahead a
    row speaks for.
    """
    weekly = sum((F.col(f"hours_{n}") for n in range(2, 8)), F.col("hours_1"))
    shifts = F.create_map(
        *[x for label, days in HOURS_LABEL_SHIFTS.items() for x in (F.lit(label), F.array(*map(F.lit, days)))]
    )
    rows = hours if since is None else hours.filter(F.col("snapshot_date") >= F.lit(since))
    projected = (
        rows.filter((weekly > 6) & F.col("store_number").between(*WIDE_STORE_RANGE))
        .withColumn("shift", F.explode(F.try_element_at(shifts, F.col("label"))))
        .select(
            "country",
            "store_number",
            F.date_add("created_date", F.col("shift")).alias("iso_date"),
            *[F.when(F.col(f"hours_{n}") > 1, 1).otherwise(0).alias(f"open_{n}") for n in range(1, 8)],
        )
    )
    wednesdays = calendar.filter(F.col("weekday") == 3).select("iso_date", "fiscal_year", "fiscal_week")
    grid = projected.join(wednesdays, "iso_date").drop("iso_date").dropDuplicates()
    return grid.join(holiday_weeks, [*keys, "fiscal_year", "fiscal_week"], "left").select(
        "country",
        "store_number",
        "fiscal_year",
        "fiscal_week",
        *[F.coalesce(F.col(f"day_{n}"), F.col(f"open_{n}")).alias(f"day_{n}") for n in range(1, 8)],
    )


def fy_event_days(controls: DataFrame) -> DataFrame:
    """(country, param, iso_date, event_offset) of the event days that the controls of a year span."""
    days = F.explode(F.sequence("date_from", "date_to")).alias("iso_date")
    return controls.select(*EVENT_KEY, "event_date", days).select(
        *EVENT_KEY, "iso_date", F.datediff("iso_date", "event_date").alias("event_offset")
    )


def fy_calendar_grid(calendar: DataFrame, holidays: DataFrame, nodes: DataFrame, days: DataFrame) -> DataFrame:
    """This year's event days for every node and cluster known from last year.

    ``nodes``: distinct (country, param, node_id, store_cluster); ``days``: this year's event days.
    The days come from each country's and parameter group's own range, so the join is on both.
    """
    dated = (
        days.join(calendar.select("iso_date", "fiscal_year", "fiscal_week", "weekday"), "iso_date")
        .join(holiday_flags(holidays, "iso_date"), ["country", "iso_date"], "left")
        .withColumn("is_holiday", F.col("is_holiday").isNotNull())
    )
    return nodes.join(dated, EVENT_KEY)

