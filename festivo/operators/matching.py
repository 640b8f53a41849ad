"""Carry last year's days over to this year's calendar and fill the gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from festivo.config import (
    COUNTRY_SPECIAL_DAYS,
    FIXED_DATE_DAYS,
    GAP_FILL_SOURCE_DATE,
    LEVELS,
    ROLLED_UP,
    SPECIAL_DAYS,
    RunConfig,
)
from festivo.functions.expressions import any_of, month_day, year_week
from festivo.operators.calendar import EVENT_KEY

NODE = ["country", "node_id", "store_cluster"]
PEAK, FIXED, OFF_PEAK, COMPANION = "peak", "fixed", "off_peak", "companion"

VALUES = ("base_sales_ly", "sales_promo", "sales_regular", "sales", "uplift")
DATES = ("base_date", "source_date")
PLAIN = ("uplift_original", "seasonal_factor", "norm_factor", "base_share_ly", "base_share_fy")


def special_day(day: Column, country: Column) -> Column:
    """Days treated like holidays although shops are open."""
    by_country = [(country == c) & (month_day(day) == d) for c, d in COUNTRY_SPECIAL_DAYS]
    return any_of([month_day(day).isin(*SPECIAL_DAYS), *by_country])


def ly_feature_join(
    uplift: DataFrame, series: DataFrame, norm: DataFrame, controls: DataFrame, cfg: RunConfig
) -> DataFrame:
    """Last year's event rows with seasonal and profile factors and the event window.

    ``reverse_index`` counts a node's rows back from its last day, base rows included.
    """
    key = [*NODE, "event_offset"]
    newest = Window.partitionBy(*NODE).orderBy(F.col("iso_date").desc(), "is_base")
    window = controls.filter(F.col("year") == cfg.ly_year).select(
        *EVENT_KEY, "event_date", "offset_from", "offset_to", "year_week"
    )
    special = special_day(F.col("iso_date"), F.col("country"))
    return (
        uplift.join(series.select(*key, "is_base", "seasonal_factor"), [*key, "is_base"], "left")
        .join(norm.select(*key, "norm_factor"), key, "left")
        .join(window.withColumnRenamed("year_week", "peak_year_week"), EVENT_KEY, "left")
        .withColumn("reverse_index", F.row_number().over(newest))
        .withColumn("seasonal_factor", F.coalesce("seasonal_factor", F.lit(0.0)))
        .withColumn("norm_factor", F.coalesce("norm_factor", F.lit(0.0)))
        .withColumn("is_special", (special | (F.col("is_holiday") == 1)).cast("int"))
        .filter(F.col("is_base") == 0)
    )


def _lagged(name: str, by: Column) -> Column:
    """A holiday takes the value of the matched row before it."""
    return F.when(F.col("is_holiday") == 1, F.lag(name).over(by)).otherwise(F.col(name))


def ly_fy_match(grid: DataFrame, features: DataFrame, shifts: DataFrame, days: DataFrame) -> DataFrame:
    """Give every day of this year's grid the last-year day it should behave like.

    Every last-year row is sent to the day it serves: the same offset inside the event
    window (peak), the same month-day on fixed dates, the shifted offset outside it
    (off-peak), and for any row the shifted offset as companion. One aggregation per
    node and day then lines the roles up, where three joins of the grid with the
    features would shuffle both sides each time. ``shifts``: one ``year_offset`` row per
    country and parameter group; ``days``: this year's event days. Both are small written tables, so
    the features meet them without an exchange.
    """
    in_peak = F.col("event_offset").between(F.col("offset_from"), F.col("offset_to"))
    on_fixed = month_day(F.col("iso_date")).isin(*FIXED_DATE_DAYS)
    shifted = F.col("event_offset") - F.col("days_shift")
    roles = F.array(
        F.when(in_peak, F.struct(F.lit(PEAK).alias("role"), F.col("event_offset").alias("fy_offset"))),
        F.when(~in_peak, F.struct(F.lit(OFF_PEAK).alias("role"), shifted.alias("fy_offset"))),
        F.when(
            on_fixed,
            F.struct(
                F.lit(FIXED).alias("role"),
                F.datediff(F.add_months("iso_date", 12), "fy_event_date").alias("fy_offset"),
            ),
        ),
        F.struct(F.lit(COMPANION).alias("role"), shifted.alias("fy_offset")),
    )
    sent = (
        features.join(shifts.select(*EVENT_KEY, "days_shift", "fy_event_date"), EVENT_KEY)
        .withColumn("to", F.explode(F.filter(roles, lambda r: r.isNotNull())))
        .withColumn("role", F.col("to.role"))
        .withColumn("fy_offset", F.col("to.fy_offset"))
        .withColumn("source_date", F.col("iso_date"))
        .withColumn("uplift_original", F.col("uplift"))
        .drop("to", "iso_date", "days_shift", "fy_event_date")
        .join(days.withColumnRenamed("event_offset", "fy_offset"), [*EVENT_KEY, "fy_offset"])
    )
    before = Window.partitionBy(*NODE, "role").orderBy("event_offset")
    hidden = (F.col("role") == OFF_PEAK) & (F.col("is_holiday") == 0) & (F.col("is_special") == 1)

    def served(name: str) -> Column:
        if name == "uplift":
            return F.when(hidden, F.lit(1.0)).otherwise(_lagged(name, before))
        return F.when(hidden, F.lit(None)).otherwise(_lagged(name, before))

    plain_companion = F.col("role") == COMPANION
    values = sent.select(
        *NODE,
        "role",
        "iso_date",
        "is_holiday",
        "is_special",
        *[F.when(plain_companion, F.col(c)).otherwise(served(c)).alias(c) for c in (*VALUES, *DATES)],
        *PLAIN,
        "offset_from",
        "offset_to",
    )
    carried = [*VALUES, *DATES, *PLAIN, "is_holiday", "is_special", "offset_from", "offset_to"]
    row = F.struct(*carried)
    wide = values.groupBy(*NODE, "iso_date").agg(
        *[F.max(F.when(F.col("role") == r, row)).alias(r) for r in (PEAK, FIXED, OFF_PEAK, COMPANION)]
    )
    out = grid.join(shifts, EVENT_KEY, "left").join(wide, [*NODE, "iso_date"], "left")

    def first_of(name: str) -> Column:
        return F.coalesce(*[F.col(f"{r}.{name}") for r in (PEAK, FIXED, OFF_PEAK)])

    out = out.withColumn(
        "is_matched", F.coalesce(*[F.col(r) for r in (PEAK, FIXED, OFF_PEAK)]).isNotNull()
    )
    return out.select(
        *grid.columns,
        "days_shift",
        "days_shift_raw",
        "peak_year_week",
        "is_matched",
        *[first_of(c).alias(c) for c in ("offset_from", "offset_to")],
        first_of("is_holiday").alias("ly_is_holiday"),
        first_of("is_special").alias("ly_is_special"),
        *[F.when(F.col("is_holiday"), F.lit(0.0)).otherwise(first_of(c)).alias(c) for c in VALUES],
        *[F.when(~F.col("is_holiday"), first_of(c)).alias(c) for c in DATES],
        *[first_of(c).alias(c) for c in PLAIN],
        F.col(COMPANION).alias(COMPANION),
    )


def gap_source_week(features: DataFrame, shifts: DataFrame) -> DataFrame:
    """Rows of the last full week before the event window that can stand in for missing days.

    Per country and parameter group, the latest year-week with a positive shift, before the window
    and not the event's own week.
    """
    rows = features.join(
        shifts.select(*EVENT_KEY, "days_shift"), EVENT_KEY
    ).withColumn("year_week", year_week(F.col("fiscal_year"), F.col("fiscal_week")))
    chosen = (
        rows.filter(
            (F.col("days_shift") > 0)
            & (F.col("event_offset") < F.col("offset_from"))
            & (F.col("year_week") != F.col("peak_year_week"))
        )
        .groupBy(*EVENT_KEY)
        .agg(F.max("year_week").alias("year_week"))
    )
    return rows.join(chosen, [*EVENT_KEY, "year_week"])


def gap_fill_last_week(matched: DataFrame, features: DataFrame, shifts: DataFrame) -> DataFrame:
    """Fill unmatched days before the event by weekday from the gap source week.

    First from the node itself (uplift times its forward ratio), then from any node of
    the same parameter group and cluster: the one with the smallest node id, so that a
    missing day gets one row and not one per candidate. A row without a source day that is
    no holiday shows the gap-fill date.
    """
    source = gap_source_week(features, shifts)
    missing = ~F.col("is_matched") & (F.col("event_offset") < 0)
    carried = [
        "base_sales_ly",
        "sales_promo",
        "sales_regular",
        "sales",
        "base_date",
        "seasonal_factor",
        "norm_factor",
        "base_share_ly",
        "base_share_fy",
        "is_holiday",
        "is_special",
        "offset_from",
        "offset_to",
    ]
    own = source.select(
        *NODE,
        "weekday",
        F.struct(
            F.col("event_offset").alias("at"),
            *carried,
            (F.col("uplift") * F.col("forward_ratio")).alias("uplift"),
        ).alias("own"),
    )
    other = (
        source.groupBy("country", "param", "store_cluster", "weekday")
        .agg(
            F.min(
                F.struct("node_id", F.col("event_offset").alias("at"), *carried, F.col("uplift"))
            ).alias("other")
        )
    )
    group = ["country", "param", "store_cluster"]
    filled = matched.filter(missing).join(own, [*NODE, "weekday"], "left").join(
        other, [*group, "weekday"], "left"
    )
    filled = filled.withColumn("other", F.when(F.col("own").isNull(), F.col("other")))
    own_before = Window.partitionBy(*NODE, F.col("own").isNotNull()).orderBy("own.at", "event_offset")
    other_before = Window.partitionBy(*NODE, F.col("other").isNotNull()).orderBy("other.at", "event_offset")

    def stand_in(source_name: str, name: str, by) -> Column:
        value = F.col(f"{source_name}.{name}")
        return F.when(F.col(f"{source_name}.is_holiday") == 1, F.lag(value).over(by)).otherwise(value)

    def filled_value(name: str) -> Column:
        found = F.coalesce(stand_in("own", name, own_before), stand_in("other", name, other_before))
        return F.coalesce(F.col(name), found)

    def plain(name: str, source: str | None = None) -> Column:
        s = source or name
        return F.coalesce(F.col(name), F.col(f"own.{s}"), F.col(f"other.{s}"))

    has_source = F.col("own").isNotNull() | F.col("other").isNotNull()
    new = {
        **{c: filled_value(c) for c in VALUES},
        "base_date": F.when(~F.col("is_holiday"), filled_value("base_date")),
        "uplift_original": plain("uplift_original", "uplift"),
        "seasonal_factor": plain("seasonal_factor"),
        "norm_factor": plain("norm_factor"),
        "base_share_ly": plain("base_share_ly"),
        "base_share_fy": plain("base_share_fy"),
        "ly_is_holiday": plain("ly_is_holiday", "is_holiday"),
        "ly_is_special": plain("ly_is_special", "is_special"),
        "offset_from": plain("offset_from"),
        "offset_to": plain("offset_to"),
        "is_filled": has_source,
    }
    filled = filled.select(
        *[new.get(c, F.col(c)).alias(c) for c in matched.columns], new["is_filled"].alias("is_filled")
    )
    rows = matched.filter(~missing).withColumn("is_filled", F.lit(False)).unionByName(filled)
    undated = F.col("source_date").isNull() & ~F.col("is_holiday")
    return rows.withColumn(
        "source_date", F.when(undated, F.lit(GAP_FILL_SOURCE_DATE)).otherwise(F.col("source_date"))
    )


def offset_companion(filled: DataFrame, nodes: DataFrame) -> DataFrame:
    """Companion day's values, running index, hierarchy level; a leading empty row is dropped."""
    by_day = Window.partitionBy(*NODE).orderBy("iso_date")
    deepest = F.lit(1)
    for depth, level in enumerate(LEVELS[1:], start=2):
        deepest = F.when(F.col(level) != ROLLED_UP, depth).otherwise(deepest)
    companion = {
        "offset_base_sales": "base_sales_ly",
        "offset_base_date": "base_date",
        "offset_sales_promo": "sales_promo",
        "offset_sales_regular": "sales_regular",
        "offset_sales": "sales",
        "offset_date": "source_date",
        "offset_uplift": "uplift",
    }
    return (
        filled.join(nodes.select(*NODE, *LEVELS), NODE)
        .withColumn("calc_level", deepest)
        .select(
            "*",
            F.row_number().over(by_day).alias("day_index"),
            *[F.col(f"{COMPANION}.{s}").alias(n) for n, s in companion.items()],
        )
        .drop(COMPANION)
        .filter(~((F.col("day_index") == 1) & F.col("offset_uplift").isNull() & F.col("uplift").isNull()))
    )
