"""Smoothing of daily series and the multi-year event profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from festivo.config import FACTOR_CAP, LEVEL_NUMBER, RunConfig
from festivo.functions.expressions import clamp, ratio
from festivo.operators.calendar import holiday_flags
from festivo.operators.events import aligned_days
from festivo.operators.rollup import LEVEL_KEY, NODE_KEY, explode_levels
from festivo.operators.sales import NODE


def centered_moving_average(
    series: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "sales"
) -> DataFrame:
    """Six-row mean, two-row mean of it, and the capped seasonal factor 1 - CMA / value."""
    by_day = Window.partitionBy(*keys).orderBy(*order)
    return (
        series.withColumn("ma_6", F.avg(value).over(by_day.rowsBetween(-3, 2)))
        .withColumn("cma", F.avg("ma_6").over(by_day.rowsBetween(0, 1)))
        .withColumn("cma_ratio", ratio(F.col("cma"), F.col(value)))
        .withColumn("seasonal_factor", clamp(1 - F.col("cma_ratio"), -FACTOR_CAP, FACTOR_CAP))
    )


def aligned_multi_year_sales(
    node_days: DataFrame, controls: DataFrame, holidays: DataFrame, cfg: RunConfig
) -> DataFrame:
    """Sales of the normalisation years aligned on the day offset to each year's event.

    One join against the aligned-day table serves all years.
    """
    days = aligned_days(controls, cfg.ly_year, cfg.norm_years)
    return (
        node_days.join(days, ["country", "division", "sale_date"])
        .join(holiday_flags(holidays, "sale_date"), ["country", "sale_date"], "left")
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
        .withColumn("fiscal_year", F.extract(F.lit("yearofweek"), F.col("sale_date")).cast("int"))
        .groupBy(*NODE, "store_cluster", "norm_year", "fiscal_year", "event_offset", "is_peak", "is_holiday")
        .agg(F.sum("sales").alias("sales"))
    )


def minmax_normalise(aligned: DataFrame) -> DataFrame:
    """Scale each node-year to its range, add up the years, and compare with the period's mean.

    Years are fiscal years. The minimum is taken over non-holidays, a holiday scores 0,
    and the mean over the peak or off-peak days leaves zeros out. Above the finest level
    two aligned years that meet in one fiscal year and offset are added before scaling.
    """
    level_rows = (
        explode_levels(aligned)
        .withColumn("arm", F.when(F.col("level") == LEVEL_NUMBER["subgroup"], F.col("norm_year")))
        .groupBy(*LEVEL_KEY, "arm", "fiscal_year", "event_offset", "is_peak", "is_holiday")
        .agg(F.sum("sales").alias("sales"))
    )
    year = Window.partitionBy("level", *NODE_KEY, "fiscal_year")
    low = F.min(F.when(F.col("is_holiday") == 0, F.col("sales"))).over(year)
    high = F.max("sales").over(year)
    scaled = level_rows.withColumn(
        "scaled",
        F.when(F.col("is_holiday") == 1, F.lit(0.0)).otherwise(ratio(F.col("sales") - low, high - low)),
    )
    period = Window.partitionBy("level", *NODE_KEY, "is_peak")
    mean = F.avg(F.when(F.col("norm_sales") != 0, F.col("norm_sales"))).over(period)
    return (
        scaled.groupBy(*LEVEL_KEY, "event_offset", "is_peak")
        .agg(F.sum("scaled").alias("norm_sales"))
        .withColumn("mean_norm", mean)
        .withColumn("norm_deviation", ratio(F.col("norm_sales") - F.col("mean_norm"), F.col("mean_norm")))
    )


def norm_union_cap(levels: DataFrame) -> DataFrame:
    """Cap the deviation; the levels already share one table."""
    return levels.withColumn("norm_factor", clamp(F.col("norm_deviation"), -FACTOR_CAP, FACTOR_CAP))


