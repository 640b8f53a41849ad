"""Choose coefficients, blend the factors, and publish the daily targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.config import (
    BASE_SHARE_ONLY_DAYS,
    FIRST_DAY_DAMPING,
    FIRST_DAY_MIN_UPLIFT,
    FIXED_DATE_DAYS,
    KEPT_SECTIONS_OF_PARTLY_EXCLUDED,
    LEVELS,
    PARTLY_EXCLUDED_DEPARTMENT,
    PLACEHOLDER_COUNTRY,
    ROLLED_UP,
    TARGET_CEILING,
    TARGET_FLOOR,
    RunConfig,
)
from festivo.functions.expressions import clamp, month_day, total_of
from festivo.operators.calendar import COEFFICIENTS, EVENT_KEY

USER_SCHEMA = (
    "event_id string, country string, node_id string, iso_date date, store_cluster string, final_target double"
)


def coefficient_select(rows: DataFrame, controls: DataFrame, cfg: RunConfig) -> DataFrame:
    """Per row the four uplift and two share coefficients that its day calls for."""
    own = controls.filter(F.col("year") == cfg.ly_year).select(
        *EVENT_KEY,
        F.col("offset_from").alias("e_from"),
        F.col("offset_to").alias("e_to"),
        "offset2_from",
        "offset2_to",
        *[F.col(c).cast("double").alias(c) for c in COEFFICIENTS],
    )
    day = F.col("event_offset")
    peak = day.between(F.col("e_from"), F.col("e_to"))
    second = day.between(F.col("offset2_from"), F.col("offset2_to"))
    special, plain = F.col("ly_is_special") == 1, F.col("ly_is_special") == 0
    like_holiday = (F.col("days_shift") == 0) | (special & peak) | (plain & second)
    unknown_shift = F.coalesce(like_holiday, F.lit(False))
    in_peak = F.coalesce(plain & peak, F.lit(False))

    def chosen(holiday_like: str | None, peak_value: str, other: str | None):
        def value(name):
            return F.col(name) if name else F.lit(None).cast("double")

        return (
            F.when(F.col("is_holiday"), F.lit(0.0))
            .when(unknown_shift, value(holiday_like))
            .when(in_peak, value(peak_value))
            .otherwise(value(other))
        )

    md = month_day(F.col("iso_date"))
    base_only = F.coalesce((F.col("days_shift") == 0) | (day == 0) | md.isin(*BASE_SHARE_ONLY_DAYS), F.lit(False))
    shared = F.coalesce(
        day.between(F.col("offset_from"), F.col("offset_to")), F.lit(False)
    ) | md.isin(*FIXED_DATE_DAYS)
    return rows.join(own, EVENT_KEY, "left").select(
        *rows.columns,
        chosen("c_off_bh_uplift", "c_off_uplift", "c_uplift").alias("coef_uplift"),
        chosen(None, "c_off_offset_uplift", None).alias("coef_offset_uplift"),
        chosen("c_off_bh_seasonal", "c_off_seasonal", "c_seasonal").alias("coef_seasonal"),
        chosen("c_off_bh_norm", "c_off_norm", "c_norm").alias("coef_norm"),
        F.when(base_only, F.col("c_share_base"))
        .when(shared, F.col("c_off_share_base"))
        .otherwise(F.col("c_share_base"))
        .alias("coef_share_base"),
        F.when(base_only, F.lit(None).cast("double"))
        .when(shared, F.col("c_off_share_offset"))
        .alias("coef_share_offset"),
    )


def hierarchy_code_map(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Stock-group code of each country's node; a missing level of the mapping matches a rolled-up one."""
    keyed = mapping.select("country", *[F.coalesce(c, F.lit(ROLLED_UP)).alias(c) for c in LEVELS], "sg_cd")
    return rows.join(keyed, ["country", *LEVELS], "left").withColumn("sg_cd", F.coalesce("sg_cd", F.lit(ROLLED_UP)))


def blend_uplift(rows: DataFrame, cfg: RunConfig) -> DataFrame:
    """Weighted uplift, and the draft target: uplift times weighted base share, bounded.

    The first row of a node on a fixed date is damped when its uplift is strong; a
    holiday's target is 0. Departments on the exclusion list are left out, one of them
    except for a few sections.
    """
    damped = F.col("uplift") * FIRST_DAY_DAMPING
    first_fixed = (
        (F.col("day_index") == 1)
        & month_day(F.col("iso_date")).isin(*FIXED_DATE_DAYS)
        & (F.col("uplift") > FIRST_DAY_MIN_UPLIFT)
        & (damped > 1)
    )
    used_uplift = F.when(first_fixed, damped).otherwise(F.col("uplift"))
    uplift = total_of(
        [
            used_uplift * F.col("coef_uplift"),
            F.col("offset_uplift") * F.col("coef_offset_uplift"),
            F.col("seasonal_factor") * F.col("coef_seasonal"),
            F.col("norm_factor") * F.col("coef_norm"),
        ]
    )
    share = total_of(
        [
            F.col("base_share_ly") * F.col("coef_share_base"),
            F.col("base_share_fy") * F.col("coef_share_offset"),
        ]
    )
    no_offset = F.coalesce(F.col("coef_offset_uplift"), F.lit(0.0)) == 0
    no_share = F.coalesce(F.col("coef_share_offset"), F.lit(0.0)) == 0
    department = F.col("department")
    kept = ~department.isin(*cfg.excluded_departments) | (
        (department == PARTLY_EXCLUDED_DEPARTMENT) & F.col("section").isin(*KEPT_SECTIONS_OF_PARTLY_EXCLUDED)
    )
    hidden = [
        "offset_base_sales",
        "offset_base_date",
        "offset_sales_promo",
        "offset_sales_regular",
        "offset_sales",
        "offset_date",
        "offset_uplift",
    ]
    out = rows.filter(kept & F.col("node_id").isNotNull()).withColumn("final_uplift", uplift)
    out = out.withColumn(
        "draft_target",
        F.when(F.col("is_holiday"), F.lit(0.0)).otherwise(
            clamp(F.col("final_uplift") * share, TARGET_FLOOR, TARGET_CEILING)
        ),
    )
    for name in hidden:
        out = out.withColumn(name, F.when(~no_offset, F.col(name)))
    return (
        out.withColumn("base_share_fy", F.when(~no_share, F.col("base_share_fy")))
        .withColumn("event_id", F.lit(cfg.event_id_key))
        .withColumn("target_type", F.lit("SYSTEM"))
        .dropDuplicates()
    )


def user_override_schema(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Typed table of user targets with its placeholder row."""
    from datetime import date

    return spark.createDataFrame(
        [(cfg.event_id, PLACEHOLDER_COUNTRY, "0", date(2099, 12, 31), "0", 0.0)], USER_SCHEMA
    )


def final_targets(model: DataFrame, user: DataFrame) -> DataFrame:
    """System and user targets in percent, the placeholder left out."""
    columns = ["event_id", "country", "node_id", "iso_date", "store_cluster", "target_type", "final_target"]
    system = model.withColumn("final_target", F.col("draft_target") * 100)
    chosen = user.withColumn("target_type", F.lit("USER")).withColumn(
        "final_target", F.col("final_target").cast("decimal(10,3)").cast("double") * 100
    )
    return (
        system.select(*columns)
        .unionByName(chosen.select(*columns))
        .filter(F.col("country") != PLACEHOLDER_COUNTRY)
    )
