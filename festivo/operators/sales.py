"""Promotion depth, adjusted sales, base weeks and event weeks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from festivo.config import LEVELS, RunConfig, monday_of
from festivo.functions.expressions import node_id, ratio, week_monday
from festivo.operators.calendar import holiday_flags

MEASURES = ("sales_promo", "sales_regular", "sales")
NODE = ["country", *LEVELS]


def promo_discount_depth(promos: DataFrame) -> DataFrame:
    """Saving of each promotion: the larger of the promo and club price cuts.

    ``zero_saving`` marks promotions that cut the price by less than 0.1 %.
    """

    def saving(price: str) -> Column:
        return F.coalesce(1 - F.round(ratio(F.col(price), F.col("price_normal")), 2), F.lit(0.0))

    return (
        promos.withColumn("saving_promo", saving("price_promo"))
        .withColumn("saving_club", saving("price_club"))
        .withColumn("saving", F.greatest("saving_promo", "saving_club"))
        .withColumn("zero_saving", (F.col("saving") < 0.001).cast("int"))
    )


def promo_coverage(sales: DataFrame, depth: DataFrame) -> DataFrame:
    """How many promotions, with and without a price cut, cover each sold product-day.

    The promotion intervals become +1 / -1 edges per product and day, and a running sum
    gives the open intervals on each sales day. Cost grows with promotions plus sales
    days, not with interval lengths, and a product's window holds at most one row a day.
    """
    key = ["country", "sku"]
    full, zero = (1 - F.col("zero_saving")), F.col("zero_saving")
    opens = depth.select(*key, F.col("promo_start").alias("sale_date"), full.alias("cut"), zero.alias("flat"))
    closes = depth.select(
        *key, F.date_add("promo_end", 1).alias("sale_date"), (-full).alias("cut"), (-zero).alias("flat")
    )
    days = sales.select(*key, "sale_date", F.lit(0).alias("cut"), F.lit(0).alias("flat"), F.lit(1).alias("sold"))
    edges = opens.unionByName(closes).withColumn("sold", F.lit(0)).unionByName(days)
    running = Window.partitionBy(*key).orderBy("sale_date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        edges.groupBy(*key, "sale_date")
        .agg(F.sum("cut").alias("cut"), F.sum("flat").alias("flat"), F.max("sold").alias("sold"))
        .select(
            *key,
            "sale_date",
            "sold",
            F.sum("cut").over(running).alias("n_cut"),
            F.sum("flat").over(running).alias("n_flat"),
        )
        .filter(F.col("sold") == 1)
        .drop("sold")
    )


def clustering_sales(
    sales: DataFrame, products: DataFrame, coef_section: DataFrame, coef_department: DataFrame
) -> DataFrame:
    """Sales per division, store and day with the section (else department) coefficient."""
    priced = (
        sales.join(products.select("sku", "division", "department", "section"), "sku")
        .join(coef_department, ["country", "department"])
        .join(coef_section, ["country", "department", "section"], "left")
    )
    factor = F.coalesce("coef_section", "coef_department").cast("double")
    return priced.groupBy("country", "division", "store", "sale_date").agg(
        F.sum(F.col("qty_regular") + F.col("qty_promo") * factor).alias("sales")
    )


def promo_adjusted_sales(
    sales: DataFrame,
    products: DataFrame,
    coef_section: DataFrame,
    coef_department: DataFrame,
    coef_division: DataFrame,
    depth: DataFrame,
) -> DataFrame:
    """Promo, regular and total sales per product, store and day.

    Promo quantities take the section coefficient, else the department's; under a
    promotion without a price cut the division's. A sale covered by several promotions
    counts once for each of them.
    """
    cover = promo_coverage(sales, depth)
    n_cut, n_flat = F.coalesce("n_cut", F.lit(0)), F.coalesce("n_flat", F.lit(0))
    uncovered = (n_cut + n_flat == 0).cast("int")
    factor = F.coalesce("coef_section", "coef_department").cast("double")
    flat_factor = F.coalesce(F.col("coef_zero").cast("double"), F.lit(0.0))
    return (
        sales.join(cover, ["country", "sku", "sale_date"], "left")
        .join(products.select("sku", *LEVELS), "sku")
        .join(coef_department, ["country", "department"])
        .join(coef_section, ["country", "department", "section"], "left")
        .join(coef_division, ["country", "division"], "left")
        .withColumn("times", n_cut + n_flat + uncovered)
        .withColumn(
            "sales_promo", F.col("qty_promo") * ((n_cut + uncovered) * factor + n_flat * flat_factor)
        )
        .withColumn("sales_regular", F.col("qty_regular") * F.col("times"))
        .withColumn("sales", F.col("sales_promo") + F.col("sales_regular"))
        .select(*NODE, "store", "sku", "sale_date", *MEASURES)
    )


def node_store_day(adjusted: DataFrame, clusters: DataFrame) -> DataFrame:
    """Adjusted sales per finest node, store and day, with the store's cluster.

    ``adjusted`` has one row per product, store and day, so products are counted as rows.
    """
    return (
        adjusted.groupBy(*NODE, "store", "sale_date")
        .agg(F.count("*").alias("n_products"), *[F.sum(m).alias(m) for m in MEASURES])
        .join(clusters.select("country", "division", "store", "store_cluster"), ["country", "division", "store"])
    )


def base_week_sales(node_days: DataFrame, timeline: DataFrame, holidays: DataFrame, cfg: RunConfig) -> DataFrame:
    """Average of the base weeks per weekday, dated in the latest base week.

    Sums are divided by the number of weeks given, also where a week has no row.
    ``timeline``: last year's event days, from the latest base week on.
    """
    mondays = [monday_of(w) for w in cfg.base_weeks]
    n_weeks = len(cfg.base_weeks)
    latest = F.lit(cfg.base_monday)
    weekday = (F.weekday("sale_date") + 1).alias("weekday")
    in_base = week_monday(F.col("sale_date")).isin(mondays)
    base = (
        node_days.filter(in_base)
        .groupBy(*NODE, "store", "store_cluster", weekday)
        .agg(
            F.max("n_products").alias("n_products"),
            *[(F.sum(m) / n_weeks).alias(m) for m in MEASURES],
        )
        .withColumn("iso_date", F.date_add(latest, F.col("weekday") - 1))
    )
    return _dated(base, timeline, holidays).withColumn("is_base", F.lit(1))


def event_period_sales(node_days: DataFrame, timeline: DataFrame, holidays: DataFrame) -> DataFrame:
    """Sales of last year's event weeks, in each country's and division's own day range."""
    event = node_days.withColumnRenamed("sale_date", "iso_date").withColumn("weekday", F.weekday("iso_date") + 1)
    return _dated(event, timeline.filter("in_event"), holidays).withColumn("is_base", F.lit(0))


def _dated(rows: DataFrame, timeline: DataFrame, holidays: DataFrame) -> DataFrame:
    """Rows on the event's days, with fiscal year and week, the country's holiday flag and the offset to the event."""
    days = timeline.select("country", "division", "iso_date", "event_offset")
    return (
        rows.join(days, ["country", "division", "iso_date"])
        .join(holiday_flags(holidays, "iso_date"), ["country", "iso_date"], "left")
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
        .withColumn("fiscal_year", F.extract(F.lit("yearofweek"), F.col("iso_date")).cast("int"))
        .withColumn("fiscal_week", F.lpad(F.weekofyear("iso_date").cast("string"), 2, "0"))
    )


BASELINE_COLUMNS = (
    *NODE,
    "store",
    "store_cluster",
    "is_base",
    "event_offset",
    "fiscal_year",
    "fiscal_week",
    "iso_date",
    "weekday",
    "is_holiday",
    "n_products",
    *MEASURES,
)


def baseline_union(base: DataFrame, event: DataFrame) -> DataFrame:
    """Base and event rows with node id and the node's average product count per store."""
    rows = base.select(*BASELINE_COLUMNS).unionByName(event.select(*BASELINE_COLUMNS))
    per_store = Window.partitionBy("country", "node_id", "store")
    return rows.withColumn("node_id", node_id([F.col(c) for c in LEVELS])).withColumn(
        "avg_products", F.avg("n_products").over(per_store)
    )


def base_day_spans(cfg: RunConfig) -> list[tuple]:
    """First and last day of each base week, for the scan's filter."""
    mondays = [monday_of(w) for w in cfg.base_weeks]
    return [(m, m + timedelta(days=6)) for m in mondays]
