"""Store clustering by size of range and shape of event demand."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from festivo.config import CLUSTERING_EXCLUDED_DAYS, MODEL_STORE_RANGE, RunConfig
from festivo.functions.expressions import month_day, ratio, week_monday

PERCENTILES = {"p25": 0.25, "p50": 0.5, "p65": 0.65, "p80": 0.8}
CLUSTER_OFFSETS = tuple(range(-9, 0))


def exact_percentiles(rows: DataFrame, keys: Sequence[str], value: str, names: dict[str, float]) -> DataFrame:
    """Exact interpolated percentiles per key, from how often each value occurs.

    Equal values are counted before they are exchanged, and a percentile weighs each value by its count, so no step holds
    a group's rows.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_times"))
    found = counts.groupBy(*keys).agg(*[F.percentile(value, F.lit(p), F.col("_times")).alias(n) for n, p in names.items()])
    return rows.select(*keys).dropDuplicates().join(found, list(keys), "left")


def distinct_per_key(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Exact number of distinct values of a dense whole-number column per key, as (keys, n_distinct).

    Values are set as bits of one bitmap per key and range of 32,768 numbers; bitmaps merge ahead of the exchange and
    of one another, so what is exchanged is bounded by the numbers in use and not by the rows.
    """
    bits = rows.groupBy(*keys, F.bitmap_bucket_number(number).alias("_range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")
    )
    return bits.groupBy(*keys).agg(F.sum(F.bitmap_count("_bits")).alias("n_distinct"))


def store_range_size(product_range: DataFrame, stores: DataFrame, as_of: date, min_products: int = 100) -> DataFrame:
    """Number of products a store ranges on a day, and Small-/Large- against the country median.

    Only stores of the model: a number in range, opened by the day, not closing within sixty days, with an area.
    """
    day = F.lit(as_of)
    counted = stores.filter(
        F.col("store_number").between(*MODEL_STORE_RANGE)
        & F.col("net_area").isNotNull()
        & (F.col("open_date") <= day)
        & (F.col("close_date").isNull() | (F.col("close_date") >= F.date_add(day, 60)))
    )
    valid = product_range.filter(
        (F.col("valid_from") <= day) & ((F.col("valid_to") >= day) | F.col("valid_to").isNull())
    )
    counts = (
        distinct_per_key(valid, ["country", "store"], "sku")
        .withColumnRenamed("n_distinct", "n_products")
        .filter(F.col("n_products") > min_products)
        .join(counted.select("country", "store"), ["country", "store"], "left_semi")
    )
    median = exact_percentiles(counts, ["country"], "n_products", {"median_products": 0.5})
    return counts.join(median, "country").withColumn(
        "cluster_size",
        F.when(F.col("n_products") < F.col("median_products"), "Small-").otherwise("Large-"),
    )


def store_day_uplift(sales: DataFrame, sizes: DataFrame, timeline: DataFrame, cfg: RunConfig) -> DataFrame:
    """Daily uplift per division and store against its first seven days.

    ``sales``: one row per country, division, store and day. The base of a day is the
    store's sales on that weekday among its first seven rows. ``timeline``: last year's event days, which
    say which days count, from the latest base week on, and how far they are from the event.
    """
    days = timeline.filter(F.col("iso_date") >= F.lit(cfg.base_monday))
    days = days.select("country", "division", F.col("iso_date").alias("sale_date"), "event_offset")
    store = Window.partitionBy("country", "division", "store")
    by_day = store.orderBy("sale_date")
    week = Window.partitionBy("country", "division", "store", "week_start")
    weekday = Window.partitionBy("country", "division", "store", "weekday")
    early = F.when(F.col("row_n") <= 7, F.col("sales"))
    return (
        sales.filter(~month_day(F.col("sale_date")).isin(*CLUSTERING_EXCLUDED_DAYS))
        .join(days, ["country", "division", "sale_date"])
        .join(sizes.select("country", "store", "cluster_size"), ["country", "store"])
        .withColumn("weekday", F.weekday("sale_date") + 1)
        .withColumn("week_start", week_monday(F.col("sale_date")))
        .withColumn("row_n", F.row_number().over(by_day))
        .withColumn("n_days", F.count("sales").over(store))
        .withColumn("minimum_sales", F.min("sales").over(store))
        .withColumn("week_sales", F.sum("sales").over(week))
        .withColumn("day_share", ratio(F.col("sales"), F.col("week_sales")))
        .filter(F.col("week_sales") > cfg.min_week_sales)
        .withColumn("base_sales", F.sum(early).over(weekday))
        .withColumn("uplift", F.coalesce(ratio(F.col("sales"), F.col("base_sales")), F.lit(0.0)))
        .withColumn(
            "is_weekend",
            (F.col("weekday").isin(6, 7) & ~F.col("event_offset").isin(-1, -2)).cast("int"),
        )
    )


def uplift_percentiles(uplift: DataFrame) -> DataFrame:
    """Exact percentiles of uplift per division, offset and size, and of weekend uplift.

    Percentiles of value counts joined back instead of windows: the groups are the stores of one
    country and division, and the row stream is not sorted again for every percentile.
    """
    near = uplift.filter(F.col("event_offset").between(CLUSTER_OFFSETS[0], CLUSTER_OFFSETS[-1]))
    store = Window.partitionBy("country", "division", "store")
    near = near.withColumn("uplift_weekend", F.sum(F.when(F.col("is_weekend") == 1, F.col("uplift"))).over(store))
    day_key = ["country", "division", "event_offset", "cluster_size"]
    weekend_key = ["country", "division", "is_weekend", "cluster_size"]
    by_day = exact_percentiles(near, day_key, "uplift", {f"{n}_day": p for n, p in PERCENTILES.items()})
    by_weekend = exact_percentiles(near, weekend_key, "uplift_weekend", {f"{n}_weekend": p for n, p in PERCENTILES.items()})
    return (
        near.join(by_day, day_key)
        .join(by_weekend, weekend_key)
        .withColumn("weak_weekend", (F.col("uplift_weekend") <= F.col("p25_weekend")).cast("int"))
    )


def store_shape_cluster(percentiles: DataFrame, small_cluster: int = 6) -> DataFrame:
    """Size and shape cluster of each store per division; thin clusters merge into Moderate."""

    def at(offset: int, column: str):
        return F.max(F.when(F.col("event_offset") == offset, F.col(column)))

    wide = percentiles.groupBy("country", "store", "division", "cluster_size").agg(
        F.max(F.when(F.col("weak_weekend") == 1, 1)).alias("weak_weekend"),
        at(-1, "uplift").alias("uplift_1"),
        at(-2, "uplift").alias("uplift_2"),
        at(-3, "uplift").alias("uplift_3"),
        at(-1, "p50_day").alias("p50_1"),
        at(-2, "p65_day").alias("p65_2"),
        at(-2, "p80_day").alias("p80_2"),
        at(-3, "p80_day").alias("p80_3"),
    )
    shape = (
        F.when(
            (F.col("uplift_2") >= F.col("p80_2")) & (F.col("uplift_3") >= F.col("p80_3")), F.lit("Heavy")
        )
        .when((F.col("uplift_1") >= F.col("p50_1")) & (F.col("uplift_2") >= F.col("p65_2")), F.lit("Intense"))
        .when(F.col("weak_weekend").isNull(), F.lit("Moderate"))
        .otherwise(F.lit("Weak"))
    )
    first = Window.partitionBy("country", "division", "shaped_cluster")
    final = Window.partitionBy("country", "division", "store_cluster")
    merges = F.col("shape").isin("Weak", "Intense") & (F.col("n_shaped") <= small_cluster)
    return (
        wide.withColumn("shape", shape)
        .withColumn("shaped_cluster", F.concat("cluster_size", "shape"))
        .withColumn("n_shaped", F.count("*").over(first))
        .withColumn(
            "store_cluster",
            F.when(merges, F.concat("cluster_size", F.lit("Moderate"))).otherwise(F.col("shaped_cluster")),
        )
        .withColumn("cluster_stores", F.count("*").over(final))
        .select("country", "store", "division", "shaped_cluster", "store_cluster", "cluster_stores")
    )
