"""Five-level hierarchy roll-up, node statistics, quality gates and daily uplift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from festivo.config import LEVEL_NUMBER, LEVELS, NEVER_HOLIDAY, ROLLED_UP, GateRule
from festivo.functions.expressions import month_day, node_id, ratio
from festivo.operators.sales import MEASURES

NODE_KEY = ["country", "node_id", "store_cluster"]
DAY_ATTRIBUTES = ["is_base", "event_offset", "fiscal_year", "fiscal_week", "iso_date", "weekday", "is_holiday"]
LEVEL_KEY = ["country", "level", "node_id", *LEVELS, "store_cluster"]


def explode_levels(rows: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """One copy of each row per hierarchy level, lower levels replaced by '-'.

    A single expand ahead of one aggregation replaces one scan and shuffle per level.
    """
    copies = []
    for level in levels:
        depth = LEVEL_NUMBER[level]
        codes = [F.col(c) if i < depth else F.lit(ROLLED_UP) for i, c in enumerate(LEVELS)]
        copies.append(
            F.struct(F.lit(depth).alias("level"), *[c.alias(n) for c, n in zip(codes, LEVELS, strict=True)])
        )
    rest = [c for c in rows.columns if c not in (*LEVELS, "node_id", "level")]
    return (
        rows.select(*rest, F.explode(F.array(*copies)).alias("at"))
        .select(*rest, "at.*")
        .withColumn("node_id", node_id([F.col(c) for c in LEVELS]))
    )


def enforced_hierarchies(rows: DataFrame, enforced: DataFrame, event_id: str) -> DataFrame:
    """Attach the enforced flag of a country's listed nodes; the two coarsest levels are never enforced.

    ``rows``: rows of all levels, already aggregated. ``enforced``: event_id, country, node_id, level,
    enforce_calculation, exclusion_grp.
    """
    listed = enforced.filter(F.col("event_id") == event_id.upper())
    flags = listed.groupBy("country", "node_id").agg(F.max(F.col("enforce_calculation").cast("int")).alias("enforced"))
    flag = F.when(F.col("level") >= LEVEL_NUMBER["section"], F.coalesce("enforced", F.lit(0))).otherwise(F.lit(0))
    return rows.join(flags, ["country", "node_id"], "left").withColumn("enforced", flag)


def store_levels(baseline: DataFrame, enforced: DataFrame, event_id: str) -> DataFrame:
    """Daily totals per store of every node at all five levels, each level from the one below.

    Finest nodes on the exclusion list are left out of their group, but not of the levels above it: groups carry their
    totals with and without them. The rows are exchanged once, by country, division, cluster, day and store, which every
    level's key contains; the levels are then added up where they are.
    """
    listed = enforced.filter(F.col("event_id") == event_id.upper())
    excluded = (
        listed.filter((F.col("level").cast("int") == 5) & (F.col("exclusion_grp").cast("int") == 1))
        .select("country", "node_id", F.lit(True).alias("excluded"))
        .dropDuplicates()
    )
    sums = ("avg_products", *MEASURES)
    held = ["store_cluster", *DAY_ATTRIBUTES, "store"]
    rows = baseline.repartition("country", "division", "store_cluster", "iso_date", "is_base", "store")
    finest = rows.groupBy("country", *LEVELS, "node_id", *held).agg(*[F.sum(c).alias(c) for c in sums])
    marked = finest.join(excluded, ["country", "node_id"], "left").withColumn("kept", F.col("excluded").isNull())
    groups = marked.groupBy("country", *LEVELS[:4], *held).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.sum(F.when(F.col("kept"), F.col(c))).alias(f"kept_{c}") for c in sums],
        F.max("kept").alias("any_kept"),
    )
    at = {5: finest, 4: groups.filter("any_kept").select("country", *LEVELS[:4], *held, *[F.col(f"kept_{c}").alias(c) for c in sums])}
    below = groups
    for depth in (3, 2, 1):
        below = below.groupBy("country", *LEVELS[:depth], *held).agg(*[F.sum(c).alias(c) for c in sums])
        at[depth] = below
    parts = []
    for depth, level in at.items():
        codes = [F.col(c) if i < depth else F.lit(ROLLED_UP).alias(c) for i, c in enumerate(LEVELS)]
        parts.append(level.select(F.lit(depth).alias("level"), "country", *codes, *held, *sums))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.withColumn("node_id", node_id([F.col(c) for c in LEVELS]))


def hierarchy_rollup(baseline: DataFrame, enforced: DataFrame, event_id: str) -> DataFrame:
    """Store, then cluster totals of each day at all five levels.

    A store has one row per node and day, so counting stores is counting rows; the enforced flags join the totals.
    """
    per_store = store_levels(baseline, enforced, event_id)
    totals = per_store.groupBy(*LEVEL_KEY, *DAY_ATTRIBUTES).agg(
        F.count("*").alias("store_count"),
        F.sum((F.col("sales") == 0).cast("int")).alias("zero_count"),
        F.round(F.avg("avg_products"), 0).alias("avg_products"),
        *[F.sum(m).alias(m) for m in MEASURES],
    )
    return enforced_hierarchies(totals, enforced, event_id)


def node_window_stats(levels: DataFrame) -> DataFrame:
    """Counts, totals and ratios per node and cluster, and per node-week.

    Both windows share the node key, so the rows are exchanged once; a window holds the
    days of one node.
    """
    node = Window.partitionBy("level", *NODE_KEY)
    week = Window.partitionBy("level", *NODE_KEY, "fiscal_year", "fiscal_week")
    base = F.when(F.col("is_base") == 1, F.col("sales"))
    run_up = F.when((F.col("event_offset") <= 0) & (F.col("is_base") == 0), F.col("sales"))
    ordinary = F.when(
        (F.col("is_holiday") == 0) & (month_day(F.col("iso_date")) != NEVER_HOLIDAY), F.col("sales")
    )
    products = F.avg("avg_products").over(node)
    stats = levels.select(
        "*",
        F.count("sales").over(node).alias("n_rows"),
        F.sum("zero_count").over(node).alias("sum_zero_count"),
        F.sum("store_count").over(node).alias("sum_store_count"),
        F.sum("sales").over(node).alias("total_sales"),
        F.coalesce(
            ratio(F.sum("sales").over(node), F.count("sales").over(node) * F.col("store_count") * products),
            F.lit(0.0),
        ).alias("sales_ratio"),
        F.coalesce(
            ratio(F.sum(base).over(node), F.count(base).over(node) * F.col("store_count") * products), F.lit(0.0)
        ).alias("sales_ratio_base"),
        F.min(ordinary).over(node).alias("minimum_sales"),
        ratio(F.sum("sales_promo").over(node), F.sum("sales_regular").over(node)).alias("promo_ratio"),
        ratio(F.sum("sales_promo").over(week), F.sum("sales_regular").over(week)).alias("promo_ratio_weekly"),
        ratio(F.avg(run_up).over(node), F.avg(base).over(node)).alias("event_base_ratio"),
        ratio(F.col("sales"), F.sum("sales").over(week)).alias("day_share"),
    )
    return stats.withColumn("max_promo_ratio_weekly", F.max("promo_ratio_weekly").over(node))


def week_stats(gated: DataFrame) -> DataFrame:
    """Week total and its ratio to the base weeks, over the rows that passed the gate."""
    node = Window.partitionBy("level", *NODE_KEY)
    week = Window.partitionBy("level", *NODE_KEY, "fiscal_year", "fiscal_week")
    base = F.when(F.col("is_base") == 1, F.col("sales"))
    return gated.withColumn("week_sales", F.sum("sales").over(week)).withColumn(
        "week_ratio", ratio(F.col("week_sales"), F.sum(base).over(node))
    )


def gate_condition(rule: GateRule) -> Column:
    """Condition of one level's thresholds; a missing statistic fails its test."""
    n = F.col("n_rows")

    def all_of(tests: list[tuple[float | None, Column]]) -> Column:
        passed = F.lit(True)
        for limit, test in tests:
            if limit is not None:
                passed = passed & F.coalesce(test, F.lit(False))
        return passed

    ordinary = all_of(
        [
            (rule.min_ratio, F.col("sales_ratio") > rule.min_ratio),
            (rule.min_sales, F.col("minimum_sales") > rule.min_sales),
            (rule.sales_per_row, F.col("total_sales") > n * F.lit(rule.sales_per_row)),
            (
                rule.min_ratio_to_base,
                ratio(F.col("sales_ratio"), F.col("sales_ratio_base")) > rule.min_ratio_to_base,
            ),
            (rule.max_weekly_promo_ratio, F.col("max_promo_ratio_weekly") <= rule.max_weekly_promo_ratio),
            (rule.min_event_base_ratio, F.col("event_base_ratio") > rule.min_event_base_ratio),
        ]
    )
    if rule.enforced_min_sales is None:
        return ordinary
    relaxed = all_of(
        [
            (rule.enforced_min_sales, F.col("minimum_sales") > rule.enforced_min_sales),
            (rule.enforced_sales_per_row, F.col("total_sales") > n * F.lit(rule.enforced_sales_per_row)),
        ]
    )
    return F.when(F.col("enforced") == 1, relaxed).otherwise(ordinary)


def node_quality_gate(stats: DataFrame, gates: dict[str, GateRule]) -> DataFrame:
    """Keep rows of nodes that pass their level's thresholds."""
    keep = F.lit(False)
    for level, rule in gates.items():
        keep = F.when(F.col("level") == LEVEL_NUMBER[level], gate_condition(rule)).otherwise(keep)
    return stats.filter(keep)


def all_levels_uplift(gated: DataFrame, shift: DataFrame) -> DataFrame:
    """Daily uplift of every node against its base weekday, on last year's and this year's weekday.

    ``shift``: country, param, iso_date, fy_weekday from the shift calendar.
    """
    this_year = shift.select("country", F.col("param").alias("division"), "iso_date", F.col("fy_weekday").alias("shifted"))
    node = Window.partitionBy("level", *NODE_KEY)
    ly_day = Window.partitionBy("level", *NODE_KEY, "weekday")
    fy_day = Window.partitionBy("level", *NODE_KEY, "fy_weekday")
    base_sales = F.when(F.col("is_base") == 1, F.col("sales"))
    base_share = F.when(F.col("is_base") == 1, F.col("day_share"))
    rows = gated.join(this_year, ["country", "division", "iso_date"], "left").withColumn(
        "fy_weekday", F.when(F.col("is_base") == 1, F.col("weekday")).otherwise(F.col("shifted"))
    )
    rows = rows.select(
        *[c for c in rows.columns if c != "shifted"],
        F.sum(base_sales).over(ly_day).alias("base_sales_ly"),
        F.sum(base_share).over(ly_day).alias("base_share_ly"),
        F.first("iso_date").over(ly_day.orderBy("event_offset", "is_base")).alias("base_date"),
        F.sum(base_sales).over(fy_day).alias("base_sales_fy"),
        F.sum(base_share).over(fy_day).alias("base_share_fy"),
    )
    return rolling_forward_ratio(
        rows.withColumn("param", F.col("division")).withColumn("uplift", ratio(F.col("sales"), F.col("base_sales_ly"))),
        node,
        ["iso_date", "is_base"],
    )


def rolling_forward_ratio(series: DataFrame, node, order: Sequence[str], value: str = "sales") -> DataFrame:
    """Sum of the rows 5 to 8 ahead over the sum of the rows -2 to +1; 1 where undefined."""
    by_day = node.orderBy(*order)
    ahead = F.sum(value).over(by_day.rowsBetween(5, 8))
    around = F.sum(value).over(by_day.rowsBetween(-2, 1))
    return series.withColumn("forward_ratio", F.coalesce(ratio(ahead, around), F.lit(1.0)))
