"""Allocate targets to promotions by store, product and day, and shape the upload."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from festivo.config import (
    LEVELS,
    PROMO_WEEKS,
    UPLOAD_CAPPED,
    UPLOAD_CEILING,
    WEEKDAY_NAMES,
    RunConfig,
)
from festivo.functions.expressions import any_of, pick_by_weekday, ratio, year_week
from festivo.operators.calendar import DAY_COLUMNS, on_calendar

TARGET_COLUMNS = tuple(f"target_{n}" for n in range(1, 8))
PROMO_STORE = ["country", "promo_code", "sku", "promo_start", "promo_end", "store"]
WIDE_KEY = ["country", "store", "sku", "promo_start", "promo_end"]


def promo_day_explode(base: DataFrame, calendar: DataFrame, cfg: RunConfig) -> DataFrame:
    """One row per promotion day with its fiscal day and whether the model covers it.

    The interval is expanded in place and looked up by equality, so no range join is
    planned. A re-upload keeps the chosen week only.
    """
    ordered = F.when(
        F.col("promo_end") >= F.col("promo_start"), F.sequence("promo_start", "promo_end")
    )
    named = {c: c for c in ("fiscal_year", "fiscal_week", "weekday")}
    rows = on_calendar(base.withColumn("promo_date", F.explode_outer(ordered)), calendar, "promo_date", named)
    name = F.get(F.array(*map(F.lit, WEEKDAY_NAMES)), F.col("weekday") - 1)
    rows = rows.withColumn("weekday_name", name)
    if cfg.week_reupload and cfg.promo_week is not None:
        rows = rows.filter(year_week(F.col("fiscal_year"), F.col("fiscal_week")) == cfg.promo_week)
    if "scope_from" in base.columns:
        inside = F.col("promo_date").between(F.col("scope_from"), F.col("scope_to"))
        rows = rows.withColumn("is_in_scope", F.when(inside, 1).otherwise(0))
    return rows


def promo_day_rank(rows: DataFrame) -> DataFrame:
    """Day index within the promotion and its week 1 to 10; later weeks are 0."""
    index = F.datediff("promo_date", "promo_start") + 1
    week = F.greatest(F.ceil(index / 7), F.lit(1)).cast("int")
    return rows.withColumn("promo_day", index).withColumn(
        "promo_week", F.when(index <= 7 * PROMO_WEEKS, week).otherwise(0)
    )


def weekday_column_select(rows: DataFrame, grid: DataFrame) -> DataFrame:
    """Open flag of the row's weekday from the store's week; rows without a grid row drop out.

    Where several grid rows speak for one store-week (two projections, or the two weeks
    folded into week 01) a weekday is open when any of them says so; a promotion day is
    never multiplied.
    """
    keys = ["country", "store_number", "fiscal_year", "fiscal_week"]
    merged = grid.groupBy(*keys).agg(*[F.max(d).alias(d) for d in DAY_COLUMNS])
    return rows.join(merged, keys).withColumn(
        "store_open", pick_by_weekday(F.col("weekday"), [F.col(d) for d in DAY_COLUMNS])
    ).drop(*DAY_COLUMNS)


def resolve_targets(base: DataFrame, targets: DataFrame) -> DataFrame:
    """Most specific target per finest node, cluster and day.

    From subgroup up to division, and at each level the user's before the system's. Only
    the distinct node, cluster and day combinations that promotions reach and that have
    any target are looked up, one row per level, so stores and overlapping promotions do
    not multiply the work.
    """
    nodes = [f"node_{level}" for level in LEVELS]
    day = F.explode(F.when(F.col("promo_end") >= F.col("promo_start"), F.sequence("promo_start", "promo_end")))
    dates = targets.select(F.col("iso_date").alias("promo_date")).dropDuplicates()
    key = ["country", "node_subgroup", "store_cluster", "promo_date"]
    reached = (
        base.select("country", *nodes, "store_cluster", "promo_start", "promo_end")
        .dropDuplicates(["country", "node_subgroup", "store_cluster", "promo_start", "promo_end"])
        .select("country", *nodes, "store_cluster", day.alias("promo_date"))
        .join(dates, "promo_date", "left_semi")
        .dropDuplicates(key)
    )
    levels = F.array(
        *[F.struct(F.lit(2 * i).alias("rank"), F.col(n).alias("node_id")) for i, n in enumerate(reversed(nodes))]
    )
    melted = reached.select(*key, F.explode(levels).alias("a")).select(*key, "a.*")
    offered = targets.filter(F.col("final_target").isNotNull()).select(
        "country",
        "node_id",
        "store_cluster",
        F.col("iso_date").alias("promo_date"),
        F.when(F.col("target_type") == "USER", 0).otherwise(1).alias("by_user"),
        "final_target",
    )
    return (
        melted.join(offered, ["country", "node_id", "store_cluster", "promo_date"])
        .groupBy(*key)
        .agg(F.min_by("final_target", F.col("rank") + F.col("by_user")).alias("target"))
    )


def target_fallback_lookup(rows: DataFrame, base: DataFrame, targets: DataFrame) -> DataFrame:
    """Attach the most specific target: one join instead of one per level and type.

    ``base``: the promotion x store rows the day rows come from. A node's and cluster's targets travel as one map of the
    event's days, so the days of a promotion and store are exchanged side by side, where the columns that they share pack well.
    """
    key = ["country", "node_subgroup", "store_cluster"]
    dated = F.map_from_entries(F.collect_list(F.struct("promo_date", "target"))).alias("_targets")
    of_days = resolve_targets(base, targets).groupBy(*key).agg(dated)
    found = rows.join(of_days, key, "left").withColumn("target", F.try_element_at("_targets", F.col("promo_date")))
    return found.select(*key, "promo_date", *[c for c in found.columns if c not in (*key, "promo_date", "_targets")])


def reachable_days(rows: DataFrame, targets: DataFrame, cfg: RunConfig) -> DataFrame:
    """Drop days that can get no value: no target on that date and no fallback division.

    The dates are few, so this thins out the rows before the joins that shuffle them.
    """
    dates = targets.select(F.col("iso_date").alias("promo_date"), F.lit(True).alias("has_target")).dropDuplicates()
    return (
        rows.join(dates, "promo_date", "left")
        .filter(F.col("has_target").isNotNull() | (F.col("division") == cfg.base_promo_division))
        .drop("has_target")
    )


def base_promo_target(rows: DataFrame, weekday_values: DataFrame, week_coefficients: DataFrame, cfg: RunConfig) -> DataFrame:
    """Fallback target of one division: weekday value times promo-week coefficient.

    Weekday values fall back from section to department to the store's overall row
    (code '0'). Later promo weeks use their coefficient only when no leaflet falls in
    them. Rows with neither a model target nor a fallback drop out; those of other
    divisions already ahead of the joins.
    """
    rows = rows.filter(F.col("target").isNotNull() | (F.col("division") == cfg.base_promo_division))
    division = F.lit(cfg.base_promo_division).alias("division")
    days = [F.col(d) for d in DAY_COLUMNS]
    active = weekday_values.filter(F.col("is_active") == 1)
    by_section = active.select("country", division, "department", "section", "store", F.struct(*days).alias("in_section"))
    by_department = active.filter(F.col("section") == "0").select(
        "country", division, "department", "store", F.struct(*days).alias("in_department")
    )
    overall = active.filter((F.col("department") == "0") & (F.col("section") == "0")).select(
        "country", division, "store", F.struct(*days).alias("in_store")
    )
    coefficients = week_coefficients.select(
        "country",
        "department",
        "section",
        F.array(*[F.col(f"coef_w{n}") for n in range(1, PROMO_WEEKS + 1)]).alias("coefs"),
    )
    leaflet = F.get(F.array(*[F.col(f"leaflet_w{n}") for n in range(1, PROMO_WEEKS + 1)]), F.col("promo_week") - 1)
    value = pick_by_weekday(
        F.col("weekday"),
        [F.coalesce(*[F.col(f"{s}.{d}") for s in ("in_section", "in_department", "in_store")]) for d in DAY_COLUMNS],
    )
    coefficient = (
        F.when(F.col("promo_week") == 1, F.get("coefs", F.lit(0)))
        .when((F.col("promo_week") > 1) & (leaflet == 0), F.get("coefs", F.col("promo_week") - 1))
        .otherwise(F.lit(1.0))
    )
    return (
        rows.join(by_section, ["country", "division", "department", "section", "store"], "left")
        .join(by_department, ["country", "division", "department", "store"], "left")
        .join(overall, ["country", "division", "store"], "left")
        .join(coefficients, ["country", "department", "section"], "left")
        .withColumn("base_promo_value", value)
        .withColumn("base_promo_coefficient", coefficient)
        .withColumn(
            "target_all",
            F.coalesce(F.col("target"), F.col("base_promo_value") * F.col("base_promo_coefficient")),
        )
        .filter(F.col("target_all").isNotNull())
        .drop("in_section", "in_department", "in_store", "coefs")
    )


def closed_day_redistribution(rows: DataFrame) -> DataFrame:
    """Move the targets of closed days to the open days around them, in date order.

    A day belongs to the pool of its product's promotion interval and store when it or one of the
    next three rows or the row before is closed; promotions that share an interval share a pool, and follow one another
    by code on each day. Pool sums are conditional sums over that one key, so days outside every pool never gather in
    a partition of their own.
    """
    key = Window.partitionBy(*WIDE_KEY)
    by_day = key.orderBy("promo_date", "promo_code")
    closed = F.col("store_open") == 0
    neighbours = [F.lead("store_open", n).over(by_day) == 0 for n in (1, 2, 3)] + [
        F.lag("store_open", 1).over(by_day) == 0
    ]
    pooled = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in (closed, *neighbours)])
    value = F.col("target_all")
    kept = value * F.col("store_open")
    return (
        rows.withColumn("is_pooled", pooled)
        .withColumn("pool_lost", F.sum(F.when(F.col("is_pooled"), value - kept)).over(key))
        .withColumn("pool_kept", F.sum(F.when(F.col("is_pooled"), kept)).over(key))
        .withColumn(
            "target_final",
            F.coalesce(
                F.when(F.col("is_pooled"), kept + F.col("pool_lost") * ratio(kept, F.col("pool_kept"))).otherwise(kept),
                F.lit(0.0),
            ),
        )
        .drop("pool_lost", "pool_kept")
    )


def weekday_pivot(rows: DataFrame) -> DataFrame:
    """Day rows to seven columns per store, product, week and promotion interval.

    Where promotions share an interval the smallest promotion code speaks, and where two
    weeks fold into one the earlier day. The first aggregation keeps the promotion and
    store key of the redistribution, so only week rows are exchanged for the second.
    """
    week = ["code", "fiscal_year", "fiscal_week", "start_week", "end_week"]

    def earliest(n: int) -> Column:
        counts = (F.col("weekday") == n) & F.col("target_final").isNotNull()
        return F.min_by("target_final", F.when(counts, F.col("promo_date"))).alias(f"target_{n}")

    def smallest_code(n: int) -> Column:
        t = F.col(f"target_{n}")
        return F.min_by(t, F.when(t.isNotNull(), F.col("promo_code"))).alias(f"target_{n}")

    per_promo = rows.groupBy(*PROMO_STORE, *week).agg(*[earliest(n) for n in range(1, 8)])
    return per_promo.groupBy(*WIDE_KEY, *week).agg(*[smallest_code(n) for n in range(1, 8)])


def week_edge_backfill(wide: DataFrame, plans: DataFrame) -> DataFrame:
    """Fill empty days: start and end week from their own plans, then the system plan.

    All plan sources sit on the base row of the promotion and store, so one join
    replaces one self-join per source.
    """
    sources = [
        f"{s}_{d}" for s in ("start", "end", "regular_start", "regular_end", "plan") for d in DAY_COLUMNS
    ]
    base = plans.select(*WIDE_KEY, *sources).dropDuplicates()
    week = year_week(F.col("fiscal_year"), F.col("fiscal_week"))
    rows = wide.join(base, WIDE_KEY, "left")

    def filled(n: int) -> Column:
        own, plan = F.col(f"target_{n}"), F.col(f"plan_day_{n}")
        return (
            F.when(
                week == F.col("start_week"),
                F.coalesce(own, F.col(f"start_day_{n}"), F.col(f"regular_start_day_{n}"), plan),
            )
            .when(
                week == F.col("end_week"),
                F.coalesce(own, F.col(f"end_day_{n}"), F.col(f"regular_end_day_{n}"), plan),
            )
            .otherwise(F.coalesce(own, plan))
        )

    others = [c for c in wide.columns if c not in TARGET_COLUMNS]
    return rows.select(*others, *[filled(n).alias(f"target_{n}") for n in range(1, 8)])


def holiday_override_wide(wide: DataFrame, holiday_weeks: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """A bank holiday's 0 replaces the day's target."""
    others = [c for c in wide.columns if c not in TARGET_COLUMNS]
    return wide.join(holiday_weeks, [*keys, "fiscal_year", "fiscal_week"], "left").select(
        *others, *[F.coalesce(F.col(f"day_{n}"), F.col(f"target_{n}")).alias(f"target_{n}") for n in range(1, 8)]
    )


def latest_promo_per_week(wide: DataFrame, cfg: RunConfig) -> DataFrame:
    """Number the promotions of a store, product and week from the latest start; a re-upload keeps the first."""
    newest = Window.partitionBy("country", "store", "sku", "fiscal_year", "fiscal_week").orderBy(
        F.col("promo_start").desc(), F.col("promo_end").desc(), "code"
    )
    numbered = wide.withColumn("recency", F.row_number().over(newest))
    return numbered.filter(F.col("recency") == 1) if cfg.week_reupload else numbered


def upload_extract(wide: DataFrame) -> DataFrame:
    """Cap at the upload's ceiling, round to one decimal, twelve columns (plus country).

    Values are first cut to six decimals, so that the last bit of a division does not
    decide which way a tie is rounded.
    """
    return wide.select(
        "country",
        "store",
        F.col("code").alias("sg_cd"),
        "sku",
        "fiscal_year",
        "fiscal_week",
        *[
            F.round(F.round(F.when(F.col(t) > UPLOAD_CEILING, UPLOAD_CAPPED).otherwise(F.col(t)), 6), 1).alias(t)
            for t in TARGET_COLUMNS
        ],
    )


IN_SCOPE, GENERATED = 1, 2  # bits of a promotion's audit state


def audit_states(promotions: DataFrame, scope: DataFrame, final: DataFrame, stores: DataFrame, cfg: RunConfig) -> DataFrame:
    """(country, sku, promo_start, promo_end, state) of every promotion interval sold in an audited store.

    ``promotions``: one row per promotion, product and country, before stores multiply them. The state is a sum of
    bits: in the event's scope, target generated. Each interval has one state, so the states partition the promotions.
    Stores with an early start, listed by country and number, are left out.
    """
    early = any_of([(F.col("country") == c) & (F.col("store_number") == n) for c, n in cfg.early_start_stores] or [F.lit(False)])
    audited = stores.filter(~early)
    interval = ["country", "sku", "promo_start", "promo_end"]
    inside = (F.col("promo_end") >= F.col("scope_from")) & (F.col("promo_start") <= F.col("scope_to"))
    listed = (
        promotions.join(audited.select("country"), "country", "left_semi")
        .join(scope, ["country", "division"], "left")
        .select(*interval, F.when(inside, IN_SCOPE).otherwise(0).alias("state"))
    )
    generated = final.join(audited.select("country", "store"), ["country", "store"], "left_semi").select(
        *interval, F.lit(GENERATED).alias("state")
    )
    return listed.unionByName(generated).groupBy(*interval).agg(F.expr("bit_or(state)").alias("state"))


def scope_audit(states: DataFrame, cfg: RunConfig) -> DataFrame:
    """Promotion intervals left out of the event's scope and those with targets, with the run's parameters."""
    message = F.when(F.col("state").bitwiseAND(GENERATED) > 0, "promo target generated").when(
        F.col("state") == 0, "excluded - not in event scope"
    )
    parameters = {
        "departments_selected": ",".join(map(str, cfg.departments or ())),
        "excluded_sections_selected": ",".join(map(str, cfg.excluded_sections)),
        "promo_week_selected": cfg.promo_week or "",
        "week_reupload_selected": "YES" if cfg.week_reupload else "NO",
        "added_promotions_selected": "YES" if cfg.added_promotions else "NO",
    }
    shown = states.select("country", "sku", "promo_start", "promo_end", message.alias("message"))
    return shown.filter("message IS NOT NULL").withColumns({k: F.lit(v) for k, v in parameters.items()})
