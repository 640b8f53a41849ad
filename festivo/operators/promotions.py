"""Promotions: hierarchies, zones, plans, leaflets and the promotion x store base."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from festivo.config import (
    EARLY_START_WEEKDAYS,
    IN_OUT_MARK,
    LEAFLET_DATES,
    LEVELS,
    NO_EXPIRY_WEEK,
    PLAN_VALIDITY_DAYS,
    PROMO_STEP_CODES,
    PROMO_WEEKS,
    RunConfig,
)
from festivo.functions.expressions import any_of, node_id, store_in_range, year_week
from festivo.operators.calendar import DAY_COLUMNS, on_calendar, week_lookup
from festivo.operators.intervals import overlap_join

FLAG_COLUMNS = tuple(f"promo_{n}" for n in range(1, 8))
PROMO_KEY = ["country", "promo_code", "sku", "promo_start", "promo_end"]


def promo_day_flags(extracts: Sequence[DataFrame], country: str | None = None, as_of: date | None = None) -> DataFrame:
    """Seven step codes to seven 0/1 promo flags, over all supplier extracts.

    Each extract is made distinct on its own; equal rows of two extracts both stay.
    """
    parts = []
    for extract in extracts:
        rows = extract.filter(store_in_range(F.col("country"), F.col("store_number")))
        if country is not None:
            rows = rows.filter(F.col("country") == country.upper())
        if as_of is not None:
            rows = rows.filter(F.col("snapshot_date") == F.lit(as_of))
        parts.append(rows.dropDuplicates())
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    flags = [
        F.when(F.col(f"step_{n}").isin(*PROMO_STEP_CODES), 1).otherwise(0).alias(f"promo_{n}") for n in range(1, 8)
    ]
    return union.select("*", *flags)


def product_dual_hierarchy(
    reporting: DataFrame,
    second: DataFrame,
    departments: Sequence[int] | None,
    excluded_sections: Sequence[int] = (),
) -> DataFrame:
    """Products of both hierarchies, kept by department list and section exclusions.

    A department code of more than two digits is looked up in the reporting hierarchy,
    a shorter one in the second. The first code's kind decides whose sections are excluded.
    """
    both = reporting.join(second, "sku")
    if departments is None:
        return both
    long_codes = [d for d in departments if len(str(d)) > 2]
    short_codes = [d for d in departments if len(str(d)) <= 2]
    kept = both.filter(
        F.col("department_code").isin(long_codes) | F.col("department_code_2").isin(short_codes)
    )
    if not excluded_sections:
        return kept
    by_reporting = len(str(departments[0])) > 2
    section = F.col("section_code" if by_reporting else "section_code_2")
    return kept.filter(~section.isin(*excluded_sections))


def store_zone_link(stores: DataFrame, zones: DataFrame) -> DataFrame:
    """Retail zone of each store; the zone group depends on the country.

    ``stores``: country, country_number, store_number, reference_site.
    ``zones``: country_number, zone_code, zone_group, zone_name.
    """
    group = F.when(F.col("country_number") == 4, 1).otherwise(2)
    return (
        stores.filter(store_in_range(F.col("country"), F.col("store_number")))
        .withColumn("zone_group", group)
        .withColumn("zone_code", F.col("reference_site"))
        .join(zones, ["country_number", "zone_code", "zone_group"])
        .select("country", "store_number", "zone_code", "zone_name")
    )


def excluded_zone(zone: Column, references: Column) -> Column:
    """1 where the zone is in the third word's comma list."""
    listed = F.split(F.get(F.split(references, " "), F.lit(2)), ",")
    return F.when(F.array_contains(listed, zone), 1).otherwise(0)


def week_filter(promos: DataFrame, cfg: RunConfig) -> DataFrame:
    """Promotions of the chosen week: starting in it, or running in it for a re-upload."""
    if cfg.promo_week is None:
        return promos
    week = F.lit(cfg.promo_week)
    if cfg.week_reupload:
        return promos.filter(week.between(F.col("start_week"), F.col("end_week")))
    return promos.filter(F.col("start_week") == week)


def promo_weeks(promos: DataFrame, calendar: DataFrame, how: str = "left") -> DataFrame:
    """Fiscal week of the first and last day, and the start weekday; a day beyond the calendar is an error."""
    week = year_week(F.col("fiscal_year"), F.col("fiscal_week"))
    days = calendar.select("iso_date", week.alias("year_week"), "weekday")
    start = on_calendar(promos, days, "promo_start", {"start_week": "year_week", "start_weekday": "weekday"}, how)
    return on_calendar(start, days, "promo_end", {"end_week": "year_week"}, how)


def added_promos(
    promos: DataFrame,
    products: DataFrame,
    calendar: DataFrame,
    flags: DataFrame,
    zones: DataFrame,
    cfg: RunConfig,
) -> DataFrame:
    """Promotions also present in the extract on their start weekday and week, per linked store.

    The seven flag columns are turned into one row per flagged weekday first, so the
    weekday-dependent condition becomes part of the equality key.
    """
    flagged = flags.select(
        "country",
        "store_number",
        "sku",
        F.col("year_week").alias("start_week"),
        F.explode(
            F.filter(
                F.array(*[F.when(F.col(f"promo_{n}") == 1, F.lit(n)) for n in range(1, 8)]), lambda d: d.isNotNull()
            )
        ).alias("start_weekday"),
    )
    chosen = week_filter(promo_weeks(promos, calendar, "inner"), cfg).join(products.select("sku"), "sku")
    linked = chosen.join(flagged, ["country", "sku", "start_week", "start_weekday"])
    return linked.join(zones.select("country", "store_number", "zone_code"), ["country", "store_number"], "left").select(
        *PROMO_KEY,
        "start_weekday",
        "start_week",
        "end_week",
        "store_number",
        "zone_code",
        excluded_zone(F.col("zone_code"), F.col("excluded_references")).alias("is_excluded_zone"),
    )


def plan_validity(plan: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monday of the plan's week and of its next calculation, and the days between."""
    weeks = week_lookup(calendar)
    this = weeks.select(F.col("year_week").alias("plan_week"), F.col("monday").alias("week_from"))
    following = weeks.select(F.col("year_week").alias("next_calc_week"), F.col("monday").alias("week_to"))
    return (
        plan.join(this, "plan_week", "left")
        .join(following, "next_calc_week", "left")
        .withColumn("validity_days", F.datediff("week_to", "week_from"))
    )


def latest_snapshot(rows: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """All rows of the greatest version per key; ties stay."""
    newest = rows.groupBy(*keys).agg(F.max(version).alias(version))
    return rows.join(newest, [*keys, version], "left_semi")


def eligible_stores(stores: DataFrame, as_of: date) -> DataFrame:
    """Stores in range, of a real format, open for ten days, not closing within sixty, with an area."""
    return stores.filter(
        store_in_range(F.col("country"), F.col("store_number"))
        & (F.col("format") != "ZBK")
        & (F.col("open_date") <= F.lit(as_of - timedelta(days=10)))
        & ((F.col("close_date") >= F.lit(as_of + timedelta(days=60))) | F.col("close_date").isNull())
        & F.col("net_area").isNotNull()
    )


def leaflet_parse(promos: DataFrame, text: str = "leaflet_dates") -> DataFrame:
    """Comma list of leaflet dates to an array of all of them and ten date columns; bad or missing parts are NULL."""
    dates = F.transform(F.split(F.col(text), ","), lambda part: F.substring(part, 1, 10).try_cast("date"))
    return promos.withColumn("leaflets", dates).select(
        *promos.columns,
        "leaflets",
        *[F.get("leaflets", F.lit(i)).alias(f"leaflet_{i + 1}") for i in range(LEAFLET_DATES)],
    )


def leaflet_week_flags(parsed: DataFrame) -> DataFrame:
    """For promo weeks 1 to 10: 1 when any leaflet date, however many are listed, falls in that week of the promotion."""
    weeks = F.transform("leaflets", lambda d: F.floor(F.datediff(d, F.col("promo_start")) / 7) + 1)
    rows = parsed.withColumn("leaflet_weeks", weeks)
    flags = [
        F.when(F.array_contains("leaflet_weeks", F.lit(n).cast("bigint")), 1).otherwise(0).alias(f"leaflet_w{n}")
        for n in range(1, PROMO_WEEKS + 1)
    ]
    return rows.select(*parsed.columns, *flags)


def prefix_tree(plan: DataFrame, rule: Column, keys: Sequence[str]) -> DataFrame:
    """Plans of a rule by code prefix: (keys, prefix, depth, days), the days as one struct; shorter prefixes are parents."""
    return plan.filter(rule).select(
        *keys, F.trim("plan_code").alias("prefix"), F.length(F.trim("plan_code")).alias("depth"), F.struct(*DAY_COLUMNS).alias("days")
    )


def inherited(codes: DataFrame, tree: DataFrame, keys: Sequence[str], depths: Sequence[int]) -> DataFrame:
    """Each distinct code's days, every day from the longest prefix that has a value for it.

    ``codes``: distinct (keys, code). A code meets its prefixes of the given depths once, however many
    products carry it; its row inherits from the longest prefix down to the shortest.
    """
    paths = F.array(*[F.substring("code", 1, n) for n in depths])
    met = codes.withColumn("prefix", F.explode(F.array_distinct(paths))).join(tree, [*keys, "prefix"])
    met = met.filter(F.col("depth").isin(*depths))

    def longest(day: str) -> Column:
        value = F.col(f"days.{day}")
        return F.max(F.when(value.isNotNull(), F.struct("depth", value.alias("value"))))["value"].alias(day)

    return met.groupBy(*keys, "code").agg(*[longest(d) for d in DAY_COLUMNS])


def prefix_fallback_lookup(base: DataFrame, plan: DataFrame) -> DataFrame:
    """System day plan of a product and store, the most specific code prefix first.

    Product + 6-char code, product + 5-char code valid for 56 days, then the code alone at 5 down to
    1 characters; each day takes the first plan that has a value. ``base``: country, store, sku, code.
    The distinct codes of a store inherit along their prefixes once for all products; the plans filed for a product are looked
    up by product, and one join on the store and code brings both together.
    """
    system = plan.filter((F.col("updated_by") == "SYSTEM") & (F.col("kind") == "PTP"))
    no_expiry = F.col("next_calc_week") == NO_EXPIRY_WEEK
    place = ["country", "store"]
    keys = base.select(*place, "sku", "code").dropDuplicates()
    by_code = inherited(
        keys.select(*place, "code").dropDuplicates(),
        prefix_tree(system, (F.col("plan_sku") == 0) & no_expiry, place),
        place,
        (5, 4, 3, 2, 1),
    ).select(*place, "code", F.struct(*DAY_COLUMNS).alias("of_code"))
    trimmed = F.trim("plan_code")
    rank = F.when(no_expiry & (trimmed == F.substring("code", 1, 6)), 1).when(
        (F.col("validity_days") == PLAN_VALIDITY_DAYS) & (trimmed == F.substring("code", 1, 5)), 2
    )
    filed = system.filter(F.col("plan_sku") != 0).withColumnRenamed("plan_sku", "sku")

    def best(rank_of: int, day: str) -> Column:
        return F.max(F.when(F.col("rank") == rank_of, F.col(day)))

    by_product = (
        keys.join(filed, [*place, "sku"])
        .withColumn("rank", rank)
        .filter("rank IS NOT NULL")
        .groupBy(*place, "sku", "code")
        .agg(*[F.coalesce(best(1, d), best(2, d)).alias(f"own_{d}") for d in DAY_COLUMNS])
    )
    resolved = (
        keys.join(by_code, [*place, "code"], "left")
        .join(by_product, [*place, "sku", "code"], "left")
        .select(
            *place, "sku", "code", *[F.coalesce(f"own_{d}", f"of_code.{d}").alias(f"plan_{d}") for d in DAY_COLUMNS]
        )
    )
    return base.join(resolved, [*place, "sku", "code"], "left")


def plan_lookup_start_end(base: DataFrame, plan: DataFrame, flags: DataFrame | None, cfg: RunConfig) -> DataFrame:
    """User plans for the promotion's start and end week: product level, and code prefix 5 then 4.

    The start-week product plan counts on days whose extract flag is set, or always when
    the run is not restricted to added promotions. A store's distinct codes inherit once per week for
    all products; start and end week then take one join each for product and code plans.
    """
    user = plan.filter((F.col("updated_by") == "USER") & (F.col("kind") == "PTG"))
    place = ["country", "store", "plan_week"]
    weeks = F.explode(F.array_distinct(F.array("start_week", "end_week"))).alias("plan_week")
    codes = base.select("country", "store", "code", weeks).dropDuplicates()
    by_code = inherited(codes, prefix_tree(user, F.col("plan_sku") == 0, place), place, (5, 4))
    by_code = by_code.select(*place, "code", F.struct(*DAY_COLUMNS).alias("days"))
    product = (
        user.filter(F.col("plan_sku") != 0)
        .select("country", "store", F.col("plan_sku").alias("sku"), "plan_week", F.struct(*DAY_COLUMNS).alias("days"))
        .dropDuplicates()
    )

    def at(rows: DataFrame, plans: DataFrame, week: str, name: str, own: str) -> DataFrame:
        named = plans.withColumnsRenamed({"plan_week": week, "days": name})
        return rows.join(named, ["country", "store", own, week], "left")

    rows = at(base, product, "start_week", "start_product", "sku")
    rows = at(rows, product, "end_week", "end_product", "sku")
    rows = at(rows, by_code, "start_week", "start_code", "code")
    rows = at(rows, by_code, "end_week", "end_code", "code")
    if cfg.added_promotions:
        if flags is None:
            raise ValueError("added promotions need the extract flags")
        marked = (
            flags.withColumnRenamed("year_week", "start_week")
            .groupBy("country", "store", "sku", "start_week")
            .agg(*[F.max(f).alias(f) for f in FLAG_COLUMNS])
        )
        rows = rows.join(marked, ["country", "store", "sku", "start_week"], "left")
        counts = [F.col(f"promo_{n}") == 1 for n in range(1, 8)]
    else:
        counts = [F.lit(True)] * 7
    return rows.select(
        *base.columns,
        *[F.when(c, F.col(f"start_product.{d}")).alias(f"start_{d}") for c, d in zip(counts, DAY_COLUMNS, strict=True)],
        *[F.col(f"end_product.{d}").alias(f"end_{d}") for d in DAY_COLUMNS],
        *[F.col(f"start_code.{d}").alias(f"regular_start_{d}") for d in DAY_COLUMNS],
        *[F.col(f"end_code.{d}").alias(f"regular_end_{d}") for d in DAY_COLUMNS],
    )


def reachable_plans(plan: DataFrame, weeks: DataFrame) -> DataFrame:
    """Plans that promotions can meet: user plans of ``weeks(plan_week)`` only, all others as they are.

    Weeks are few, so the plans of other seasons drop out where they are read, ahead of every exchange.
    """
    met = plan.join(weeks.select("plan_week", F.lit(True).alias("_met")).dropDuplicates(), "plan_week", "left")
    return met.filter(F.col("_met") | ~F.col("updated_by").eqNullSafe("USER")).select(*plan.columns)


def added_stores(promos: DataFrame, added: DataFrame) -> DataFrame:
    """Promotions that were added in any store, with the numbers of those stores as ``added_in``."""
    interval = ["country", "sku", "promo_start", "promo_end"]
    return promos.join(added.groupBy(*interval).agg(F.collect_set("store_number").alias("added_in")), interval)


def dated_promotions(
    promos: DataFrame, products: DataFrame, calendar: DataFrame, cfg: RunConfig, distinct: bool = True, carried: Sequence[str] = ()
) -> DataFrame:
    """Promotions of the chosen week with their weeks and product: one row per promotion, product and country.

    ``distinct=False`` leaves equal promotions in, for readers that group them anyway; ``carried`` names further columns of the
    promotions that stay.
    ``in_out_check`` marks products whose description says that they are in and out of the range.
    """
    promotion = promos.select(*PROMO_KEY, "leaflet_dates", *carried)
    if distinct:
        promotion = promotion.dropDuplicates()
    in_out = (F.instr("description", IN_OUT_MARK) > 0).cast("int").alias("in_out_check")
    marked = products.select("sku", *LEVELS, F.coalesce(in_out, F.lit(0)).alias("in_out_check"))
    return week_filter(promo_weeks(promotion, calendar), cfg).join(marked, "sku")


def described_promotions(dated: DataFrame, codes: DataFrame) -> DataFrame:
    """Promotions with duration, code, node ids and leaflet flags: worked out for those that an event reaches.

    ``codes``: country, sku, code; a product without one keeps its row.
    """
    coded = dated.join(codes.select("country", "sku", "code"), ["country", "sku"], "left")
    ids = [
        node_id([F.col(c) for c in LEVELS[:depth]]).alias(f"node_{level}")
        for depth, level in enumerate(LEVELS, start=1)
    ]
    kept = [c for c in dated.columns if c not in (*PROMO_KEY, *LEVELS, "start_week", "end_week", "start_weekday", "leaflet_dates")]
    return leaflet_week_flags(leaflet_parse(coded)).select(
        *PROMO_KEY,
        "start_week",
        "end_week",
        "start_weekday",
        (F.datediff("promo_end", "promo_start") + 1).alias("promo_duration"),
        *LEVELS,
        "code",
        *ids,
        *[f"leaflet_w{n}" for n in range(1, PROMO_WEEKS + 1)],
        *kept,
    )


def promo_store_base(promotions: DataFrame, stores: DataFrame, clusters: DataFrame) -> DataFrame:
    """Promotion x eligible store with the store's cluster.

    The stores of a country travel as one array, so promotions meet a table of one row per country and are
    multiplied in place, without an exchange on the country. A store without a cluster gets the default of its format.
    """
    by_country = stores.groupBy("country").agg(F.collect_list(F.struct("store", "store_number", "format")).alias("sold_in"))
    with_store = promotions.join(by_country, "country").withColumn("at", F.explode("sold_in"))
    default = F.when(F.col("format") == "HM", "Large-Moderate").otherwise("Small-Moderate")
    return (
        with_store.select(*promotions.columns, "at.*")
        .join(
            clusters.select("country", "division", "store", "store_cluster"), ["country", "division", "store"], "left"
        )
        .withColumn("store_cluster", F.coalesce("store_cluster", default))
        .drop("format")
    )


def early_start_shift(base: DataFrame, stores: Sequence[tuple[str, int]]) -> DataFrame:
    """Listed stores start promotions of weekdays 2 to 4 one day earlier."""
    if not stores:
        return base
    listed = any_of([(F.col("country") == c) & (F.col("store_number") == s) for c, s in stores])
    early = listed & F.col("start_weekday").isin(*EARLY_START_WEEKDAYS)
    return base.withColumns(
        {
            "promo_start": F.when(early, F.date_sub("promo_start", 1)).otherwise(F.col("promo_start")),
            "start_weekday": F.when(early, F.col("start_weekday") - 1).otherwise(F.col("start_weekday")),
            "promo_duration": F.when(early, F.col("promo_duration") + 1).otherwise(F.col("promo_duration")),
        }
    )


def event_scope(targets: DataFrame) -> DataFrame:
    """First and last modelled day of every country's divisions."""
    return targets.groupBy("country", F.substring_index("node_id", "-", 1).alias("division")).agg(
        F.min("iso_date").alias("scope_from"), F.max("iso_date").alias("scope_to")
    )


def scope_min_max(base: DataFrame, targets: DataFrame) -> DataFrame:
    """First and last modelled day of each promotion's country and division."""
    return base.join(event_scope(targets), ["country", "division"], "left")


def near_event(promos: DataFrame, scope: DataFrame, early_days: int = 1) -> DataFrame:
    """Promotions that could be ``within_reach`` of any division of their country, decided before their product is looked up.

    ``scope`` has one row per country and division, so its countries are a table of a few rows, and promotions of other
    seasons are never exchanged.
    """
    season = scope.groupBy("country").agg(F.min("scope_from").alias("_season_from"), F.max("scope_to").alias("_season_to"))
    open_ = (F.date_sub("promo_start", early_days) <= F.col("_season_to")) & (F.col("promo_end") >= F.col("_season_from"))
    return promos.join(season, "country").filter(open_).select(*promos.columns)


def within_reach(promotions: DataFrame, scope: DataFrame, early_days: int = 1) -> DataFrame:
    """Promotions that overlap their division's modelled days, or would if they began up to ``early_days`` earlier.

    Decided before the stores multiply the promotions; some stores start a day early, so their exact test follows.
    """
    open_ = promotions.withColumn("_earliest", F.date_sub("promo_start", early_days))
    met = overlap_join(open_, scope, ["country", "division"], ("_earliest", "promo_end"), ("scope_from", "scope_to"))
    return met.drop("_earliest")


def added_filter(base: DataFrame, added: DataFrame | None, cfg: RunConfig) -> DataFrame:
    """Only promotions that were added, when the run asks for it."""
    if not cfg.added_promotions:
        return base
    if added is None:
        raise ValueError("the run is restricted to added promotions")
    keys = ["country", "sku", "promo_start", "promo_end", "store_number"]
    return base.join(added.select(*keys), keys, "left_semi")


def event_scope_filter(base: DataFrame) -> DataFrame:
    """Promotions whose interval overlaps their division's modelled days."""
    return base.filter(
        (F.col("promo_end") >= F.col("scope_from")) & (F.col("promo_start") <= F.col("scope_to"))
    )


