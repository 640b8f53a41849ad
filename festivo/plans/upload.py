"""The upload run: promotions to a per-store, per-product, per-week target file, and its audit."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from festivo.config import PROMO_WEEKS, RunConfig
from festivo.functions.expressions import year_week
from festivo.operators.allocation import (
    PROMO_STORE,
    audit_states,
    base_promo_target,
    closed_day_redistribution,
    holiday_override_wide,
    latest_promo_per_week,
    promo_day_explode,
    promo_day_rank,
    reachable_days,
    scope_audit,
    target_fallback_lookup,
    upload_extract,
    week_edge_backfill,
    weekday_column_select,
    weekday_pivot,
)
from festivo.operators.calendar import holiday_week_pivot, open_day_grid
from festivo.operators.promotions import (
    added_filter,
    added_promos,
    added_stores,
    dated_promotions,
    described_promotions,
    early_start_shift,
    eligible_stores,
    event_scope,
    event_scope_filter,
    latest_snapshot,
    near_event,
    plan_lookup_start_end,
    plan_validity,
    prefix_fallback_lookup,
    product_dual_hierarchy,
    promo_day_flags,
    promo_store_base,
    reachable_plans,
    store_zone_link,
    within_reach,
)
from festivo.sources.retail import Retail
from festivo.sources.snapshots import SNAPSHOT, SnapshotTable
from festivo.sources.tables import stage, write_partitions

DAY_ROW_COLUMNS = (
    *PROMO_STORE,
    "store_number",
    "store_cluster",
    "division",
    "department",
    "section",
    "code",
    "node_subgroup",
    "start_week",
    "end_week",
    *[f"leaflet_w{n}" for n in range(1, PROMO_WEEKS + 1)],
)


class UploadRun:
    """One upload run over given targets and store clusters.

    Deliveries are read by snapshot: extracts and day plans of the run's day, trading hours of the last days, stock-group
    codes of each product's last delivery.
    """

    def __init__(
        self,
        retail: Retail,
        targets: DataFrame | Callable[[], DataFrame],
        clusters: DataFrame | Callable[[], DataFrame],
        hours: DataFrame | None = None,
    ):
        """``targets`` and ``clusters``: tables, or functions that make them when a step first reads them."""
        self.retail, self.given_hours = retail, hours
        self.given_targets, self.given_clusters = targets, clusters

    @cached_property
    def targets(self) -> DataFrame:
        return self.given_targets() if callable(self.given_targets) else self.given_targets

    @cached_property
    def clusters(self) -> DataFrame:
        return self.given_clusters() if callable(self.given_clusters) else self.given_clusters

    @cached_property
    def hours(self) -> SnapshotTable:
        given = self.given_hours
        return self.retail.hours_deliveries(given if given is not None else self.retail.trading_hours)

    @property
    def cfg(self) -> RunConfig:
        return self.retail.cfg

    # --- deliveries and selection ------------------------------------------------
    @cached_property
    def flags(self) -> DataFrame:
        return promo_day_flags(self.retail.extracts(self.cfg.as_of), self.cfg.country, self.cfg.as_of)

    @cached_property
    def plan(self) -> DataFrame:
        today = self.retail.plan_deliveries.on(self.cfg.as_of).drop(SNAPSHOT)
        return plan_validity(today, self.retail.folded_calendar)

    @cached_property
    def recent_hours(self) -> DataFrame:
        days = self.cfg.hours_snapshot_days
        return self.hours.since(self.cfg.as_of - timedelta(days=days), self.cfg.as_of)

    @cached_property
    def codes(self) -> DataFrame:
        """Stock-group code of each country's products, from the product's last delivery."""
        return latest_snapshot(self.retail.code_deliveries.read(), ["country", "sku"], SNAPSHOT)

    @cached_property
    def products(self) -> DataFrame:
        """Products of the chosen departments without the excluded sections."""
        r, cfg = self.retail, self.cfg
        if cfg.departments is None:
            return r.products
        chosen = product_dual_hierarchy(r.reporting_hierarchy, r.second_hierarchy, cfg.departments, cfg.excluded_sections)
        return r.products.join(chosen.select("sku"), "sku", "left_semi")

    @cached_property
    def stores(self) -> DataFrame:
        """Stores that sell, written once: a table of true size."""
        return stage(eligible_stores(self.retail.stores, self.cfg.as_of), "stores")

    # --- promotions -----------------------------------------------------------------
    @cached_property
    def promotions(self) -> DataFrame:
        """Promotions of the chosen products and week, before stores multiply them."""
        r = self.retail
        return dated_promotions(r.promo_intervals, self.products, r.folded_calendar, self.cfg)

    @cached_property
    def listed(self) -> DataFrame:
        """The same promotions for the audit, which groups them by interval: equal ones may stay."""
        r = self.retail
        return dated_promotions(r.promo_intervals, self.products, r.folded_calendar, self.cfg, distinct=False)

    @cached_property
    def all_base(self) -> DataFrame:
        """Every promotion in every store that sells, whatever the event.

        A run of added promotions leaves out the stores that ``added_filter`` would, before promotions are exchanged with them.
        """
        if self.added is None:
            return promo_store_base(described_promotions(self.promotions, self.codes), self.stores, self.clusters)
        r = self.retail
        listed = added_stores(r.promo_intervals, self.added)
        dated = dated_promotions(listed, self.products, r.folded_calendar, self.cfg, carried=["added_in"])
        base = promo_store_base(described_promotions(dated, self.codes), self.stores, self.clusters)
        return base.filter(F.array_contains("added_in", F.col("store_number"))).drop("added_in")

    @cached_property
    def zones(self) -> DataFrame:
        return store_zone_link(self.retail.store_sites, self.retail.zones)

    @cached_property
    def added(self) -> DataFrame | None:
        """The added promotions with their stores, written once for the filter, the promotions it leaves, and the audit."""
        if not self.cfg.added_promotions:
            return None
        r = self.retail
        return stage(added_promos(r.zoned_promos, self.products, r.folded_calendar, self.flags, self.zones, self.cfg), "added")

    @cached_property
    def scope(self) -> DataFrame:
        """The divisions' modelled days, written once: a small table of true size."""
        return stage(event_scope(self.targets), "scope")

    @cached_property
    def near(self) -> DataFrame:
        """Promotions of the chosen products and week that the event can reach."""
        r = self.retail
        dated = dated_promotions(near_event(r.promo_intervals, self.scope), self.products, r.folded_calendar, self.cfg)
        return within_reach(dated, self.scope)

    @cached_property
    def added_near(self) -> DataFrame | None:
        """Of the added promotions those that the event can reach, from the extracts of the weeks they start in."""
        if not self.cfg.added_promotions:
            return None
        r = self.retail
        promos = near_event(r.zoned_promos, self.scope)
        starts = promos.select(F.col("promo_start").alias("iso_date")).dropDuplicates()
        week = year_week(F.col("fiscal_year"), F.col("fiscal_week")).alias("year_week")
        weeks = stage(r.folded_calendar.join(starts, "iso_date", "left_semi").select(week).dropDuplicates(), "near_weeks")
        flags = self.flags.join(weeks, "year_week", "left_semi")
        return added_promos(promos, self.products, r.folded_calendar, flags, self.zones, self.cfg)

    @cached_property
    def base(self) -> DataFrame:
        """Promotions that the event can reach, with their stores: the scope comes first, then the stores."""
        near = promo_store_base(described_promotions(self.near, self.codes), self.stores, self.clusters)
        return early_start_shift(added_filter(near, self.added_near, self.cfg), self.cfg.early_start_stores)

    @cached_property
    def in_scope(self) -> DataFrame:
        return stage(event_scope_filter(self.base), "promo_base")

    @cached_property
    def holiday_weeks(self) -> DataFrame:
        return holiday_week_pivot(self.retail.folded_calendar, self.retail.holidays, ("country",))

    @cached_property
    def open_days(self) -> DataFrame:
        return open_day_grid(self.recent_hours, self.retail.folded_calendar, self.holiday_weeks, ("country",))

    @cached_property
    def days(self) -> DataFrame:
        """Promotion days, carrying only what the steps behind still read."""
        narrow = self.in_scope.select(*DAY_ROW_COLUMNS)
        ranked = promo_day_rank(promo_day_explode(narrow, self.retail.folded_calendar, self.cfg))
        return weekday_column_select(ranked.drop("weekday_name"), stage(self.open_days, "open_days"))

    @cached_property
    def targeted(self) -> DataFrame:
        r = self.retail
        days = reachable_days(self.days, self.targets, self.cfg)
        with_target = target_fallback_lookup(days, self.in_scope, self.targets)
        values = stage(r.weekday_values, "weekday_values")
        return base_promo_target(with_target, values, r.week_coefficients, self.cfg)

    @cached_property
    def redistributed(self) -> DataFrame:
        return closed_day_redistribution(self.targeted)

    @cached_property
    def wide(self) -> DataFrame:
        return weekday_pivot(self.redistributed)

    @cached_property
    def plans(self) -> DataFrame:
        """System and user plans of every promotion and store in scope."""
        keys = ["country", "store", "sku", "code", "promo_start", "promo_end", "start_week", "end_week"]
        edges = self.in_scope.select(F.explode(F.array("start_week", "end_week")).alias("plan_week"))
        plan = reachable_plans(self.plan, stage(edges.dropDuplicates(), "plan_weeks"))
        with_plan = prefix_fallback_lookup(self.in_scope.select(*keys).dropDuplicates(), plan)
        flags = self.flags if self.cfg.added_promotions else None
        return plan_lookup_start_end(with_plan, plan, flags, self.cfg)

    @cached_property
    def final(self) -> DataFrame:
        """Week rows behind both the upload and its audit, written once."""
        filled = week_edge_backfill(self.wide, self.plans)
        overridden = holiday_override_wide(filled, self.holiday_weeks, ("country",))
        return stage(latest_promo_per_week(overridden, self.cfg), "final")

    @cached_property
    def upload(self) -> DataFrame:
        return upload_extract(self.final)

    @cached_property
    def audit_states(self) -> DataFrame:
        listed = self.listed
        if self.added is not None:
            interval = ["country", "sku", "promo_start", "promo_end"]
            listed = listed.join(self.added.select(*interval), interval, "left_semi")
        return audit_states(listed, self.scope, self.final, self.stores, self.cfg)

    @cached_property
    def audit(self) -> DataFrame:
        return scope_audit(self.audit_states, self.cfg)

    def write(self, root: str, fmt: str = "csv") -> None:
        """Write the upload and its audit; another event's or country's files under the root stay."""
        event = F.lit(self.cfg.event_id_key).alias("event_id")
        for name, rows in (("upload", self.upload), ("audit", self.audit)):
            write_partitions(rows.select(event, "*"), f"{root}/{name}", ("event_id", "country"), fmt)
