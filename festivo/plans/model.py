"""The model run: from sales to daily targets per node, cluster and day."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from festivo.config import RunConfig
from festivo.functions.expressions import any_of
from festivo.operators.blending import (
    blend_uplift,
    coefficient_select,
    final_targets,
    hierarchy_code_map,
    user_override_schema,
)
from festivo.operators.calendar import fy_calendar_grid, fy_event_days, shift_calendar, year_offset
from festivo.operators.clustering import (
    store_day_uplift,
    store_range_size,
    store_shape_cluster,
    uplift_percentiles,
)
from festivo.operators.events import event_spans, event_timeline
from festivo.operators.matching import NODE, gap_fill_last_week, ly_feature_join, ly_fy_match, offset_companion
from festivo.operators.rollup import (
    LEVELS,
    NODE_KEY,
    all_levels_uplift,
    hierarchy_rollup,
    node_quality_gate,
    node_window_stats,
    week_stats,
)
from festivo.operators.sales import (
    base_day_spans,
    base_week_sales,
    baseline_union,
    clustering_sales,
    event_period_sales,
    node_store_day,
    promo_adjusted_sales,
    promo_discount_depth,
)
from festivo.operators.series import (
    aligned_multi_year_sales,
    centered_moving_average,
    minmax_normalise,
    norm_union_cap,
)
from festivo.sources.retail import Retail
from festivo.sources.tables import stage, write_partitions


class ModelRun:
    """One model run; every step is a lazy property, shared steps are staged once."""

    def __init__(self, retail: Retail):
        self.retail = retail

    @property
    def cfg(self) -> RunConfig:
        return self.retail.cfg

    @cached_property
    def sales(self) -> DataFrame:
        """Daily sales of all windows the run looks at: the only scan of the fact table.

        One staged set of day spans serves clustering, base weeks, event weeks and the
        normalisation years; the spans come from the dated controls and reach the scan as filters.
        """
        return stage(self.retail.daily_sales(self.spans), "daily_sales")

    @cached_property
    def spans(self) -> list[tuple[date, date]]:
        """First and last day of every stretch of sales that the run looks at."""
        cfg = self.cfg
        spans = event_spans(self.retail.controls, cfg.ly_year, (*cfg.norm_years, cfg.ly_year))
        last_year = (cfg.base_monday, spans[cfg.ly_year][1])
        return [*base_day_spans(cfg), *spans.values(), last_year]

    @cached_property
    def depth(self) -> DataFrame:
        """Promotions that run on any of those days, with their savings."""
        promos = self.retail.promos
        runs = [(promos.promo_start <= F.lit(high)) & (promos.promo_end >= F.lit(low)) for low, high in self.spans]
        return promo_discount_depth(promos.filter(any_of(runs)))

    @cached_property
    def timeline(self) -> DataFrame:
        """Last year's event days by country and division, from the latest base week on."""
        return stage(event_timeline(self.retail.controls, self.cfg.ly_year, self.cfg.base_monday), "timeline")

    # --- clustering ---------------------------------------------------------
    @cached_property
    def range_size(self) -> DataFrame:
        return store_range_size(
            self.retail.product_range, self.retail.stores, self.cfg.as_of, self.cfg.min_products_per_store
        )

    @cached_property
    def store_uplift(self) -> DataFrame:
        r = self.retail
        sales = clustering_sales(self.sales, r.products, r.coef_section, r.coef_department)
        return store_day_uplift(sales, self.range_size, self.timeline, self.cfg)

    @cached_property
    def percentiles(self) -> DataFrame:
        return uplift_percentiles(stage(self.store_uplift, "store_uplift"))

    @cached_property
    def clusters(self) -> DataFrame:
        return stage(store_shape_cluster(self.percentiles, self.cfg.small_cluster), "clusters")

    # --- sales per node -------------------------------------------------------
    @cached_property
    def adjusted(self) -> DataFrame:
        r = self.retail
        return promo_adjusted_sales(
            self.sales, r.products, r.coef_section, r.coef_department, r.coef_division, self.depth
        )

    @cached_property
    def node_days(self) -> DataFrame:
        return stage(node_store_day(self.adjusted, self.clusters), "node_days")

    @cached_property
    def base_sales(self) -> DataFrame:
        return base_week_sales(self.node_days, self.timeline, self.retail.holidays, self.cfg)

    @cached_property
    def event_sales(self) -> DataFrame:
        return event_period_sales(self.node_days, self.timeline, self.retail.holidays)

    @cached_property
    def baseline(self) -> DataFrame:
        return baseline_union(self.base_sales, self.event_sales)

    # --- hierarchy levels -----------------------------------------------------
    @cached_property
    def levels(self) -> DataFrame:
        return hierarchy_rollup(self.baseline, self.retail.enforced, self.cfg.event_id)

    @cached_property
    def node_stats(self) -> DataFrame:
        return node_window_stats(self.levels)

    @cached_property
    def gated(self) -> DataFrame:
        return week_stats(node_quality_gate(self.node_stats, self.cfg.gates))

    @cached_property
    def shift(self) -> DataFrame:
        c = self.retail.controls
        pair = c.filter(c.year.isin(self.cfg.ly_year, self.cfg.fy_year))
        return shift_calendar(self.retail.calendar, pair, self.cfg.base_monday)

    @cached_property
    def uplift(self) -> DataFrame:
        return stage(all_levels_uplift(self.gated, self.shift), "uplift")

    @cached_property
    def series(self) -> DataFrame:
        return centered_moving_average(self.uplift, ["level", *NODE_KEY], ["event_offset", "is_base"])

    @cached_property
    def aligned(self) -> DataFrame:
        return aligned_multi_year_sales(self.node_days, self.retail.controls, self.retail.holidays, self.cfg)

    @cached_property
    def norm(self) -> DataFrame:
        return norm_union_cap(minmax_normalise(self.aligned))

    # --- last year to this year -------------------------------------------------
    @cached_property
    def features(self) -> DataFrame:
        return stage(
            ly_feature_join(self.uplift, self.series, self.norm, self.retail.controls, self.cfg), "features"
        )

    @cached_property
    def shifts(self) -> DataFrame:
        c = self.retail.controls
        years = [self.cfg.ly_year, self.cfg.fy_year]
        return stage(year_offset(c.filter(c.year.isin(years)), self.cfg.event_id), "shifts")

    @cached_property
    def nodes(self) -> DataFrame:
        return self.features.select("param", *NODE, *LEVELS).dropDuplicates()

    @cached_property
    def this_year(self) -> DataFrame:
        """This year's event days by country and parameter group."""
        c = self.retail.controls
        return stage(fy_event_days(c.filter(c.year == self.cfg.fy_year)), "event_days")

    @cached_property
    def grid(self) -> DataFrame:
        nodes = self.nodes.select("param", *NODE)
        return fy_calendar_grid(self.retail.calendar, self.retail.holidays, nodes, self.this_year)

    @cached_property
    def matched(self) -> DataFrame:
        return ly_fy_match(self.grid, self.features, self.shifts, self.this_year)

    @cached_property
    def filled(self) -> DataFrame:
        return gap_fill_last_week(stage(self.matched, "matched"), self.features, self.shifts)

    @cached_property
    def connected(self) -> DataFrame:
        return offset_companion(self.filled, self.nodes)

    # --- targets ------------------------------------------------------------------
    @cached_property
    def weighted(self) -> DataFrame:
        return coefficient_select(self.connected, self.retail.controls, self.cfg)

    @cached_property
    def model(self) -> DataFrame:
        return stage(blend_uplift(hierarchy_code_map(self.weighted, self.retail.code_mapping), self.cfg), "model")

    def targets(self, user: DataFrame | None = None) -> DataFrame:
        user = user if user is not None else user_override_schema(self.retail.spark, self.cfg)
        return final_targets(self.model, user)

    def write(self, root: str, user: DataFrame | None = None, fmt: str = "orc") -> None:
        """Write the hand-off tables of the run; another event's or country's partitions under the root stay."""
        event = F.lit(self.cfg.event_id_key)
        for name, rows in (("clusters", self.clusters), ("model", self.model), ("targets", self.targets(user))):
            write_partitions(rows.withColumn("event_id", event), f"{root}/{name}", ("event_id", "country"), fmt)
