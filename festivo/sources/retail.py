"""Retail input tables derived from an order / line item / part / supplier warehouse.

The operators take plain DataFrames; this module supplies them from the star schema:
a nation is a store, a region a country, a part a product, an order line a sale and,
together with its order's date, a promotion. Product numbers start at 1, as 0 stands
for "any product of the code" in day plans.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from festivo.config import MOVABLE_EVENT, NO_EXPIRY_WEEK, RunConfig
from festivo.functions.expressions import any_of, month_day, ratio, total_of, week_monday, year_week
from festivo.operators.calendar import event_controls, fiscal_calendar, fiscal_day, fy_event_days
from festivo.operators.events import control_rows, easter_sunday
from festivo.operators.rollup import explode_levels
from festivo.sources.snapshots import SNAPSHOT, SnapshotTable
from festivo.sources.tables import new_staging_path, read_table, stage

PROMO_DISCOUNT = 0.05
HOLIDAY_MONTH_DAYS = ("12-25", "12-26", "01-01")
COUNTRY_HOLIDAYS = {"AFRICA": ("12-16",), "AMERICA": ("11-25", "04-02"), "ASIA": ("04-05",), "EUROPE": ("12-08", "04-24")}
# Where an event has another day: days after the common one, by country, and for one division in all countries.
COUNTRY_EVENT_SHIFT = {"AMERICA": 1, "ASIA": -1}
DIVISION_EVENT_SHIFT = {"PROMO": -1}
CHRISTMAS = (12, 24)
SUPPLIERS = ("A", "N", "R")
PROMO_ORDER = ("promo_code", "sku", "country", "promo_start")
STALE_DAYS = 8  # age of the outdated deliveries next to the current ones
CONTROL_VALUES = {
    "offset_from": -6,
    "offset_to": 0,
    "offset2_from": 1,
    "offset2_to": 4,
    "c_off_bh_uplift": 0.5,
    "c_off_bh_seasonal": 0.25,
    "c_off_bh_norm": 0.25,
    "c_off_uplift": 0.5,
    "c_off_offset_uplift": 0.25,
    "c_off_seasonal": 0.125,
    "c_off_norm": 0.125,
    "c_uplift": 0.625,
    "c_seasonal": 0.25,
    "c_norm": 0.125,
    "c_off_share_base": 0.5,
    "c_off_share_offset": 0.5,
    "c_share_base": 1.0,
}


class Retail:
    """Input tables of one warehouse folder."""

    def __init__(self, spark: SparkSession, root: str, cfg: RunConfig | None = None):
        self.spark, self.root, self.cfg = spark, root, cfg or RunConfig()

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    # --- dimensions ---------------------------------------------------------
    @cached_property
    def products(self) -> DataFrame:
        brand = F.substring("p_brand", 7, 10)
        words = F.split("p_name", " ")
        return self.table("part").select(
            (F.col("p_partkey") + 1).alias("sku"),
            F.col("p_type").alias("division"),
            F.col("p_brand").alias("department"),
            F.get(words, F.lit(0)).alias("section"),
            F.get(words, F.lit(1)).alias("grp"),
            F.col("p_size").cast("string").alias("subgroup"),
            F.concat("p_name", F.when(F.col("p_size") % 10 == 0, " I/O").otherwise("")).alias("description"),
            F.concat(
                F.substring("p_type", 1, 2),
                F.lpad(brand, 2, "0"),
                F.lpad(F.col("p_size").cast("string"), 2, "0"),
            ).alias("code"),
        )

    @cached_property
    def reporting_hierarchy(self) -> DataFrame:
        """First hierarchy: three-digit department codes."""
        return self.table("part").select(
            (F.col("p_partkey") + 1).alias("sku"),
            F.col("p_type").alias("division"),
            (F.substring("p_brand", 7, 10).cast("int") + 100).alias("department_code"),
            F.col("p_size").alias("section_code"),
        )

    @cached_property
    def second_hierarchy(self) -> DataFrame:
        """Second hierarchy: one- or two-digit department codes."""
        return self.table("part").select(
            (F.col("p_partkey") + 1).alias("sku"),
            F.col("p_name").alias("long_description"),
            F.col("p_size").alias("department_code_2"),
            F.substring("p_brand", 7, 10).cast("int").alias("section_code_2"),
        )

    @cached_property
    def supplier_stores(self) -> DataFrame:
        """Store and country a supplier sells through, written once: of true size, so that order lines meet it where they are."""
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        sold = self.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("l_suppkey"),
            F.col("n_nationkey").alias("store"),
            F.col("r_name").alias("country"),
            "s_acctbal",
        )
        return stage(sold, "supplier_stores")

    @cached_property
    def stores(self) -> DataFrame:
        """Store attributes: number, country, format, selling area, first and last day."""
        key = F.sum("l_suppkey")
        return (
            self.supplier_stores.groupBy("country", "store")
            .agg(F.sum("s_acctbal").alias("area"), F.count("*").alias("n_suppliers"), key.alias("key"))
            .withColumn("store_number", F.col("store") + 1001)
            .withColumn(
                "format",
                F.when(F.col("key") % 17 == 0, "ZBK").when(F.col("n_suppliers") >= 4, "HM").otherwise("SM"),
            )
            .withColumn("open_date", F.date_sub(F.lit(self.cfg.as_of), (F.col("key") * 37 % 400).cast("int")))
            .withColumn(
                "close_date",
                F.when(F.col("key") % 9 == 0, F.date_add(F.lit(self.cfg.as_of), (F.col("key") % 120).cast("int"))),
            )
            .withColumn("net_area", F.when(F.col("key") % 23 != 0, F.col("area")))
            .select("country", "store", "store_number", "format", "net_area", "open_date", "close_date")
        )

    @cached_property
    def countries(self) -> list[str]:
        return sorted(r.r_name for r in self.table("region").select("r_name").collect())

    def per_country(self, rows: DataFrame) -> DataFrame:
        """One copy of a dimension's rows for every country."""
        return rows.withColumn("country", F.explode(F.array(*map(F.lit, self.countries))))

    @cached_property
    def calendar(self) -> DataFrame:
        """Whole years around all dates of the facts and of the run, written once; one aggregate finds the range."""
        days = self.table("lineitem").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
        orders = self.table("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
        low, high = F.year(F.min("a")), F.year(F.max("b"))
        years = self.cfg.event_years
        span = days.unionAll(orders).agg(
            F.make_date(F.least(low, F.lit(years[0])) - 1, F.lit(1), F.lit(1)).alias("a"),
            F.make_date(F.greatest(high, F.lit(years[-1])) + 2, F.lit(12), F.lit(31)).alias("b"),
        )
        all_days = span.select(F.explode(F.sequence("a", "b")).alias("iso_date"))
        return stage(fiscal_calendar(all_days, fold_week_53=False), "calendar")

    @cached_property
    def holidays(self) -> DataFrame:
        """Bank holidays by country."""
        own = F.create_map(
            *[x for c in self.countries for x in (F.lit(c), F.array(*map(F.lit, (*HOLIDAY_MONTH_DAYS, *COUNTRY_HOLIDAYS.get(c, ())))))]
        )
        days = self.per_country(self.calendar.select(F.col("iso_date").alias("holiday_date")))
        return days.filter(F.array_contains(own[F.col("country")], month_day(F.col("holiday_date")))).select(
            "country", "holiday_date"
        )

    def event_date(self, country: Column, param: Column, year: Column, years: Sequence[int]) -> Column:
        """The stand-in event's day: Christmas Eve or Easter Sunday, shifted in some countries and one division."""
        if self.cfg.event_id_key == MOVABLE_EVENT:
            dates = F.create_map(*[x for y in years for x in (F.lit(y), F.lit(easter_sunday(y)))])
            day = F.try_element_at(dates, year)
        else:
            day = F.make_date(year, F.lit(CHRISTMAS[0]), F.lit(CHRISTMAS[1]))
        shift = F.lit(0)
        for names, column in ((COUNTRY_EVENT_SHIFT, country), (DIVISION_EVENT_SHIFT, param)):
            for name, days in names.items():
                shift = shift + F.when(column == name, days).otherwise(0)
        return F.date_add(day, shift)

    @cached_property
    def event_dates(self) -> DataFrame:
        """The event's day by country, division and year."""
        years = self.cfg.event_years
        groups = self.per_country(self.products.select(F.col("division").alias("param")).dropDuplicates())
        dated = groups.withColumn("year", F.explode(F.array(*map(F.lit, years))))
        return dated.withColumn("event_date", self.event_date(F.col("country"), F.col("param"), F.col("year"), years))

    @cached_property
    def controls(self) -> DataFrame:
        """Event controls, written once: nearly every step of the model reads them."""
        weeks = (self.cfg.weeks_before, self.cfg.weeks_after)
        raw = control_rows(self.cfg.event_id_key, self.event_dates, CONTROL_VALUES, weeks)
        return stage(event_controls(raw, self.calendar), "controls")

    # --- facts --------------------------------------------------------------
    def lines(self, spans: Sequence[tuple[date, date]] = ()) -> DataFrame:
        """Order lines with store and country; day spans are pushed to the scan."""
        rows = self.table("lineitem")
        if spans:
            ship = F.col("l_shipdate")
            rows = rows.filter(
                any_of(
                    [
                        (ship >= F.lit(low.isoformat()).cast("timestamp_ntz"))
                        & (ship < F.lit((high + timedelta(days=1)).isoformat()).cast("timestamp_ntz"))
                        for low, high in spans
                    ]
                )
            )
        return rows.join(self.supplier_stores.drop("s_acctbal"), "l_suppkey").withColumn(
            "sale_date", F.to_date("l_shipdate")
        )

    def daily_sales(self, spans: Sequence[tuple[date, date]] = ()) -> DataFrame:
        """Sales fact: one row per country, store, product and day.

        Aggregated before any product join, so counting products later is counting rows. Without day spans it is the whole
        history, written once for all inputs derived from it.
        """
        if not spans:
            return self.sold_days.select("country", "store", "sku", F.explode("days").alias("of_day")).select("country", "store", "sku", "of_day.*")
        return summed_by_day(self.sold(spans))

    @cached_property
    def sold_days(self) -> DataFrame:
        """The whole history, one row per country, store and product with its days as an array, written once.

        A product's days at a store lie together, so that sums by product, and by product and week, need no exchange.
        """
        key = ["country", "store", "sku"]
        sales = summed_by_day(self.sold(()).repartition(*key))
        return stage(sales.groupBy(*key).agg(F.collect_list(F.struct("sale_date", "qty_promo", "qty_regular")).alias("days")), "sold_days")

    def sold(self, spans: Sequence[tuple[date, date]]) -> DataFrame:
        """Country, store, product, day and quantity of every order line, with and without promotion."""
        promo = F.col("l_discount") >= PROMO_DISCOUNT
        return self.lines(spans).select(
            "country",
            "store",
            (F.col("l_partkey") + 1).alias("sku"),
            "sale_date",
            F.when(promo, F.col("l_quantity")).otherwise(0.0).alias("qty_promo"),
            F.when(promo, 0.0).otherwise(F.col("l_quantity")).alias("qty_regular"),
        )

    @cached_property
    def promos(self) -> DataFrame:
        """Promotions: one row per order, product and country, with interval and prices.

        What an order says of a product is written once for all readers; the last day, the prices and the leaflets follow from
        it and are worked out by those who read them.
        """
        return stage(self.priced_orders, "promos").select(
            *PROMO_ORDER,
            promo_end(),
            "price_normal",
            (F.col("price_normal") * (1 - F.col("discount"))).alias("price_promo"),
            (F.col("price_normal") * (1 - F.col("club_discount"))).alias("price_club"),
            leaflet_text(F.col("promo_start"), F.col("sku"), F.col("promo_code")).alias("leaflet_dates"),
        )

    @cached_property
    def promo_intervals(self) -> DataFrame:
        """The rows of ``promos`` without prices, for the upload, which reads none; what an order says is written once."""
        ordered = self.ordered_lines.select(*PROMO_ORDER).dropDuplicates()
        return stage(ordered, "promo_intervals").select(
            *PROMO_ORDER, promo_end(), leaflet_text(F.col("promo_start"), F.col("sku"), F.col("promo_code")).alias("leaflet_dates")
        )

    @property
    def ordered_lines(self) -> DataFrame:
        """Order lines with their order's day, product and order number named as a promotion's."""
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("promo_start")
        )
        named = {"promo_code": F.col("l_orderkey"), "sku": F.col("l_partkey") + 1}
        return self.lines().join(orders, "l_orderkey").withColumns(named)

    @property
    def priced_orders(self) -> DataFrame:
        """Highest price and lowest discounts of every order, product and country."""
        return self.ordered_lines.groupBy(*PROMO_ORDER).agg(
            F.max("l_extendedprice").alias("price_normal"),
            F.min("l_discount").alias("discount"),
            F.min("l_tax").alias("club_discount"),
        )

    @cached_property
    def zoned_promos(self) -> DataFrame:
        """Promotions with their free text of excluded zones."""
        zones = F.concat(F.lit("Z"), F.col("promo_code") % 4, F.lit(",Z"), F.col("sku") % 4)
        return self.promo_intervals.withColumn("excluded_references", F.concat(F.lit("EXCL REFS "), zones))

    @cached_property
    def store_sites(self) -> DataFrame:
        """Country number and reference site of every store."""
        per_store = self.supplier_stores.groupBy("country", "store").agg(F.count("*").alias("n"))
        regions = self.table("region").select(
            F.col("r_name").alias("country"), F.col("r_regionkey").alias("country_number")
        )
        return per_store.join(regions, "country").select(
            "country",
            "country_number",
            (F.col("store") + 1001).alias("store_number"),
            F.concat(F.lit("Z"), F.col("n") % 4).alias("reference_site"),
        )

    @cached_property
    def zones(self) -> DataFrame:
        """Zones of both groups per country."""
        return (
            self.store_sites.select("country_number", F.col("reference_site").alias("zone_code"))
            .dropDuplicates()
            .withColumn("zone_group", F.explode(F.array(F.lit(1), F.lit(2))))
            .withColumn("zone_name", F.concat_ws("-", "zone_code", F.col("zone_group").cast("string")))
        )

    # --- coefficient tables ---------------------------------------------------
    @cached_property
    def coef_department(self) -> DataFrame:
        brand = F.substring("department", 7, 10).cast("int") + F.length("country")
        return self.per_country(self.products.select("department").dropDuplicates()).select(
            "country", "department", (F.lit(0.625) + F.lit(0.125) * (brand % 3)).cast("decimal(10,3)").alias("coef_department")
        )

    @cached_property
    def coef_section(self) -> DataFrame:
        sections = self.products.groupBy("department", "section").agg(
            F.count("*").alias("n"), F.min(F.col("subgroup").cast("int")).alias("smallest")
        )
        factor = F.lit(0.5) + F.lit(0.125) * ((F.col("n") + F.length("country")) % 4)
        return self.per_country(sections.filter(F.col("smallest") <= 5)).select(
            "country", "department", "section", factor.cast("decimal(10,3)").alias("coef_section")
        )

    @cached_property
    def coef_division(self) -> DataFrame:
        """Coefficient of promotions without a price cut."""
        factor = F.lit(0.25) + F.lit(0.125) * ((F.length("division") + F.length("country")) % 3)
        return self.per_country(self.products.select("division").dropDuplicates()).select(
            "country", "division", factor.cast("decimal(10,3)").alias("coef_zero")
        )

    # --- ranging, plans, hours -------------------------------------------------
    @cached_property
    def product_range(self) -> DataFrame:
        """Products ranged per store: from first to last sale, open-ended if still sold.

        Taken from the order lines themselves: first and last days need no daily sums, and the lines are exchanged once.
        """
        last_year = F.lit(date(self.cfg.as_of.year, 1, 1))
        return (
            self.lines()
            .groupBy("country", "store", (F.col("l_partkey") + 1).alias("sku"))
            .agg(F.min("sale_date").alias("valid_from"), F.max("sale_date").alias("last_sale"))
            .select(
                "country",
                "store",
                "sku",
                "valid_from",
                F.when(F.col("last_sale") < last_year, F.col("last_sale")).alias("valid_to"),
            )
        )

    @cached_property
    def trading_hours(self) -> DataFrame:
        """Hours per store and week; each order a weekday handled counts four hours."""
        monday = week_monday(F.col("sale_date"))
        lines = self.lines().select(
            "country", (F.col("store") + 1001).alias("store_number"), "sale_date", "l_orderkey"
        )
        per_day = lines.groupBy("country", "store_number", "sale_date").agg(
            (F.count_distinct("l_orderkey") * 4).alias("hours")
        )
        week = F.weekofyear("monday")
        label = (
            F.when(week % 4 == 0, "STANDARD CLOSE")
            .when(week % 4 == 1, "THIS WEEK CLOSE")
            .when(week % 4 == 2, "WEEK + 1 CLOSE")
            .otherwise("WEEK + 3 CLOSE")
        )
        return (
            per_day.groupBy("country", "store_number", monday.alias("monday"))
            .agg(
                *[
                    F.sum(F.when(F.weekday("sale_date") == n - 1, F.col("hours")).otherwise(0)).alias(f"hours_{n}")
                    for n in range(1, 8)
                ]
            )
            .withColumn("label", label)
            .withColumn("created_date", F.date_add("monday", 2))
            .drop("monday")
        )

    # --- deliveries ---------------------------------------------------------------
    def delivered(self, name: str, rows: DataFrame) -> SnapshotTable:
        """Write snapshots of a stand-in table below the staging folder."""
        return SnapshotTable(self.spark, new_staging_path(self.spark, name)).deliver(rows)

    def outdated(self, rows: DataFrame, *changed: tuple[str, Column]) -> DataFrame:
        """An old delivery of the same table with other values."""
        old = F.lit(self.cfg.as_of - timedelta(days=STALE_DAYS))
        return rows.withColumns(dict(changed)).withColumn(SNAPSHOT, old)

    def hours_deliveries(self, hours: DataFrame) -> SnapshotTable:
        """Trading hours over the last days, each store on a day of its own, and a delivery too old to count, all stores closed."""
        age = (F.col("store_number") % 6).cast("int")
        current = hours.withColumn(SNAPSHOT, F.date_sub(F.lit(self.cfg.as_of), age))
        closed = [(f"hours_{n}", F.when(F.lit(n) == 3, F.lit(7)).otherwise(F.lit(0)).cast("long")) for n in range(1, 8)]
        return self.delivered("hours", current.unionByName(self.outdated(hours.filter(F.col("store_number") % 2 == 0), *closed)))

    @cached_property
    def extract_deliveries(self) -> SnapshotTable:
        """The suppliers' extracts of the run's day, and older ones in which every step was promoted."""
        promoted = [(f"step_{n}", F.lit("P")) for n in range(1, 8)]
        rows = self.step_codes.withColumn("age", F.explode(F.when(F.col("sku") % 5 == 0, F.array(F.lit(0), F.lit(STALE_DAYS))).otherwise(F.array(F.lit(0)))))
        current = F.col("age") == 0
        steps = {name: F.when(current, F.col(name)).otherwise(old) for name, old in promoted}
        dated = rows.withColumns(steps).withColumn(SNAPSHOT, F.date_sub(F.lit(self.cfg.as_of), F.col("age")))
        return self.delivered("extracts", dated.drop("age"))

    def extracts(self, day: date) -> list[DataFrame]:
        """Each supplier's extract of a day."""
        delivered = self.extract_deliveries.on(day)
        return [delivered.filter(F.col("supplier") == s).drop("supplier") for s in SUPPLIERS]

    @cached_property
    def plan_deliveries(self) -> SnapshotTable:
        """The day plan of the run's day, and an older one with other shares."""
        halved = [(f"day_{n}", F.col(f"day_{n}") / 2) for n in range(1, 8)]
        current = self.day_plan.withColumn(SNAPSHOT, F.lit(self.cfg.as_of))
        return self.delivered("plan", current.unionByName(self.outdated(self.day_plan.filter(F.col("plan_sku") % 7 == 1), *halved)))

    @cached_property
    def code_deliveries(self) -> SnapshotTable:
        """Stock-group codes by country and product: delivered on the product's last day, for some also before, with another code."""
        codes = self.per_country(self.products.select("sku", "code"))
        last = F.date_sub(F.lit(self.cfg.as_of), (F.col("sku") % 3).cast("int"))
        before = F.date_sub(F.lit(self.cfg.as_of), (F.col("sku") % 3 + 1).cast("int"))
        current = codes.withColumn(SNAPSHOT, last)
        older = codes.filter(F.col("sku") % 2 == 0).withColumn("code", F.lit("ZZ9999")).withColumn(SNAPSHOT, before)
        return self.delivered("codes", current.unionByName(older))

    @cached_property
    def folded_calendar(self) -> DataFrame:
        """The calendar with week 53 counted as week 01, as the upload uses it."""
        return fiscal_calendar(self.calendar.select("iso_date"), fold_week_53=True)

    @cached_property
    def enforced(self) -> DataFrame:
        """Nodes with relaxed thresholds (small sections, in some countries) and finest nodes left out of groups."""
        p = self.products
        event = F.lit(self.cfg.event_id_key).alias("event_id")
        sections = (
            self.per_country(p.groupBy("division", "department", "section").count())
            .filter((F.col("count") >= 3) & (F.length("country") % 2 == 0))
            .select(
                event,
                "country",
                F.concat_ws("-", "division", "department", "section").alias("node_id"),
                F.lit(3).alias("level"),
                F.lit(1).alias("enforce_calculation"),
                F.lit(0).alias("exclusion_grp"),
            )
        )
        finest = (
            self.per_country(p)
            .filter(F.col("subgroup") == F.when(F.length("country") % 2 == 0, "50").otherwise("49"))
            .select(
                event,
                "country",
                F.concat_ws("-", "division", "department", "section", "grp", "subgroup").alias("node_id"),
                F.lit(5).alias("level"),
                F.lit(0).alias("enforce_calculation"),
                F.lit(1).alias("exclusion_grp"),
            )
            .dropDuplicates()
        )
        return sections.unionByName(finest)

    @cached_property
    def code_mapping(self) -> DataFrame:
        """Stock-group code of each country's departments and finest nodes; NULL = rolled up."""
        p = self.products
        none = F.lit(None).cast("string")
        low_high = F.when(F.length("country") % 2 == 0, F.col("low")).otherwise(F.col("high")).alias("sg_cd")
        short = F.substring("code", 1, 4)
        department = self.per_country(
            p.groupBy("division", "department").agg(F.min(short).alias("low"), F.max(short).alias("high"))
        )
        finest = self.per_country(
            p.groupBy("division", "department", "section", "grp", "subgroup").agg(
                F.min("code").alias("low"), F.max("code").alias("high")
            )
        )
        finest = finest.select("country", "division", "department", "section", "grp", "subgroup", low_high)
        return department.select(
            "country",
            "division",
            "department",
            none.alias("section"),
            none.alias("grp"),
            none.alias("subgroup"),
            low_high,
        ).unionByName(finest)

    @property
    def step_codes(self) -> DataFrame:
        """Step codes of three suppliers per store, product and week of the order, by return flag."""
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("step_date"))
        week = year_week(F.col("fiscal_year"), F.col("fiscal_week"))
        code = F.when(F.col("l_discount") >= PROMO_DISCOUNT, F.when(F.col("l_linestatus") == "O", "P").otherwise("B"))
        rows = fiscal_calendar(self.lines().join(orders, "l_orderkey"), "step_date").withColumn("step", F.coalesce(code, F.lit("N")))
        return rows.groupBy(
            F.col("l_returnflag").alias("supplier"),
            "country",
            "store",
            (F.col("store") + 1001).alias("store_number"),
            (F.col("l_partkey") + 1).alias("sku"),
            week.alias("year_week"),
        ).agg(*[F.max(F.when(F.col("weekday") == n, F.col("step"))).alias(f"step_{n}") for n in range(1, 8)])

    @cached_property
    def day_plan(self) -> DataFrame:
        """Day plans: system plans by code prefix and product, user plans by week."""
        columns = [
            "country", "store", "plan_sku", "plan_code", "plan_week", "next_calc_week", "updated_by", "kind",
            *[f"day_{n}" for n in range(1, 8)],
        ]

        def tagged(sums: DataFrame, sku: Column, code: Column, week: Column, following: Column, by: str, kind: str) -> DataFrame:
            named = {
                "plan_sku": sku.cast("bigint"),
                "plan_code": code,
                "plan_week": week,
                "next_calc_week": following,
                "updated_by": F.lit(by),
                "kind": F.lit(kind),
            }
            return shares(sums).withColumns(named).select(*columns)

        start, no_expiry = F.lit("200040"), F.lit(NO_EXPIRY_WEEK)
        place = ["country", "store"]
        sold_once = F.col("n_rows") == 2
        # A store's products are one row each, and a product's codes too, so sums by product are sums along the row's days.
        codes = stage(self.products.groupBy("sku", "code").agg(F.count("*").cast("int").alias("copies")), "product_codes")
        sales = self.sold_days.join(codes, "sku").select(*place, "sku", "code", repeated(F.col("days"), F.col("copies")).alias("days"))
        by_product = sales.select(*place, "sku", "code", week_days("days")).select(*place, "sku", "code", *weekday_totals("days"))
        code = F.when(sold_once, F.substring("code", 1, 5)).otherwise(F.col("code"))
        following = F.when(sold_once, F.lit("200048")).otherwise(no_expiry)
        prefixes = F.explode(F.array(*[F.substring("code", 1, n) for n in range(1, 6)])).alias("prefix")
        by_code = add_up(add_up(by_product, [*place, "code"]).select("*", prefixes), [*place, "prefix"])
        promoted = sales.select(*place, "sku", "code", F.filter("days", lambda d: d["qty_promo"] > 0).alias("days"))
        dated = promoted.select(*place, "sku", "code", week_days("days", weeks=True))
        weeks = F.explode(F.array_distinct(F.transform("days", lambda d: d["week"]))).alias("week")
        of_week = F.filter("days", lambda d: d["week"].eqNullSafe(F.col("week"))).alias("days")
        weekly = dated.select("*", weeks).select(*place, "sku", "code", "week", of_week)
        product_weeks = weekly.select(*place, "sku", "code", "week", *weekday_totals("days"))
        both = F.explode(F.array(F.substring("code", 1, 5), F.substring("code", 1, 4))).alias("prefix")
        code_weeks = add_up(add_up(product_weeks, [*place, "code", "week"]).select("*", both), [*place, "prefix", "week"])
        parts = [
            tagged(by_product, F.col("sku"), code, start, following, "SYSTEM", "PTP"),
            tagged(by_code, F.lit(0), F.col("prefix"), start, no_expiry, "SYSTEM", "PTP"),
            tagged(product_weeks, F.col("sku"), F.col("code"), F.col("week"), no_expiry, "USER", "PTG"),
            tagged(code_weeks, F.lit(0), F.col("prefix"), F.col("week"), no_expiry, "USER", "PTG"),
        ]
        return reduce(DataFrame.unionByName, parts)

    @cached_property
    def weekday_values(self) -> DataFrame:
        """Weekday shares per store by department and section; '0' stands for all."""
        sales = self.daily_sales().join(self.products.select("sku", "department", "section"), "sku")
        zero, brand = F.lit("0"), F.substring("department", 7, 10).cast("int")
        key = ["country", "store", "department", "section"]
        sections = weekday_sums(sales, key)
        departments = add_up(sections.filter(brand % 2 == 0).withColumn("section", zero), key)
        overall = add_up(sections.withColumn("section", zero).withColumn("department", zero), key)
        rows = shares(sections.filter(brand % 3 != 0).unionByName(departments).unionByName(overall))
        return rows.select(*key, *[f"day_{n}" for n in range(1, 8)], F.lit(1).alias("is_active"))

    @cached_property
    def week_coefficients(self) -> DataFrame:
        """Promo-week coefficients of each country's departments and sections."""
        per_section = self.per_country(self.products.groupBy("department", "section").agg(F.count("*").alias("n")))
        n = F.col("n") + F.length("country")
        return per_section.select(
            "country",
            "department",
            "section",
            *[(F.lit(1.0) - F.lit(0.0625) * ((n + k) % 5)).alias(f"coef_w{k}") for k in range(1, 11)],
        )

    @cached_property
    def default_clusters(self) -> DataFrame:
        """Format-based cluster of every store."""
        return self.stores.select(
            "country",
            "store",
            F.when(F.col("format") == "HM", "Large-Moderate").otherwise("Small-Moderate").alias("store_cluster"),
        )

    @cached_property
    def sales_clusters(self) -> DataFrame:
        """Cluster per division and store by sales against the country's mean; weak stores have none."""
        # Of the lines themselves: sums by division need no daily sums, and the lines no exchange of their own.
        sales = (
            self.sold(())
            .join(self.products.select("sku", "division"), "sku")
            .groupBy("country", "division", "store")
            .agg(F.sum(F.col("qty_promo") + F.col("qty_regular")).alias("qty"))
        )
        mean = F.avg("qty").over(Window.partitionBy("country", "division"))
        return (
            sales.withColumn("mean_qty", mean)
            .filter(F.col("qty") * 2 >= F.col("mean_qty"))
            .select(
                "country",
                "division",
                "store",
                F.when(F.col("qty") >= F.col("mean_qty"), "Large-Moderate").otherwise("Small-Moderate").alias("store_cluster"),
            )
        )

    @cached_property
    def this_week_hours(self) -> DataFrame:
        """Trading hours where every row speaks for its own week."""
        return self.trading_hours.withColumn("label", F.lit("THIS WEEK CLOSE"))

    @cached_property
    def event_targets(self) -> DataFrame:
        """Targets of this year's event days: day shares of each level's sales; sections by hand."""
        days = fy_event_days(self.controls.filter(F.col("year") == self.cfg.fy_year))
        days = days.select("country", F.col("param").alias("division"), F.col("iso_date").alias("sale_date"))
        sales = (
            self.daily_sales()
            .join(self.products.drop("code", "description"), "sku")
            .join(days, ["country", "division", "sale_date"])
            .join(self.default_clusters, ["country", "store"])
            .withColumn("sales", F.col("qty_promo") + F.col("qty_regular"))
        )
        per_day = (
            explode_levels(sales.drop("sku", "store", "qty_promo", "qty_regular"))
            .groupBy("country", "level", "node_id", "store_cluster", F.col("sale_date").alias("iso_date"))
            .agg(F.sum("sales").alias("sales"))
        )
        week = Window.partitionBy("country", "node_id", "store_cluster", week_monday(F.col("iso_date")))
        return per_day.select(
            F.lit(self.cfg.event_id_key).alias("event_id"),
            "country",
            "node_id",
            "iso_date",
            "store_cluster",
            F.when(F.col("level") == 3, "USER").otherwise("SYSTEM").alias("target_type"),
            (ratio(F.col("sales"), F.sum("sales").over(week)) * 100).alias("final_target"),
        )


def summed_by_day(sold: DataFrame) -> DataFrame:
    """Quantities of a product, store and day."""
    sums = [F.sum(q).alias(q) for q in ("qty_promo", "qty_regular")]
    return sold.groupBy("country", "store", "sku", "sale_date").agg(*sums)


def promo_end() -> Column:
    """Last day of a promotion: one in 50 runs for up to 90 days."""
    days = F.when(F.col("promo_code") % 50 == 0, F.col("promo_code") % 90).otherwise(F.col("promo_code") % 28)
    return F.date_add("promo_start", days.cast("int")).alias("promo_end")


def repeated(days: Column, times: Column) -> Column:
    """The entries of an array as often as its product is listed."""
    return F.when(times > 1, F.flatten(F.array_repeat(days, times))).otherwise(days)


def week_days(days: str, weeks: bool = False) -> Column:
    """Weekday and quantity of every sales day of an array, and with ``weeks`` its fiscal week."""

    def seen(day: Column) -> Column:
        year, week, weekday = fiscal_day(day["sale_date"])
        qty = (day["qty_promo"] + day["qty_regular"]).alias("qty")
        return F.struct(weekday.alias("weekday"), qty, *([year_week(year, week).alias("week")] if weeks else []))

    return F.transform(days, seen).alias(days)


def weekday_totals(days: str) -> list[Column]:
    """What ``weekday_sums`` gives, of the entries of an array: a weekday without a quantity has none."""
    only = F.get(days, F.lit(0))

    def total(n: int) -> Column:
        def add(sum_: Column, day: Column) -> Column:
            return F.when(day["weekday"] == n, F.coalesce(sum_ + day["qty"], sum_, day["qty"])).otherwise(sum_)

        several = F.aggregate(days, F.lit(None).cast("double"), add)
        return F.when(F.size(days) == 1, F.when(only["weekday"] == n, only["qty"])).otherwise(several).alias(f"q{n}")

    return [F.size(days).cast("long").alias("n_rows"), *[total(n) for n in range(1, 8)]]


def weekday_sums(sales: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the number of rows and the quantity on each weekday (q1..q7)."""
    qty = F.col("qty_promo") + F.col("qty_regular")
    day = F.weekday("sale_date") + 1
    return sales.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), *[F.sum(F.when(day == n, qty)).alias(f"q{n}") for n in range(1, 8)]
    )


def add_up(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Weekday sums of a coarser key."""
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n_rows", *[f"q{n}" for n in range(1, 8)])])


def shares(sums: DataFrame) -> DataFrame:
    """Weekday sums as percentages of the key's total (day_1..day_7)."""
    total = total_of([F.col(f"q{n}") for n in range(1, 8)])
    return sums.withColumns({f"day_{n}": ratio(F.col(f"q{n}") * 100.0, total) for n in range(1, 8)})


def leaflet_text(start: Column, sku: Column, code: Column) -> Column:
    """Comma list of three leaflet dates with a time part; empty for early codes of a product."""
    days = [F.date_add(start, d) for d in (F.lit(0), (sku % 15).cast("int"), (code % 71).cast("int"))]
    return F.concat_ws(",", *[F.concat(d.cast("string"), F.lit(" 00:00:00")) for d in days])
