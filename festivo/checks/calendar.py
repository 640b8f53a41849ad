"""Calendar, controls, holidays, trading hours."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.checks.registry import CFG, EASTER, register
from festivo.checks.runs import retail
from festivo.checks.views import DAYS, VIEWS
from festivo.config import HOURS_LABEL_SHIFTS, RunConfig
from festivo.operators import calendar as C
from festivo.plans.upload import UploadRun
from festivo.sources.retail import CONTROL_VALUES, Retail

DAY_SPEC = " ".join(f"day_{n}:i" for n in DAYS)


def _fiscal_calendar(spark: SparkSession, root: str) -> DataFrame:
    lines = retail(spark, root).table("lineitem")
    days = lines.groupBy(F.to_date("l_shipdate").alias("iso_date")).agg(F.count("*").alias("n_lines"))
    return C.fiscal_calendar(days, fold_week_53=True)


register(
    "fiscal_calendar",
    _fiscal_calendar,
    """SELECT iso_date, fiscal_year, fiscal_week, weekday, n_lines
    FROM (SELECT CAST(l_shipdate AS DATE) AS iso_date, count(*) AS n_lines FROM lineitem GROUP BY 1) JOIN v_fcal USING (iso_date)""",
    "iso_date:s fiscal_year:i fiscal_week:s weekday:i n_lines:i",
)


def sold_controls(r: Retail) -> DataFrame:
    """Control rows for every country and division in all years with sales, and in the year after."""
    sold = (
        r.lines()
        .join(r.table("part"), F.col("p_partkey") == F.col("l_partkey"))
        .select("country", F.col("p_type").alias("param"), F.year("l_shipdate").alias("sold"))
        .dropDuplicates()
        .select("country", "param", F.explode(F.array("sold", F.col("sold") + 1)).alias("year"))
        .dropDuplicates()
    )
    values = {**CONTROL_VALUES, "weeks_before": CFG.weeks_before, "weeks_after": CFG.weeks_after}
    text = {k: F.lit(str(v)) for k, v in values.items()}
    day = r.event_date(F.col("country"), F.col("param"), F.col("year"), range(1900, 2100))
    return C.event_controls(sold.withColumn("event_date", day.cast("string")).withColumns(text), r.calendar)


VIEWS["v_sold_controls"] = """
SELECT country, param, year, event_date, a.year_week, b.year_week AS year_week_from, c.year_week AS year_week_to,
  b.iso_date AS date_from, c.iso_date AS date_to
FROM (SELECT country, param, year, $event_day$ + CASE country WHEN 'AMERICA' THEN 1 WHEN 'ASIA' THEN -1 ELSE 0 END
      - CASE WHEN param = 'PROMO' THEN 1 ELSE 0 END AS event_date
    FROM (SELECT DISTINCT country, p_type AS param, year(l_shipdate) + more AS year
      FROM v_lines JOIN part ON p_partkey = l_partkey, (VALUES (0), (1)) n(more)))
JOIN v_cal a ON a.iso_date = event_date
LEFT JOIN v_cal b ON b.weekday = 1 AND b.iso_date BETWEEN event_date - 34 AND event_date - 28
LEFT JOIN v_cal c ON c.weekday = 7 AND c.iso_date BETWEEN event_date + 7 AND event_date + 13"""


def _shift_calendar(spark: SparkSession, root: str, cfg: RunConfig) -> DataFrame:
    r = retail(spark, root, cfg)
    shift = C.shift_calendar(r.calendar, sold_controls(r))
    sales = (
        r.daily_sales()
        .join(r.products.select("sku", F.col("division").alias("param")), "sku")
        .groupBy("country", "param", F.col("sale_date").alias("iso_date"))
        .agg(F.sum(F.col("qty_promo") + F.col("qty_regular")).alias("qty"))
    )
    return shift.join(sales, ["country", "param", "iso_date"])


for _prefix, _cfg in (("", CFG), ("easter_", EASTER)):
    register(
        f"{_prefix}event_controls",
        lambda spark, root, cfg=_cfg: sold_controls(retail(spark, root, cfg)),
        """SELECT country, param, year, event_date, year_week, year_week_from, year_week_to, date_from, date_to,
        0.625 AS c_uplift, 0.25 AS c_off_offset_uplift FROM v_sold_controls""",
        "country:s param:s year:i event_date:s year_week:s year_week_from:s year_week_to:s date_from:s date_to:s c_uplift:f "
        "c_off_offset_uplift:f",
        _cfg,
    )
    register(
        f"{_prefix}shift_calendar",
        lambda spark, root, cfg=_cfg: _shift_calendar(spark, root, cfg),
        """SELECT s.*, qty FROM (
          SELECT k.country, k.param, l.iso_date, datediff('day', k.event_date, l.iso_date) AS event_offset, l.weekday AS ly_weekday,
            f.iso_date AS fy_date, f.weekday AS fy_weekday, (f.weekday + 7 - l.weekday) % 7 AS weekday_shift
          FROM v_sold_controls k JOIN v_sold_controls n ON n.country = k.country AND n.param = k.param AND n.year = k.year + 1
          JOIN v_cal l ON l.iso_date BETWEEN k.date_from AND k.date_to AND l.fiscal_year = year(k.event_date)
          JOIN v_cal f ON f.fiscal_year = l.fiscal_year + 1
            AND datediff('day', n.event_date, f.iso_date) = datediff('day', k.event_date, l.iso_date)) s
        JOIN (SELECT country, division AS param, sale_date AS iso_date, sum(qty_promo + qty_regular) AS qty
              FROM v_daily JOIN v_products USING (sku) GROUP BY ALL) q USING (country, param, iso_date)""",
        "country:s param:s iso_date:s event_offset:i ly_weekday:i fy_date:s fy_weekday:i weekday_shift:i qty:f",
        _cfg,
    )
    register(
        f"{_prefix}year_offset",
        lambda spark, root, cfg=_cfg: C.year_offset(sold_controls(retail(spark, root, cfg)), cfg.event_id),
        """SELECT a.country, a.param, a.year AS ly_year, a.year_week AS peak_year_week,
          CASE WHEN $event_id$ = 'EASTER' THEN 0 ELSE day(b.event_date) - day(a.event_date)
            + CASE WHEN a.year % 4 = 3 THEN 2 ELSE 1 END END AS days_shift,
          CASE WHEN $event_id$ = 'EASTER' THEN 0 ELSE day(b.event_date) - day(a.event_date) END AS days_shift_raw
        FROM v_sold_controls a JOIN v_sold_controls b ON a.country = b.country AND a.param = b.param AND b.year = a.year + 1""",
        "country:s param:s ly_year:i days_shift:i days_shift_raw:i peak_year_week:s",
        _cfg,
    )


def _holiday_week_pivot(spark: SparkSession, root: str) -> DataFrame:
    r = retail(spark, root)
    sold = r.lines().select("country", F.col("sale_date").alias("holiday_date")).dropDuplicates()
    holidays = sold.join(r.holidays, ["country", "holiday_date"], "left_semi")
    return C.holiday_week_pivot(r.folded_calendar, holidays, ("country",))


register(
    "holiday_week_pivot",
    _holiday_week_pivot,
    f"""SELECT country, fiscal_year, fiscal_week,
      {", ".join(f"min(CASE WHEN weekday = {n} THEN 0 END) AS day_{n}" for n in DAYS)}
    FROM (SELECT DISTINCT country, sale_date AS holiday_date FROM v_lines) JOIN v_holidays USING (country, holiday_date)
    JOIN v_fcal ON iso_date = holiday_date GROUP BY country, fiscal_year, fiscal_week""",
    f"country:s fiscal_year:i fiscal_week:s {DAY_SPEC}",
)

VIEWS["v_holiday_weeks"] = f"""
SELECT country, fiscal_year, fiscal_week, {", ".join(f"min(CASE WHEN weekday = {n} THEN 0 END) AS day_{n}" for n in DAYS)}
FROM v_holidays JOIN v_fcal ON iso_date = holiday_date GROUP BY country, fiscal_year, fiscal_week"""

# Deliveries of the last days, and one too old to count in which every even store opens on Wednesdays only.
_columns = "country, store_number, created_date, label"
VIEWS["v_hours_delivered"] = f"""
SELECT *, $as_of$ - CAST(store_number % 6 AS INTEGER) AS snapshot_date FROM v_hours
UNION ALL BY NAME
SELECT {_columns}, {", ".join(f"{7 if n == 3 else 0} AS hours_{n}" for n in DAYS)}, $as_of$ - 8 AS snapshot_date
FROM v_hours WHERE store_number % 2 = 0"""


def open_grid(hours: str) -> str:
    """Open flags by store and week of the hours that the last six days' deliveries project, one weeks-ahead row a label and week."""
    ahead = ", ".join(f"('{label}', {days})" for label, shifts in HOURS_LABEL_SHIFTS.items() for days in shifts)
    flags = ", ".join(f"CAST(hours_{n} > 1 AS INTEGER) AS open_{n}" for n in DAYS)
    return f"""
SELECT g.* EXCLUDE ({", ".join(f"open_{n}" for n in DAYS)}), {", ".join(f"coalesce(h.day_{n}, open_{n}) AS day_{n}" for n in DAYS)}
FROM (SELECT DISTINCT country, store_number, c.fiscal_year, c.fiscal_week, {flags}
  FROM ({hours}) JOIN (VALUES {ahead}) w(ahead_label, days) ON ahead_label = label
  JOIN v_fcal c ON c.iso_date = created_date + days AND c.weekday = 3
  WHERE {" + ".join(f"hours_{n}" for n in DAYS)} > 6 AND store_number BETWEEN 1001 AND 5999
    AND snapshot_date BETWEEN $as_of$ - 6 AND $as_of$) g
LEFT JOIN v_holiday_weeks h USING (country, fiscal_year, fiscal_week)"""


VIEWS["v_open"] = open_grid("SELECT * FROM v_hours_delivered")


def _open_day_grid(spark: SparkSession, root: str) -> DataFrame:
    r = retail(spark, root)
    return UploadRun(r, r.spark.range(0), r.stores, r.trading_hours).open_days


register(
    "open_day_grid",
    _open_day_grid,
    "SELECT * FROM v_open",
    f"country:s store_number:i fiscal_year:i fiscal_week:s {DAY_SPEC}",
)


def _fy_calendar_grid(spark: SparkSession, root: str, cfg: RunConfig) -> DataFrame:
    r = retail(spark, root, cfg)
    nodes = (
        r.daily_sales()
        .join(r.products, "sku")
        .join(r.default_clusters, ["country", "store"])
        .select(
            "country",
            F.col("division").alias("param"),
            F.concat_ws("-", "division", "department").alias("node_id"),
            "store_cluster",
        )
        .dropDuplicates()
    )
    return C.fy_calendar_grid(r.calendar, r.holidays, nodes, C.fy_event_days(r.controls.filter(F.col("year") == cfg.fy_year)))


for _prefix, _cfg in (("", CFG), ("easter_", EASTER)):
    register(
        f"{_prefix}fy_calendar_grid",
        lambda spark, root, cfg=_cfg: _fy_calendar_grid(spark, root, cfg),
        """SELECT n.country, n.param, n.node_id, n.store_cluster, c.iso_date, datediff('day', event_date, c.iso_date) AS event_offset,
          c.fiscal_year, c.fiscal_week, c.weekday, CASE WHEN holiday_date IS NULL THEN 0 ELSE 1 END AS is_holiday
        FROM v_controls k JOIN v_cal c ON c.iso_date BETWEEN date_from AND date_to
        LEFT JOIN v_holidays h ON holiday_date = c.iso_date AND h.country = k.country
        JOIN (SELECT DISTINCT d.country, division AS param, division || '-' || department AS node_id, store_cluster
              FROM v_daily d JOIN v_products USING (sku) JOIN v_default_clusters USING (country, store)) n
          ON n.param = k.param AND n.country = k.country
        WHERE k.year = $fy$""",
        "country:s param:s node_id:s store_cluster:s iso_date:s event_offset:i fiscal_year:i fiscal_week:s weekday:i is_holiday:i",
        _cfg,
    )
