"""Five-level roll-up, gates, daily uplift, smoothing and the multi-year profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from festivo.checks.registry import CFG, SCALED_GATES, register
from festivo.checks.runs import model, retail
from festivo.checks.sales import register_runs
from festivo.checks.views import NODE, VIEWS
from festivo.operators import rollup as R, series as T

LEVELS = ["division", "department", "section", "grp", "subgroup"]
KEY = "level, country, node_id, store_cluster"
DAY = "is_base, event_offset, fiscal_year, fiscal_week, iso_date, weekday, is_holiday"
MEASURES = "sum(sales_promo) AS sales_promo, sum(sales_regular) AS sales_regular, sum(sales) AS sales"


def codes(depth: int) -> str:
    return ", ".join(c if i <= depth else f"'-' AS {c}" for i, c in enumerate(LEVELS, start=1))


def level_node(depth: int) -> str:
    return " || '-' || ".join(LEVELS[:depth])


def level_arm(depth: int) -> str:
    enforced = f"""coalesce((SELECT max(enforce) FROM v_enforced h WHERE h.country = b.country AND h.node_id = {level_node(depth)}), 0)"""
    left_out = "WHERE (country, node_id) NOT IN (SELECT (country, node_id) FROM v_enforced WHERE level = 5 AND excl = 1)"
    return f"""
SELECT *, {enforced if depth >= 3 else "0"} AS enforced FROM (
  SELECT {depth} AS level, country, {level_node(depth)} AS node_id, {codes(depth)}, store_cluster, {DAY}, store,
    sum(avg_products) AS avg_products, {MEASURES}
  FROM v_baseline {left_out if depth == 4 else ""} GROUP BY ALL) b"""


VIEWS["v_level_stores"] = " UNION ALL ".join(f"({level_arm(d)})" for d in range(1, 6))
VIEWS["v_levels"] = f"""
SELECT level, country, node_id, {", ".join(LEVELS)}, store_cluster, enforced, {DAY}, count(DISTINCT store) AS store_count,
  sum(CASE WHEN sales = 0 THEN 1 ELSE 0 END) AS zero_count, round(avg(avg_products), 0) AS avg_products, {MEASURES}
FROM v_level_stores GROUP BY ALL"""

_level_spec = (
    "level:i country:s node_id:s division:s department:s section:s grp:s subgroup:s store_cluster:s enforced:i "
    "is_base:i event_offset:i fiscal_year:i fiscal_week:s iso_date:s weekday:i is_holiday:i sales_promo:f "
    "sales_regular:f sales:f"
)
register(
    "hierarchy_rollup",
    lambda spark, root: model(spark, root).levels,
    "SELECT * FROM v_levels",
    _level_spec + " store_count:i zero_count:i avg_products:f",
)


def _enforced(spark: SparkSession, root: str) -> DataFrame:
    m = model(spark, root)
    rows = R.store_levels(m.baseline, m.retail.enforced, CFG.event_id)
    return R.enforced_hierarchies(rows, m.retail.enforced, CFG.event_id)


register(
    "enforced_hierarchies",
    _enforced,
    "SELECT * FROM v_level_stores",
    _level_spec + " store:i",
)

_w = f"PARTITION BY {KEY}"
_ww = f"PARTITION BY {KEY}, fiscal_year, fiscal_week"
VIEWS["v_stats"] = f"""
SELECT *, max(promo_ratio_weekly) OVER ({_w}) AS max_promo_ratio_weekly
FROM (SELECT *, count(sales) OVER ({_w}) AS n_rows, sum(zero_count) OVER ({_w}) AS sum_zero_count,
  sum(store_count) OVER ({_w}) AS sum_store_count, sum(sales) OVER ({_w}) AS total_sales,
  coalesce(sum(sales) OVER ({_w}) / nullif(count(sales) OVER ({_w}) * store_count * avg(avg_products) OVER ({_w}), 0), 0)
    AS sales_ratio,
  coalesce(sum(CASE WHEN is_base = 1 THEN sales END) OVER ({_w})
    / nullif(count(CASE WHEN is_base = 1 THEN sales END) OVER ({_w}) * store_count * avg(avg_products) OVER ({_w}), 0), 0)
    AS sales_ratio_base,
  min(CASE WHEN is_holiday = 0 AND strftime(iso_date, '%m-%d') <> '12-24' THEN sales END) OVER ({_w}) AS minimum_sales,
  sum(sales_promo) OVER ({_w}) / nullif(sum(sales_regular) OVER ({_w}), 0) AS promo_ratio,
  sum(sales_promo) OVER ({_ww}) / nullif(sum(sales_regular) OVER ({_ww}), 0) AS promo_ratio_weekly,
  avg(CASE WHEN event_offset <= 0 AND is_base = 0 THEN sales END) OVER ({_w})
    / nullif(avg(CASE WHEN is_base = 1 THEN sales END) OVER ({_w}), 0) AS event_base_ratio,
  sales / nullif(sum(sales) OVER ({_ww}), 0) AS day_share
FROM v_levels)"""
_stat_spec = (
    " n_rows:i sum_zero_count:i sum_store_count:i total_sales:f sales_ratio:f sales_ratio_base:f minimum_sales:f "
    "promo_ratio:f promo_ratio_weekly:f max_promo_ratio_weekly:f event_base_ratio:f day_share:f"
)
register(
    "node_window_stats",
    lambda spark, root: model(spark, root).node_stats,
    "SELECT * FROM v_stats",
    "level:i country:s node_id:s store_cluster:s is_base:i iso_date:s" + _stat_spec,
)


def gate_sql(level: str) -> str:
    g = SCALED_GATES[level]
    tests = [
        (g.min_ratio, "sales_ratio > {}"),
        (g.min_sales, "minimum_sales > {}"),
        (g.sales_per_row, "total_sales > n_rows * {}"),
        (g.min_ratio_to_base, "sales_ratio / nullif(sales_ratio_base, 0) > {}"),
        (g.max_weekly_promo_ratio, "max_promo_ratio_weekly <= {}"),
        (g.min_event_base_ratio, "event_base_ratio > {}"),
    ]
    ordinary = " AND ".join(t.format(v) for v, t in tests if v is not None) or "TRUE"
    if g.enforced_min_sales is None:
        return ordinary
    relaxed = f"minimum_sales > {g.enforced_min_sales} AND total_sales > n_rows * {g.enforced_sales_per_row}"
    return f"CASE WHEN enforced = 1 THEN {relaxed} ELSE {ordinary} END"


VIEWS["v_gated"] = " UNION ALL ".join(
    f"SELECT *, sum(sales) OVER ({_ww}) AS week_sales, "
    f"sum(sales) OVER ({_ww}) / nullif(sum(CASE WHEN is_base = 1 THEN sales END) OVER ({_w}), 0) AS week_ratio "
    f"FROM v_stats WHERE level = {depth} AND ({gate_sql(level)})"
    for depth, level in enumerate(LEVELS, start=1)
)
register(
    "node_quality_gate",
    lambda spark, root: model(spark, root).gated,
    "SELECT * FROM v_gated",
    "level:i country:s node_id:s store_cluster:s is_base:i iso_date:s enforced:i minimum_sales:f total_sales:f n_rows:i "
    "week_sales:f week_ratio:f",
)

VIEWS["v_shift"] = """
SELECT k.country, k.param, l.iso_date, f.weekday AS fy_weekday
FROM v_controls k JOIN v_controls n ON n.country = k.country AND n.param = k.param AND n.year = k.year + 1
JOIN v_cal l ON l.iso_date >= $base_monday$ AND l.iso_date <= k.date_to AND l.fiscal_year = year(k.event_date)
JOIN v_cal f ON f.fiscal_year = l.fiscal_year + 1 AND f.iso_date - n.event_date = l.iso_date - k.event_date
WHERE k.year = $ly$"""
VIEWS["v_uplift"] = f"""
SELECT *, division AS param, sales / nullif(base_sales_ly, 0) AS uplift,
  coalesce(sum(sales) OVER ({_w} ORDER BY iso_date, is_base ROWS BETWEEN 5 FOLLOWING AND 8 FOLLOWING)
    / nullif(sum(sales) OVER ({_w} ORDER BY iso_date, is_base ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING), 0), 1) AS forward_ratio
FROM (SELECT *,
    sum(CASE WHEN is_base = 1 THEN sales END) OVER ({_w}, weekday) AS base_sales_ly,
    sum(CASE WHEN is_base = 1 THEN day_share END) OVER ({_w}, weekday) AS base_share_ly,
    first_value(iso_date) OVER ({_w}, weekday ORDER BY event_offset, is_base) AS base_date,
    sum(CASE WHEN is_base = 1 THEN sales END) OVER ({_w}, fy_weekday) AS base_sales_fy,
    sum(CASE WHEN is_base = 1 THEN day_share END) OVER ({_w}, fy_weekday) AS base_share_fy
  FROM (SELECT g.*, CASE WHEN is_base = 1 THEN weekday ELSE s.fy_weekday END AS fy_weekday
    FROM v_gated g LEFT JOIN v_shift s ON s.iso_date = g.iso_date AND s.param = g.division AND s.country = g.country))"""
register_runs(
    "all_levels_uplift",
    lambda m: m.uplift,
    "SELECT * FROM v_uplift",
    "level:i country:s node_id:s store_cluster:s is_base:i iso_date:s weekday:i fy_weekday:i sales:f base_sales_ly:f "
    "base_share_ly:f base_date:s base_sales_fy:f base_share_fy:f uplift:f forward_ratio:f",
)


def _forward_ratio(spark: SparkSession, root: str) -> DataFrame:
    r = retail(spark, root)
    series = (
        r.daily_sales()
        .join(r.products.select("sku", "division"), "sku")
        .groupBy("country", "division", "sale_date")
        .agg(F.sum(F.col("qty_promo") + F.col("qty_regular")).alias("sales"))
    )
    return R.rolling_forward_ratio(series, Window.partitionBy("country", "division"), ["sale_date"])


register(
    "rolling_forward_ratio",
    _forward_ratio,
    """SELECT country, division, sale_date, sales,
      coalesce(sum(sales) OVER (PARTITION BY country, division ORDER BY sale_date ROWS BETWEEN 5 FOLLOWING AND 8 FOLLOWING)
        / nullif(sum(sales) OVER (PARTITION BY country, division ORDER BY sale_date ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING), 0), 1)
      AS forward_ratio
    FROM (SELECT country, division, sale_date, sum(qty_promo + qty_regular) AS sales
          FROM v_daily JOIN v_products USING (sku) GROUP BY ALL)""",
    "country:s division:s sale_date:s sales:f forward_ratio:f",
)


def _moving_average(spark: SparkSession, root: str) -> DataFrame:
    events = retail(spark, root).table("events")
    series = events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum("value").alias("sales"))
    return T.centered_moving_average(series, ["event_type"], ["day"])


register(
    "centered_moving_average",
    _moving_average,
    """SELECT *, cma / nullif(sales, 0) AS cma_ratio, CASE WHEN 1 - cma / nullif(sales, 0) < -0.999 THEN -0.999
        WHEN 1 - cma / nullif(sales, 0) > 0.999 THEN 0.999 ELSE 1 - cma / nullif(sales, 0) END AS seasonal_factor
    FROM (SELECT *, avg(ma_6) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS cma
      FROM (SELECT *, avg(sales) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS ma_6
        FROM (SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS sales FROM events GROUP BY ALL)))""",
    "event_type:s day:s sales:f ma_6:f cma:f cma_ratio:f seasonal_factor:f",
)

VIEWS["v_series"] = f"""
SELECT *, CASE WHEN 1 - cma / nullif(sales, 0) < -0.999 THEN -0.999
  WHEN 1 - cma / nullif(sales, 0) > 0.999 THEN 0.999 ELSE 1 - cma / nullif(sales, 0) END AS seasonal_factor
FROM (SELECT *, avg(ma_6) OVER ({_w} ORDER BY event_offset, is_base ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS cma
  FROM (SELECT *, avg(sales) OVER ({_w} ORDER BY event_offset, is_base ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS ma_6 FROM v_uplift))"""

# The days of every year that are as far from its event as last year's event days from theirs.
VIEWS["v_aligned"] = f"""
WITH spans AS (
  SELECT country, param, offset_from, offset_to, date_from - event_date AS first_offset, date_to - event_date AS last_offset
  FROM v_controls WHERE year = $ly$
), days AS (
  SELECT country, param AS division, year AS norm_year, event_date + CAST(o AS INTEGER) AS sale_date, o AS event_offset,
    CAST(o BETWEEN offset_from AND offset_to AS INTEGER) AS is_peak
  FROM (SELECT country, param, year, event_date, unnest(range(first_offset, last_offset + 1)) AS o, s.offset_from, s.offset_to
    FROM v_controls JOIN spans s USING (country, param) WHERE year IN ($norm_years$))
)
SELECT {", ".join("n." + c.strip() for c in NODE.split(","))}, store_cluster, norm_year, c.fiscal_year, event_offset, is_peak,
  CAST(holiday_date IS NOT NULL AS INTEGER) AS is_holiday, sum(sales) AS sales
FROM v_node_days n JOIN days d ON d.country = n.country AND d.division = n.division AND d.sale_date = n.sale_date
JOIN v_cal c ON c.iso_date = n.sale_date LEFT JOIN v_holidays h ON h.country = n.country AND holiday_date = n.sale_date GROUP BY ALL"""
register_runs(
    "aligned_multi_year_sales",
    lambda m: m.aligned,
    "SELECT * FROM v_aligned",
    "country:s division:s department:s section:s grp:s subgroup:s store_cluster:s norm_year:i event_offset:i is_peak:i "
    "is_holiday:i sales:f",
)


def norm_level(depth: int) -> str:
    rows = f"SELECT *, {level_node(depth)} AS node_id FROM v_aligned"
    if depth < 5:
        rows = f"""SELECT country, {level_node(depth)} AS node_id, store_cluster, fiscal_year, event_offset, is_peak, is_holiday,
          sum(sales) AS sales FROM v_aligned GROUP BY ALL"""
    low = "min(CASE WHEN is_holiday = 0 THEN sales END) OVER (PARTITION BY country, node_id, store_cluster, fiscal_year)"
    high = "max(sales) OVER (PARTITION BY country, node_id, store_cluster, fiscal_year)"
    return f"""
SELECT {depth} AS level, country, node_id, store_cluster, event_offset, is_peak, sum(norm) AS norm_sales
FROM (SELECT *, CASE WHEN is_holiday = 1 THEN 0 ELSE (sales - {low}) / nullif({high} - {low}, 0) END AS norm FROM ({rows}))
GROUP BY ALL"""


VIEWS["v_norm"] = f"""
SELECT *, CASE WHEN norm_deviation < -0.999 THEN -0.999 WHEN norm_deviation > 0.999 THEN 0.999 ELSE norm_deviation END
  AS norm_factor
FROM (SELECT *, (norm_sales - mean_norm) / nullif(mean_norm, 0) AS norm_deviation
  FROM (SELECT *, avg(CASE WHEN norm_sales <> 0 THEN norm_sales END) OVER (PARTITION BY {KEY}, is_peak) AS mean_norm
    FROM ({" UNION ALL ".join(f"({norm_level(d)})" for d in range(1, 6))})))"""
_norm_spec = "level:i country:s node_id:s store_cluster:s event_offset:i is_peak:i norm_sales:f mean_norm:f norm_deviation:f"
register(
    "minmax_normalise",
    lambda spark, root: T.minmax_normalise(model(spark, root).aligned),
    "SELECT * FROM v_norm",
    _norm_spec,
)
register(
    "norm_union_cap",
    lambda spark, root: model(spark, root).norm,
    "SELECT * FROM v_norm",
    _norm_spec + " norm_factor:f",
)
