"""Allocation of targets to promotion days, the upload and the audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.checks.calendar import open_grid
from festivo.checks.promotions import select_columns
from festivo.checks.registry import ADDED, CFG, ONE_WEEK, REUPLOAD, SELECTED, register
from festivo.checks.runs import upload
from festivo.checks.views import DAYS, VIEWS
from festivo.operators import allocation as A

TARGETS = select_columns("target_", "f")
DAY_ROW = "country:s promo_code:i sku:i promo_start:s promo_end:s store_number:i promo_date:s"

VIEWS["v_days"] = """
SELECT b.*, c.iso_date AS promo_date, c.fiscal_year, c.fiscal_week, c.weekday,
  ['monday', 'tuesday', 'wednesday', 'thursday', 'friday', 'saturday', 'sunday'][c.weekday] AS weekday_name,
  CAST(c.iso_date BETWEEN scope_from AND scope_to AS INTEGER) AS is_in_scope
FROM v_in_scope b LEFT JOIN v_fcal c ON c.iso_date BETWEEN b.promo_start AND b.promo_end WHERE $chosen_days$"""
register(
    "promo_day_explode",
    lambda spark, root: (lambda u: A.promo_day_explode(u.in_scope, u.retail.folded_calendar, CFG))(upload(spark, root)),
    "SELECT * FROM v_days",
    DAY_ROW + " fiscal_year:i fiscal_week:s weekday_name:s is_in_scope:i",
)

VIEWS["v_ranked"] = """
SELECT *, promo_date - promo_start + 1 AS promo_day,
  IF(promo_date - promo_start < 70, greatest((promo_date - promo_start) // 7, 0) + 1, 0) AS promo_week FROM v_days"""


def _rank(spark: SparkSession, root: str) -> DataFrame:
    u = upload(spark, root)
    return A.promo_day_rank(A.promo_day_explode(u.in_scope, u.retail.folded_calendar, CFG))


register("promo_day_rank", _rank, "SELECT * FROM v_ranked", DAY_ROW + " promo_day:i promo_week:i")

# The upload's own hours: every row speaks for its own week.
VIEWS["v_open_week"] = open_grid("SELECT * REPLACE ('THIS WEEK CLOSE' AS label) FROM v_hours_delivered")
VIEWS["v_open_days"] = f"""
SELECT r.*, CASE r.weekday {" ".join(f"WHEN {n} THEN o.day_{n}" for n in DAYS)} END AS store_open FROM v_ranked r
JOIN (SELECT country, store_number, fiscal_year, fiscal_week, {", ".join(f"max(day_{n}) AS day_{n}" for n in DAYS)}
  FROM v_open_week GROUP BY ALL) o USING (country, store_number, fiscal_year, fiscal_week)"""
register(
    "weekday_column_select",
    lambda spark, root: upload(spark, root).days,
    "SELECT * FROM v_open_days",
    DAY_ROW + " weekday:i store_open:i",
)

# Where a target may stand, best first: the finest node's user target, its system target, then the level above.
_nodes = ", ".join(f"{{'level': {i}, 'node_id': node_{level}}}" for i, level in enumerate(("subgroup", "grp", "section", "department", "division")))
VIEWS["v_resolved"] = f"""
WITH reached AS (SELECT DISTINCT country, node_subgroup, store_cluster, promo_date, [{_nodes}] AS nodes FROM v_open_days),
listed AS (SELECT country, node_subgroup, store_cluster, promo_date, unnest(nodes, recursive := true) FROM reached)
SELECT country, node_subgroup, store_cluster, promo_date,
  first(final_target ORDER BY level, target_type = 'SYSTEM') FILTER (final_target IS NOT NULL) AS target
FROM listed l JOIN v_targets t USING (country, node_id, store_cluster) WHERE t.iso_date = l.promo_date GROUP BY ALL"""
VIEWS["v_with_target"] = "SELECT * FROM v_open_days LEFT JOIN v_resolved USING (country, node_subgroup, store_cluster, promo_date)"


def _targets(spark: SparkSession, root: str) -> DataFrame:
    u = upload(spark, root)
    return A.target_fallback_lookup(u.days, u.in_scope, u.targets)


register("target_fallback_lookup", _targets, "SELECT * FROM v_with_target", DAY_ROW + " node_subgroup:s store_cluster:s target:f")

# Weekday values of the fallback division, best first: the section's, the department's, the store's.
_firsts = ", ".join(f"first(day_{n} ORDER BY rank) FILTER (day_{n} IS NOT NULL)" for n in DAYS)
VIEWS["v_weekday_best"] = f"""
WITH wanted AS (SELECT DISTINCT country, store, department, section FROM v_with_target WHERE division = '{CFG.base_promo_division}'),
ranked AS (SELECT k.*, rank, w.* EXCLUDE (country, store, department, section)
  FROM wanted k, (VALUES (1), (2), (3)) r(rank) JOIN v_weekday_values w ON w.country = k.country AND w.store = k.store
    AND w.department = IF(rank = 3, '0', k.department) AND w.section = IF(rank = 1, k.section, '0'))
SELECT country, store, department, section, [{_firsts}] AS week_values FROM ranked GROUP BY ALL"""
_leaflets = ", ".join(f"leaflet_w{n}" for n in range(1, 11))
_coefs = ", ".join(f"coef_w{n}" for n in range(1, 11))
VIEWS["v_targeted"] = f"""
SELECT *, coalesce(target, base_promo_value * base_promo_coefficient) AS target_all
FROM (SELECT b.*, IF(division = '{CFG.base_promo_division}', v.week_values[weekday], NULL) AS base_promo_value,
    IF(promo_week = 1 OR (promo_week > 1 AND [{_leaflets}][promo_week] = 0), [{_coefs}][promo_week], 1) AS base_promo_coefficient
  FROM v_with_target b LEFT JOIN v_weekday_best v USING (country, store, department, section)
  LEFT JOIN v_week_coef w USING (country, department, section))
WHERE target_all IS NOT NULL"""
register(
    "base_promo_target",
    lambda spark, root: upload(spark, root).targeted,
    "SELECT * FROM v_targeted",
    DAY_ROW + " target_all:f base_promo_value:f base_promo_coefficient:f",
)

_pool = "country, sku, promo_start, promo_end, store"
VIEWS["v_pooled"] = f"""
SELECT *, target_all * store_open AS stays, CAST(min(store_open) OVER (PARTITION BY {_pool} ORDER BY promo_date, promo_code
  ROWS BETWEEN 1 PRECEDING AND 3 FOLLOWING) = 0 AS INTEGER) AS pool FROM v_targeted"""
VIEWS["v_redistributed"] = f"""
WITH pools AS (SELECT {_pool}, pool, sum(target_all) AS offered, sum(stays) AS kept FROM v_pooled WHERE pool = 1 GROUP BY ALL)
SELECT p.*, coalesce(IF(p.pool = 1, stays + (offered - kept) * (stays / nullif(kept, 0)), stays), 0) AS target_final
FROM v_pooled p LEFT JOIN pools q ON q.country = p.country AND q.sku = p.sku AND q.promo_start = p.promo_start
  AND q.promo_end = p.promo_end AND q.store = p.store AND q.pool = p.pool"""
register(
    "closed_day_redistribution",
    lambda spark, root: upload(spark, root).redistributed.withColumn("pool", F.col("is_pooled").cast("int")),
    "SELECT * FROM v_redistributed",
    DAY_ROW + " pool:i target_all:f target_final:f",
)

_wide_key = "country, store, sku, promo_start, promo_end, code, fiscal_year, fiscal_week, start_week, end_week"
VIEWS["v_wide"] = f"""
SELECT {_wide_key}, {", ".join(f"min({{'c': promo_code, 'd': promo_date, 't': target_final}}) FILTER (weekday = {n}).t AS target_{n}" for n in DAYS)}
FROM v_redistributed GROUP BY {_wide_key}"""
_wide = f"country:s store:i sku:i promo_start:s promo_end:s code:s fiscal_year:i fiscal_week:s {TARGETS}"
register("weekday_pivot", lambda spark, root: upload(spark, root).wide, "SELECT * FROM v_wide", _wide)


# What an empty day takes, in order, by where its week lies in the promotion.
_plan_days = ", ".join(f"{kind}_day_{n}" for kind in ("start", "end", "regular_start", "regular_end", "plan") for n in DAYS)
VIEWS["v_plan_rows"] = f"SELECT DISTINCT country, store, sku, promo_start, promo_end, {_plan_days} FROM v_plans"
_fills = ", ".join(
    f"""coalesce(target_{n}, CASE its_week WHEN start_week THEN coalesce(start_day_{n}, regular_start_day_{n})
      WHEN end_week THEN coalesce(end_day_{n}, regular_end_day_{n}) END, plan_day_{n}) AS target_{n}"""
    for n in DAYS
)
VIEWS["v_backfilled"] = f"""
SELECT * EXCLUDE ({_plan_days}, its_week) REPLACE ({_fills})
FROM (SELECT *, CAST(fiscal_year AS VARCHAR) || fiscal_week AS its_week FROM v_wide)
LEFT JOIN v_plan_rows USING (country, store, sku, promo_start, promo_end)"""
register(
    "week_edge_backfill",
    lambda spark, root: (lambda u: A.week_edge_backfill(u.wide, u.plans))(upload(spark, root)),
    "SELECT * FROM v_backfilled",
    _wide,
)

_overridden = ", ".join(f"coalesce(h.day_{n}, target_{n}) AS target_{n}" for n in DAYS)


def overridden(source: str) -> str:
    days = ", ".join(f"day_{n}" for n in DAYS)
    return f"""SELECT w.* REPLACE ({_overridden}) FROM {source} w LEFT JOIN v_holiday_weeks h
      ON h.country = w.country AND h.fiscal_year = w.fiscal_year AND h.fiscal_week = w.fiscal_week"""


def numbered(source: str) -> str:
    newest = "ORDER BY promo_start DESC, promo_end DESC, code"
    return f"SELECT *, row_number() OVER (PARTITION BY country, store, sku, fiscal_year, fiscal_week {newest}) AS recency FROM ({source})"


VIEWS["v_final"] = f"SELECT * FROM ({numbered(overridden('v_backfilled'))}) WHERE $latest_only$"


def _override(spark: SparkSession, root: str) -> DataFrame:
    u = upload(spark, root)
    return A.holiday_override_wide(u.wide, u.holiday_weeks, ("country",))


register("holiday_override_wide", _override, overridden("v_wide"), _wide)
register(
    "latest_promo_per_week",
    lambda spark, root: A.latest_promo_per_week(upload(spark, root).wide, REUPLOAD),
    f"SELECT * FROM ({numbered('SELECT * FROM v_wide')}) WHERE recency = 1",
    _wide + " recency:i",
)

_capped = ", ".join(f"round(round(IF(target_{n} > 99.99, 99.9, target_{n}), 6), 1) AS target_{n}" for n in DAYS)
_audit = """
WITH audited AS (SELECT country, store FROM v_selling_stores WHERE NOT ($early$)),
listed AS (
  SELECT DISTINCT country, sku, listed_start AS promo_start, promo_end,
    coalesce(promo_end >= scope_from AND promo_start <= scope_to, FALSE) AS inside
  FROM v_scoped JOIN audited USING (country, store) WHERE $added_interval$
), generated AS (SELECT DISTINCT country, sku, promo_start, promo_end FROM v_final JOIN audited USING (country, store))
SELECT *, 'promo target generated' AS message FROM generated
UNION ALL
SELECT country, sku, promo_start, promo_end, 'excluded - not in event scope' FROM listed ANTI JOIN generated
  USING (country, sku, promo_start, promo_end) GROUP BY ALL HAVING NOT bool_or(inside)"""
_parameters = """$departments$ AS departments_selected, $sections$ AS excluded_sections_selected, $week$ AS promo_week_selected,
  $is_reupload$ AS week_reupload_selected, $is_added$ AS added_promotions_selected"""
# The upload and its audit, for all promotions, for chosen departments, for one week in both modes, and for added promotions.
for _name, _cfg in (("", CFG), ("selected_", SELECTED), ("week_", ONE_WEEK), ("reupload_", REUPLOAD), ("added_", ADDED)):
    register(
        f"{_name}upload_extract",
        lambda spark, root, cfg=_cfg: upload(spark, root, cfg).upload,
        f"SELECT country, store, code AS sg_cd, sku, fiscal_year, fiscal_week, {_capped} FROM v_final",
        f"country:s store:i sg_cd:s sku:i fiscal_year:i fiscal_week:s {TARGETS}",
        _cfg,
    )
    register(
        f"{_name}scope_audit",
        lambda spark, root, cfg=_cfg: upload(spark, root, cfg).audit,
        f"SELECT *, {_parameters} FROM ({_audit})",
        "country:s sku:i promo_start:s promo_end:s message:s departments_selected:s excluded_sections_selected:s promo_week_selected:s "
        "week_reupload_selected:s added_promotions_selected:s",
        _cfg,
    )
