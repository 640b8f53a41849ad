"""Promotion operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from festivo.checks.registry import ADDED, CFG, register
from festivo.checks.runs import retail, upload
from festivo.checks.views import DAYS, VIEWS
from festivo.operators import promotions as P

PROMO = "country:s promo_code:i sku:i promo_start:s promo_end:s"


def select_columns(prefix: str, suffix: str = "i") -> str:
    return " ".join(f"{prefix}{n}:{suffix}" for n in DAYS)


_steps = ", ".join(f"'P' AS step_{n}, 1 AS promo_{n}" for n in DAYS)
VIEWS["v_flags_delivered"] = f"""
SELECT *, $as_of$ AS snapshot_date FROM v_flags
UNION ALL BY NAME
SELECT country, store, store_number, sku, year_week, {_steps}, $as_of$ - 8 AS snapshot_date FROM v_flags WHERE sku % 5 = 0"""
VIEWS["v_flags_today"] = """
SELECT * FROM v_flags_delivered WHERE store_number BETWEEN 1001 AND 5999 AND snapshot_date = $as_of$"""
register(
    "promo_day_flags",
    lambda spark, root: upload(spark, root).flags,
    "SELECT * FROM v_flags_today",
    f"country:s store_number:i sku:i year_week:s snapshot_date:s {select_columns('step_', 's')} {select_columns('promo_')}",
)

DEPARTMENTS, SECTIONS = (103, 107, 112, 5, 9, 21), (4, 17, 33)


def _dual(spark: SparkSession, root: str) -> DataFrame:
    r = retail(spark, root)
    return P.product_dual_hierarchy(r.reporting_hierarchy, r.second_hierarchy, DEPARTMENTS, SECTIONS)


register(
    "product_dual_hierarchy",
    _dual,
    f"""SELECT p_partkey + 1 AS sku, p_type AS division, p_name AS long_description, dep AS department_code,
      p_size AS section_code, p_size AS department_code_2, dep - 100 AS section_code_2
    FROM (SELECT *, CAST(substr(p_brand, 7) AS INTEGER) + 100 AS dep FROM part)
    WHERE ({" OR ".join(f"dep = {d}" if len(str(d)) > 2 else f"p_size = {d}" for d in DEPARTMENTS)})
      AND p_size NOT IN {SECTIONS}""",
    "sku:i division:s long_description:s department_code:i section_code:i department_code_2:i section_code_2:i",
)


def _zones(spark: SparkSession, root: str) -> DataFrame:
    r = retail(spark, root)
    return P.store_zone_link(r.store_sites, r.zones)


register(
    "store_zone_link",
    _zones,
    "SELECT * FROM v_zone_link",
    "country:s store_number:i zone_code:s zone_name:s",
)

VIEWS["v_promo_weeks"] = """
SELECT p.*, a.year_week AS start_week, a.weekday AS start_weekday, b.year_week AS end_week
FROM v_promos p LEFT JOIN v_fcal a ON a.iso_date = promo_start LEFT JOIN v_fcal b ON b.iso_date = promo_end
WHERE $chosen_week$"""
VIEWS["v_chosen_products"] = """
SELECT p_partkey + 1 AS sku FROM (SELECT *, CAST(substr(p_brand, 7) AS INTEGER) + 100 AS dep FROM part) WHERE $products$"""
VIEWS["v_added"] = f"""
SELECT p.country, promo_code, p.sku, promo_start, promo_end, start_weekday, start_week, end_week, f.store_number, z.zone_code,
  CASE WHEN z.zone_code IN ('Z' || CAST(promo_code % 4 AS VARCHAR), 'Z' || CAST(p.sku % 4 AS VARCHAR)) THEN 1 ELSE 0 END
    AS is_excluded_zone
FROM v_promo_weeks p JOIN v_chosen_products USING (sku) JOIN v_flags_today f ON f.country = p.country AND f.sku = p.sku AND f.year_week = p.start_week
  AND CASE {" ".join(f"WHEN start_weekday = {n} THEN promo_{n} = 1" for n in DAYS)} END
LEFT JOIN v_zone_link z ON z.country = p.country AND z.store_number = f.store_number"""


register(
    "added_promos",
    lambda spark, root: upload(spark, root, ADDED).added,
    "SELECT * FROM v_added",
    PROMO + " start_weekday:i start_week:s end_week:s store_number:i zone_code:s is_excluded_zone:i",
    ADDED,
)

VIEWS["v_plan_delivered"] = f"""
SELECT *, $as_of$ AS snapshot_date FROM v_plan_valid
UNION ALL
SELECT * REPLACE ({", ".join(f"day_{n} / 2 AS day_{n}" for n in DAYS)}), $as_of$ - 8 FROM v_plan_valid WHERE plan_sku % 7 = 1"""
VIEWS["v_plan_today"] = "SELECT * FROM v_plan_delivered WHERE snapshot_date = $as_of$"
register(
    "plan_validity",
    lambda spark, root: upload(spark, root).plan,
    "SELECT * FROM v_plan_today",
    f"country:s store:i plan_sku:i plan_code:s plan_week:s next_calc_week:s updated_by:s kind:s {select_columns('day_', 'f')} "
    "week_from:s week_to:s validity_days:i",
)


VIEWS["v_codes"] = """
SELECT country, sku, max_by(code, snapshot_date) AS code, max(snapshot_date) AS snapshot_date
FROM (SELECT country, sku, code, $as_of$ - CAST(sku % 3 AS INTEGER) AS snapshot_date FROM v_products, v_countries
  UNION ALL
  SELECT country, sku, 'ZZ9999', $as_of$ - CAST(sku % 3 + 1 AS INTEGER) FROM v_products, v_countries WHERE sku % 2 = 0)
GROUP BY country, sku"""
register(
    "latest_snapshot",
    lambda spark, root: upload(spark, root).codes,
    "SELECT * FROM v_codes",
    "country:s sku:i code:s snapshot_date:s",
)
register(
    "eligible_stores",
    lambda spark, root: upload(spark, root).stores,
    "SELECT * FROM v_selling_stores",
    "country:s store:i store_number:i format:s open_date:s close_date:s net_area:f",
)

_leaflets = ", ".join(
    f"try_cast(substr(split_part(leaflet_dates, ',', {k}), 1, 10) AS DATE) AS leaflet_{k}" for k in range(1, 11)
)
VIEWS["v_leaflets"] = f"SELECT *, {_leaflets} FROM v_promo_weeks"
register(
    "leaflet_parse",
    lambda spark, root: P.leaflet_parse(retail(spark, root).promos),
    "SELECT * FROM v_leaflets",
    PROMO + " " + " ".join(f"leaflet_{k}:s" for k in range(1, 11)),
)
VIEWS["v_leaflet_weeks"] = "SELECT *, " + ", ".join(
    "CASE WHEN "
    + " OR ".join(
        f"(leaflet_{k} >= promo_start + {7 * (n - 1)} AND leaflet_{k} <= promo_start + {7 * n - 1})" for k in range(1, 11)
    )
    + f" THEN 1 ELSE 0 END AS leaflet_w{n}"
    for n in range(1, 11)
) + " FROM v_leaflets"
register(
    "leaflet_week_flags",
    lambda spark, root: P.leaflet_week_flags(P.leaflet_parse(retail(spark, root).promos)),
    "SELECT * FROM v_leaflet_weeks",
    PROMO + " " + " ".join(f"leaflet_w{n}:i" for n in range(1, 11)),
)

VIEWS["v_sales_clusters"] = """
SELECT country, division, store, CASE WHEN qty >= mean_qty THEN 'Large-Moderate' ELSE 'Small-Moderate' END AS store_cluster
FROM (SELECT *, avg(qty) OVER (PARTITION BY country, division) AS mean_qty
  FROM (SELECT country, division, store, sum(qty_promo + qty_regular) AS qty FROM v_daily JOIN v_products USING (sku) GROUP BY ALL))
WHERE qty * 2 >= mean_qty"""
VIEWS["v_all_base"] = """
SELECT DISTINCT p.country, promo_code, p.sku, promo_start, promo_end, start_week, end_week, start_weekday,
  datediff('day', promo_start, promo_end) + 1 AS promo_duration, s.store, store_number,
  coalesce(c.store_cluster, IF(format = 'HM', 'Large-Moderate', 'Small-Moderate')) AS store_cluster,
  n.* EXCLUDE (sku, code, description), CAST(contains(description, 'I/O') AS INTEGER) AS in_out_check, d.code, leaflet_w1, leaflet_w2, leaflet_w3, leaflet_w4, leaflet_w5, leaflet_w6, leaflet_w7, leaflet_w8,
  leaflet_w9, leaflet_w10
FROM v_leaflet_weeks p JOIN v_chosen_products USING (sku) JOIN v_nodes n ON n.sku = p.sku
LEFT JOIN v_codes d ON d.country = p.country AND d.sku = p.sku JOIN v_selling_stores s ON s.country = p.country
LEFT JOIN v_sales_clusters c ON c.country = p.country AND c.store = s.store AND c.division = n.division"""
_base = PROMO + " store_number:i promo_duration:i start_weekday:i"
register(
    "promo_store_base",
    lambda spark, root: upload(spark, root).all_base,
    "SELECT * FROM v_all_base",
    _base + " start_week:s end_week:s store_cluster:s code:s node_subgroup:s node_department:s in_out_check:i leaflet_w1:i leaflet_w2:i",
)

VIEWS["v_early"] = """
SELECT * EXCLUDE (early) REPLACE (promo_start - early AS promo_start, start_weekday - early AS start_weekday, promo_duration + early AS promo_duration)
FROM (SELECT *, promo_start AS listed_start, CAST(($early$) AND start_weekday IN (2, 3, 4) AS INTEGER) AS early FROM v_all_base)"""
register(
    "early_start_shift",
    lambda spark, root: P.early_start_shift(upload(spark, root).all_base, CFG.early_start_stores),
    "SELECT * FROM v_early",
    _base,
)

VIEWS["v_scope"] = """
SELECT country, split_part(node_id, '-', 1) AS division, min(iso_date) AS scope_from, max(iso_date) AS scope_to FROM v_targets GROUP BY ALL"""
VIEWS["v_scoped"] = "SELECT * FROM v_early LEFT JOIN v_scope USING (country, division)"


def _scoped(spark: SparkSession, root: str) -> DataFrame:
    u = upload(spark, root)
    return P.scope_min_max(P.early_start_shift(u.all_base, CFG.early_start_stores), u.targets)


register("scope_min_max", _scoped, "SELECT * FROM v_scoped", _base + " scope_from:s scope_to:s")


def _added(spark: SparkSession, root: str) -> DataFrame:
    u = upload(spark, root, ADDED)
    return P.early_start_shift(P.added_filter(u.all_base, u.added, ADDED), ADDED.early_start_stores)


register("added_filter", _added, "SELECT * FROM v_early WHERE $added$", _base, ADDED)

VIEWS["v_in_scope"] = "SELECT * FROM v_scoped WHERE promo_end >= scope_from AND promo_start <= scope_to AND $added$"
register(
    "event_scope_filter",
    lambda spark, root: upload(spark, root).in_scope,
    "SELECT * FROM v_in_scope",
    _base + " scope_from:s scope_to:s",
)

# Where a system plan may be filed, best first: for the product or for any, under how many characters of the code, how long valid.
_places = [(1, 1, 6, "next_calc_week = '209952'"), (2, 1, 5, "validity_days = 56")]
_places += [(8 - n, 0, n, "next_calc_week = '209952'") for n in range(5, 0, -1)]


def offers(keys: str, plans: str, places: list[tuple[int, int, int, str]], week: str = "") -> str:
    """Plans that a key may use, with the rank of their place."""
    return " UNION ALL ".join(
        f"SELECT {rank} AS rank, k.*, {', '.join(f'p.day_{n}' for n in DAYS)} FROM ({keys}) k JOIN ({plans}) p ON p.country = k.country "
        f"AND p.store = k.store AND p.plan_sku = {'k.sku' if own else '0'} AND {valid}{week}"
        + (f" AND p.plan_code = substr(k.code, 1, {chars})" if chars else "")
        for rank, own, chars, valid in places
    )


def best_days(key: str, source: str) -> str:
    firsts = ", ".join(f"first(day_{n} ORDER BY rank) FILTER (day_{n} IS NOT NULL) AS day_{n}" for n in DAYS)
    return f"SELECT {key}, {firsts} FROM ({source}) GROUP BY {key}"


_system = offers(
    "SELECT DISTINCT country, store, sku, code FROM v_in_scope",
    "SELECT * FROM v_plan_today WHERE updated_by = 'SYSTEM' AND kind = 'PTP'",
    _places,
)
VIEWS["v_system_days"] = best_days("country, store, sku, code", _system)
VIEWS["v_with_plan"] = f"""
SELECT b.*, {", ".join(f"s.day_{n} AS plan_day_{n}" for n in DAYS)}
FROM v_in_scope b LEFT JOIN v_system_days s ON s.country = b.country AND s.store = b.store AND s.sku = b.sku AND s.code = b.code"""


def _prefix(spark: SparkSession, root: str) -> DataFrame:
    u = upload(spark, root)
    return P.prefix_fallback_lookup(u.in_scope, u.plan)


register(
    "prefix_fallback_lookup",
    _prefix,
    "SELECT * FROM v_with_plan",
    PROMO + f" store_number:i {select_columns('plan_day_', 'f')}",
)

_weeks = """SELECT DISTINCT country, store, sku, code, week FROM (SELECT *, unnest([start_week, end_week]) AS week FROM v_in_scope)"""
_user = "SELECT * FROM v_plan_today WHERE updated_by = 'USER' AND kind = 'PTG'"
_of_week = " AND p.plan_week = k.week"
_key = "country, store, sku, code, week"
VIEWS["v_product_days"] = best_days(_key, offers(_weeks, _user, [(1, 1, 0, "TRUE")], _of_week))
VIEWS["v_code_days"] = best_days(_key, offers(_weeks, _user, [(1, 0, 5, "TRUE"), (2, 0, 4, "TRUE")], _of_week))
VIEWS["v_marks"] = f"""
SELECT country, store, sku, year_week, {", ".join(f"max(promo_{n}) AS promo_{n}" for n in DAYS)} FROM v_flags_today GROUP BY ALL"""
_shows = ", ".join(
    f"CASE WHEN {{flagged}} THEN ps.day_{n} END AS start_day_{n}, pe.day_{n} AS end_day_{n}, cs.day_{n} AS regular_start_day_{n}, "
    f"ce.day_{n} AS regular_end_day_{n}".replace("{flagged}", f"$flagged_{n}$")
    for n in DAYS
)
_same = "{0}.country = b.country AND {0}.store = b.store AND {0}.sku = b.sku"
VIEWS["v_plans"] = f"SELECT b.*, {_shows} FROM v_with_plan b " + " ".join(
    f"LEFT JOIN {view} {a} ON {_same.format(a)} AND {a}.code = b.code AND {a}.week = b.{week}"
    for view, a, week in (
        ("v_product_days", "ps", "start_week"), ("v_product_days", "pe", "end_week"),
        ("v_code_days", "cs", "start_week"), ("v_code_days", "ce", "end_week"),
    )
) + f" LEFT JOIN v_marks m ON {_same.format('m')} AND m.year_week = b.start_week"


def _start_end(spark: SparkSession, root: str, cfg=CFG) -> DataFrame:
    u = upload(spark, root, cfg)
    return P.plan_lookup_start_end(u.in_scope, u.plan, u.flags if cfg.added_promotions else None, cfg)


_shown = " ".join(f"{s}_day_{n}:f" for s in ("start", "end", "regular_start", "regular_end") for n in (1, 4, 7))
for _prefix_name, _cfg in (("", CFG), ("added_", ADDED)):
    register(
        f"{_prefix_name}plan_lookup_start_end",
        lambda spark, root, cfg=_cfg: _start_end(spark, root, cfg),
        "SELECT * FROM v_plans",
        PROMO + f" store_number:i {_shown}",
        _cfg,
    )
