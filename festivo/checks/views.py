"""The derived input tables as SQL, written for the second engine."""

from __future__ import annotations

NODE = "country, division, department, section, grp, subgroup"
DAYS = range(1, 8)

VIEWS: dict[str, str] = {}

VIEWS["v_products"] = """
SELECT p_partkey + 1 AS sku, p_type AS division, p_brand AS department, split_part(p_name, ' ', 1) AS section,
  split_part(p_name, ' ', 2) AS grp, CAST(p_size AS VARCHAR) AS subgroup,
  p_name || IF(p_size % 10 = 0, ' I/O', '') AS description,
  substr(p_type, 1, 2) || lpad(substr(p_brand, 7), 2, '0') || lpad(CAST(p_size AS VARCHAR), 2, '0') AS code
FROM part"""

VIEWS["v_nodes"] = """
SELECT *, division AS node_division, division || '-' || department AS node_department,
  division || '-' || department || '-' || section AS node_section,
  division || '-' || department || '-' || section || '-' || grp AS node_grp,
  division || '-' || department || '-' || section || '-' || grp || '-' || subgroup AS node_subgroup
FROM v_products"""

VIEWS["v_supply"] = """
SELECT s_suppkey, n_nationkey AS store, r_name AS country, r_regionkey AS country_number, s_acctbal
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

VIEWS["v_stores"] = """
SELECT country, store, store + 1001 AS store_number,
  CASE WHEN k % 17 = 0 THEN 'ZBK' WHEN n >= 4 THEN 'HM' ELSE 'SM' END AS format,
  $as_of$ - CAST(k * 37 % 400 AS INTEGER) AS open_date,
  CASE WHEN k % 9 = 0 THEN $as_of$ + CAST(k % 120 AS INTEGER) END AS close_date, CASE WHEN k % 23 <> 0 THEN area END AS net_area
FROM (SELECT country, store, sum(s_acctbal) AS area, count(*) AS n, sum(s_suppkey) AS k FROM v_supply GROUP BY ALL)"""

VIEWS["v_selling_stores"] = """
SELECT * FROM v_stores WHERE store_number BETWEEN 1001 AND 5999 AND format <> 'ZBK' AND open_date <= $as_of$ - 10
  AND coalesce(close_date, DATE '9999-12-31') >= $as_of$ + 60 AND net_area IS NOT NULL"""

VIEWS["v_countries"] = "SELECT r_name AS country FROM region"

VIEWS["v_lines"] = """
SELECT l.*, store, country, CAST(l_shipdate AS DATE) AS sale_date
FROM lineitem l JOIN v_supply ON l_suppkey = s_suppkey"""

VIEWS["v_daily"] = """
SELECT country, store, l_partkey + 1 AS sku, sale_date,
  sum(CASE WHEN l_discount >= 0.05 THEN l_quantity ELSE 0 END) AS qty_promo,
  sum(CASE WHEN l_discount < 0.05 THEN l_quantity ELSE 0 END) AS qty_regular
FROM v_lines GROUP BY ALL"""

VIEWS["v_promos"] = """
SELECT l_orderkey AS promo_code, l_partkey + 1 AS sku, country, CAST(o_orderdate AS DATE) AS promo_start,
  CAST(o_orderdate AS DATE) + CAST(CASE WHEN l_orderkey % 50 = 0 THEN l_orderkey % 90 ELSE l_orderkey % 28 END AS INTEGER) AS promo_end,
  max(l_extendedprice) AS price_normal,
  max(l_extendedprice) * (1 - min(l_discount)) AS price_promo,
  max(l_extendedprice) * (1 - min(l_tax)) AS price_club,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00,'
  || CAST(CAST(o_orderdate AS DATE) + CAST((l_partkey + 1) % 15 AS INTEGER) AS VARCHAR) || ' 00:00:00,'
  || CAST(CAST(o_orderdate AS DATE) + CAST(l_orderkey % 71 AS INTEGER) AS VARCHAR) || ' 00:00:00' AS leaflet_dates
FROM v_lines JOIN orders ON o_orderkey = l_orderkey
GROUP BY l_orderkey, l_partkey, country, o_orderdate"""

VIEWS["v_depth"] = """
SELECT *, CASE WHEN saving_promo > saving_club THEN saving_promo ELSE saving_club END AS saving,
  CASE WHEN (CASE WHEN saving_promo > saving_club THEN saving_promo ELSE saving_club END) < 0.001 THEN 1 ELSE 0 END
    AS zero_saving
FROM (SELECT *, coalesce(1 - round(price_promo / nullif(price_normal, 0), 2), 0) AS saving_promo,
        coalesce(1 - round(price_club / nullif(price_normal, 0), 2), 0) AS saving_club FROM v_promos)"""

VIEWS["v_coef_department"] = """
SELECT DISTINCT country, department, 0.625 + 0.125 * ((CAST(substr(department, 7) AS INTEGER) + length(country)) % 3) AS coef
FROM v_products, v_countries"""

VIEWS["v_coef_section"] = """
SELECT country, department, section, 0.5 + 0.125 * ((count(*) + length(country)) % 4) AS coef FROM v_products, v_countries
GROUP BY country, department, section HAVING min(CAST(subgroup AS INTEGER)) <= 5"""

VIEWS["v_coef_division"] = """
SELECT DISTINCT country, division, 0.25 + 0.125 * ((length(division) + length(country)) % 3) AS coef FROM v_products, v_countries"""

VIEWS["v_cal"] = """
SELECT CAST(d AS DATE) AS iso_date, isoyear(d) AS fiscal_year, lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0') AS fiscal_week,
  isodow(d) AS weekday, CAST(isoyear(d) AS VARCHAR) || lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0') AS year_week
FROM (SELECT unnest(range(make_date(low - 1, 1, 1), make_date(high + 3, 1, 1), INTERVAL 1 DAY)) AS d
  FROM (SELECT least(min(year(d)), min(y)) AS low, greatest(max(year(d)), max(y)) AS high
    FROM (SELECT min(l_shipdate) AS d FROM lineitem UNION ALL SELECT max(l_shipdate) FROM lineitem
      UNION ALL SELECT min(o_orderdate) FROM orders UNION ALL SELECT max(o_orderdate) FROM orders), (VALUES $years$) t(y)))"""

VIEWS["v_fcal"] = """
SELECT iso_date, CASE WHEN fiscal_week = '53' THEN fiscal_year + 1 ELSE fiscal_year END AS fiscal_year,
  CASE WHEN fiscal_week = '53' THEN '01' ELSE fiscal_week END AS fiscal_week, weekday,
  CASE WHEN fiscal_week = '53' THEN CAST(fiscal_year + 1 AS VARCHAR) || '01' ELSE year_week END AS year_week
FROM v_cal"""

VIEWS["v_holidays"] = """
SELECT country, iso_date AS holiday_date FROM v_cal, v_countries
WHERE strftime(iso_date, '%m-%d') IN ('12-25', '12-26', '01-01') OR (country, strftime(iso_date, '%m-%d')) IN (('AFRICA', '12-16'),
  ('AMERICA', '11-25'), ('AMERICA', '04-02'), ('ASIA', '04-05'), ('EUROPE', '12-08'), ('EUROPE', '04-24'))"""

VIEWS["v_event_dates"] = """
SELECT country, param, year, $event_day$ + CASE country WHEN 'AMERICA' THEN 1 WHEN 'ASIA' THEN -1 ELSE 0 END
  - CASE WHEN param = 'PROMO' THEN 1 ELSE 0 END AS event_date
FROM v_countries, (SELECT DISTINCT p_type AS param FROM part), (VALUES $years$) y(year)"""

VIEWS["v_controls"] = """
SELECT e.*, -6 AS offset_from, 0 AS offset_to, 1 AS offset2_from, 4 AS offset2_to, c.year_week,
  event_date - CAST(c.weekday + 27 AS INTEGER) AS date_from, event_date - CAST(c.weekday - 14 AS INTEGER) AS date_to
FROM v_event_dates e JOIN v_cal c ON c.iso_date = event_date"""

VIEWS["v_last_year"] = """
SELECT country, param, iso_date, datediff('day', event_date, iso_date) AS event_offset, iso_date >= date_from AS in_event
FROM v_controls JOIN v_cal ON iso_date BETWEEN least(date_from, $base_monday$) AND date_to WHERE year = $ly$"""

VIEWS["v_range"] = """
SELECT country, store, sku, min(sale_date) AS valid_from,
  CASE WHEN max(sale_date) < make_date($fy$, 1, 1) THEN max(sale_date) END AS valid_to
FROM v_daily GROUP BY country, store, sku"""

VIEWS["v_hours"] = f"""
SELECT country, store_number, monday + 2 AS created_date,
  {", ".join(f"sum(CASE WHEN wd = {n} THEN 4 * orders ELSE 0 END) AS hours_{n}" for n in DAYS)},
  CASE WHEN weekofyear(monday) % 4 = 0 THEN 'STANDARD CLOSE' WHEN weekofyear(monday) % 4 = 1 THEN 'THIS WEEK CLOSE'
    WHEN weekofyear(monday) % 4 = 2 THEN 'WEEK + 1 CLOSE' ELSE 'WEEK + 3 CLOSE' END AS label
FROM (SELECT country, store + 1001 AS store_number, sale_date - CAST(isodow(sale_date) - 1 AS INTEGER) AS monday,
        isodow(sale_date) AS wd, count(DISTINCT l_orderkey) AS orders
      FROM v_lines GROUP BY ALL)
GROUP BY country, store_number, monday"""

VIEWS["v_enforced"] = """
SELECT country, division || '-' || department || '-' || section AS node_id, 3 AS level, 1 AS enforce, 0 AS excl
FROM v_products, v_countries WHERE length(country) % 2 = 0 GROUP BY country, division, department, section HAVING count(*) >= 3
UNION ALL
SELECT DISTINCT country, division || '-' || department || '-' || section || '-' || grp || '-' || subgroup, 5, 0, 1
FROM v_products, v_countries WHERE subgroup = CASE WHEN length(country) % 2 = 0 THEN '50' ELSE '49' END"""

VIEWS["v_code_map"] = """
SELECT country, division, department, NULL AS section, NULL AS grp, NULL AS subgroup,
  CASE WHEN length(country) % 2 = 0 THEN min(substr(code, 1, 4)) ELSE max(substr(code, 1, 4)) END AS sg_cd
FROM v_products, v_countries GROUP BY country, division, department
UNION ALL
SELECT country, division, department, section, grp, subgroup, CASE WHEN length(country) % 2 = 0 THEN min(code) ELSE max(code) END
FROM v_products, v_countries GROUP BY country, division, department, section, grp, subgroup"""


def shares(keys: str, source: str, having: str = "TRUE") -> str:
    days = ", ".join(
        f"sum(CASE WHEN wd = {n} THEN qty END) * 100.0 / nullif(sum(qty), 0) AS day_{n}" for n in DAYS
    )
    return f"SELECT {keys}, {days} FROM ({source}) GROUP BY {keys} HAVING {having}"


VIEWS["v_coded"] = """
SELECT d.*, code, department, section, division, qty_promo + qty_regular AS qty, isodow(sale_date) AS wd, c.year_week
FROM v_daily d JOIN v_products USING (sku) JOIN v_fcal c ON c.iso_date = sale_date"""

_PLAN = "country, store, plan_sku, plan_code, plan_week, next_calc_week, updated_by, kind, " + ", ".join(
    f"day_{n}" for n in DAYS
)


def _plan(rows: str, sku: str, code: str, week: str, following: str, by: str, kind: str) -> str:
    days = ", ".join(f"day_{n}" for n in DAYS)
    return (
        f"SELECT country, store, {sku} AS plan_sku, {code} AS plan_code, {week} AS plan_week, "
        f"{following} AS next_calc_week, '{by}' AS updated_by, '{kind}' AS kind, {days} FROM ({rows})"
    )


_parts = [
    _plan(shares("country, store, sku, code", "SELECT * FROM v_coded", "count(*) <> 2"),
          "sku", "code", "'200040'", "'209952'", "SYSTEM", "PTP"),
    _plan(shares("country, store, sku, code", "SELECT * FROM v_coded", "count(*) = 2"),
          "sku", "substr(code, 1, 5)", "'200040'", "'200048'", "SYSTEM", "PTP"),
    *[
        _plan(shares("country, store, p", f"SELECT *, substr(code, 1, {n}) AS p FROM v_coded"),
              "0", "p", "'200040'", "'209952'", "SYSTEM", "PTP")
        for n in range(1, 6)
    ],
    _plan(shares("country, store, sku, code, year_week", "SELECT * FROM v_coded WHERE qty_promo > 0"),
          "sku", "code", "year_week", "'209952'", "USER", "PTG"),
    *[
        _plan(shares("country, store, p, year_week",
                     f"SELECT *, substr(code, 1, {n}) AS p FROM v_coded WHERE qty_promo > 0"),
              "0", "p", "year_week", "'209952'", "USER", "PTG")
        for n in (5, 4)
    ],
]
VIEWS["v_plan"] = " UNION ALL ".join(_parts)

VIEWS["v_plan_valid"] = """
SELECT p.*, a.iso_date AS week_from, b.iso_date AS week_to, datediff('day', a.iso_date, b.iso_date) AS validity_days
FROM v_plan p LEFT JOIN v_fcal a ON a.year_week = plan_week AND a.weekday = 1
LEFT JOIN v_fcal b ON b.year_week = next_calc_week AND b.weekday = 1"""

VIEWS["v_flags"] = " UNION ALL ".join(
    f"""
SELECT country, store, store + 1001 AS store_number, sku, year_week,
  {", ".join(f"max(CASE WHEN wd = {n} THEN step END) AS step_{n}" for n in DAYS)},
  {", ".join(f"CASE WHEN coalesce(max(CASE WHEN wd = {n} THEN step END), '') IN ('P', 'B') THEN 1 ELSE 0 END AS promo_{n}" for n in DAYS)}
FROM (SELECT country, store, l_partkey + 1 AS sku, c.year_week, c.weekday AS wd,
        CASE WHEN l_discount >= 0.05 THEN CASE WHEN l_linestatus = 'O' THEN 'P' ELSE 'B' END ELSE 'N' END AS step
      FROM v_lines JOIN orders ON o_orderkey = l_orderkey JOIN v_fcal c ON c.iso_date = CAST(o_orderdate AS DATE)
      WHERE l_returnflag = '{flag}')
GROUP BY country, store, sku, year_week"""
    for flag in ("A", "N", "R")
)

VIEWS["v_sites"] = """
SELECT country, country_number, store + 1001 AS store_number, 'Z' || CAST(count(*) % 4 AS VARCHAR) AS reference_site
FROM v_supply GROUP BY country, country_number, store"""

VIEWS["v_zone_link"] = """
SELECT country, store_number, reference_site AS zone_code, zone_name
FROM v_sites s JOIN (SELECT DISTINCT country_number AS cn, reference_site AS zc, g AS zone_group,
    reference_site || '-' || CAST(g AS VARCHAR) AS zone_name FROM v_sites, (VALUES (1), (2)) t(g)) z
  ON cn = country_number AND zc = reference_site AND zone_group = CASE WHEN country_number = 4 THEN 1 ELSE 2 END
WHERE store_number BETWEEN 1001 AND 5999"""

VIEWS["v_weekday_values"] = " UNION ALL ".join(
    "SELECT * FROM (" + shares("country, store, department, section", src) + ")"
    for src in (
        "SELECT * FROM v_coded WHERE CAST(substr(department, 7) AS INTEGER) % 3 <> 0",
        "SELECT * REPLACE ('0' AS section) FROM v_coded WHERE CAST(substr(department, 7) AS INTEGER) % 2 = 0",
        "SELECT * REPLACE ('0' AS section, '0' AS department) FROM v_coded",
    )
)

VIEWS["v_week_coef"] = f"""
SELECT country, department, section,
  {", ".join(f"1.0 - 0.0625 * ((count(*) + length(country) + {k}) % 5) AS coef_w{k}" for k in range(1, 11))}
FROM v_products, v_countries GROUP BY country, department, section"""

VIEWS["v_default_clusters"] = """
SELECT country, store, CASE WHEN format = 'HM' THEN 'Large-Moderate' ELSE 'Small-Moderate' END AS store_cluster
FROM v_stores"""

_levels = ["division", "department", "section", "grp", "subgroup"]
VIEWS["v_event_sales"] = """
SELECT d.country, sale_date, n.*, store_cluster, qty_promo + qty_regular AS sales
FROM v_daily d JOIN v_nodes n USING (sku) JOIN v_default_clusters USING (country, store)
JOIN (SELECT country, param, date_from, date_to FROM v_controls WHERE year = $fy$) k
  ON k.country = d.country AND k.param = n.division AND sale_date BETWEEN date_from AND date_to"""
VIEWS["v_targets"] = f"""
SELECT country, node_id, iso_date, store_cluster, CASE WHEN level = 3 THEN 'USER' ELSE 'SYSTEM' END AS target_type,
  sales / nullif(sum(sales) OVER (PARTITION BY country, node_id, store_cluster,
    iso_date - CAST(isodow(iso_date) - 1 AS INTEGER)), 0) * 100 AS final_target
FROM ({" UNION ALL ".join(
    f"SELECT {i} AS level, country, node_{lv} AS node_id, store_cluster, sale_date AS iso_date, sum(sales) AS sales "
    f"FROM v_event_sales GROUP BY ALL" for i, lv in enumerate(_levels, start=1))})"""
