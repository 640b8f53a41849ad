"""Registered queries: a Spark build, an equivalent SQL text, and the result columns."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.config import DEFAULT_GATES, GateRule, RunConfig

Build = Callable[[SparkSession, str], DataFrame]

# Thresholds scaled to a warehouse whose nodes sell a few units a day.
SCALED_GATES = {
    "subgroup": GateRule(2, 5, 0.05, 0.2, 5.0, 0.2, 1, 1),
    "grp": GateRule(2, 5, None, 0.2, 6.0, 0.2, 1, 1),
    "section": GateRule(3, 8, enforced_min_sales=1, enforced_sales_per_row=1),
    "department": GateRule(3, 8),
    "division": DEFAULT_GATES["division"],
}
CFG = RunConfig(
    min_week_sales=10.0,
    min_products_per_store=10,
    gates=SCALED_GATES,
    excluded_departments=("Brand#11", "Brand#14"),
    base_promo_division="PROMO",
    early_start_stores=(("AFRICA", 1001), ("ASIA", 1008), ("ASIA", 1018), ("EUROPE", 1024)),
)
# The other kinds of run that queries are registered for.
EASTER = replace(CFG, event_id="EASTER", as_of=date(2000, 3, 1), base_weeks=("199905", "199906", "199907"))
SELECTED = replace(CFG, departments=(103, 107, 112, 118, 124, 5, 9, 21, 33), excluded_sections=(4, 17, 33))
ONE_WEEK = replace(CFG, promo_week="200049")
REUPLOAD = replace(ONE_WEEK, week_reupload=True)
ADDED = replace(CFG, added_promotions=True)
DECIMALS = 4
# Just off one half, so that exact ties are not decided by the last bit of a division.
HALF = 0.500001


@dataclass(frozen=True)
class Check:
    build: Build
    sql: str
    columns: dict[str, str]
    cfg: RunConfig = CFG

    def text(self, views: dict[str, str]) -> str:
        """The whole SQL of the run's configuration."""
        bound = {name: bind(view, self.cfg) for name, view in views.items()}
        return compose(bind(present_sql(self.sql, self.columns), self.cfg), bound)

    def query(self, spark: SparkSession, root: str) -> DataFrame:
        return present(self.build(spark, root), self.columns)


def present(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select the result columns in plain types: text, whole numbers, four decimals."""
    scale = 10**DECIMALS

    def shown(name: str, kind: str):
        c = F.col(name)
        if kind == "f":
            c = F.floor(c.cast("double") * scale + HALF).cast("double") / scale
        elif kind == "i":
            c = c.cast("bigint")
        else:
            c = c.cast("string")
        return c.alias(name)

    return df.select(*[shown(n, k) for n, k in columns.items()])


def present_sql(body: str, columns: dict[str, str]) -> str:
    scale = 10**DECIMALS

    def shown(name: str, kind: str) -> str:
        if kind == "f":
            return f"floor(CAST({name} AS DOUBLE) * {scale} + {HALF}) / {scale} AS {name}"
        return f"CAST({name} AS {'BIGINT' if kind == 'i' else 'VARCHAR'}) AS {name}"

    return f"SELECT {', '.join(shown(n, k) for n, k in columns.items())} FROM ({body}) result"


def compose(body: str, views: dict[str, str]) -> str:
    """Prefix a SELECT with the views it uses, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\bv_\w+", text)):
            if name in views and name not in needed:
                needed.add(name)
                visit(views[name])

    visit(body)
    ctes = [f"{name} AS MATERIALIZED ({views[name]})" for name in views if name in needed]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body


# Western Easter Sundays, as published.
EASTERS = (
    "1994-04-03", "1995-04-16", "1996-04-07", "1997-03-30", "1998-04-12", "1999-04-04", "2000-04-23", "2001-04-15",
    "2002-03-31", "2003-04-20", "2004-04-11",
)


def bind(text: str, cfg: RunConfig) -> str:
    """Fill in a run's parameters, written ``$name$``."""
    easter = " ".join(f"WHEN {d[:4]} THEN DATE '{d}'" for d in EASTERS)
    day = f"CASE year {easter} END" if cfg.event_id == "EASTER" else "make_date(CAST(year AS INTEGER), 12, 24)"
    listed = [f"{'dep' if d > 99 else 'p_size'} = {d}" for d in cfg.departments or ()]
    sections = ", ".join(map(str, cfg.excluded_sections)) or "-1"
    week = f"'{cfg.promo_week}'"
    chosen = f"{week} BETWEEN start_week AND end_week" if cfg.week_reupload else f"start_week = {week}"
    early = " OR ".join(f"(country = '{c}' AND store_number = {s})" for c, s in cfg.early_start_stores)
    values = {
        "event_id": f"'{cfg.event_id}'",
        "event_day": day,
        "as_of": f"DATE '{cfg.as_of}'",
        "ly": str(cfg.ly_year),
        "fy": str(cfg.fy_year),
        "years": ", ".join(f"({y})" for y in cfg.event_years),
        "norm_years": ", ".join(map(str, cfg.norm_years)),
        "base_monday": f"DATE '{cfg.base_monday}'",
        "base_weeks": ", ".join(f"'{w}'" for w in cfg.base_weeks),
        "n_weeks": str(len(cfg.base_weeks)),
        "products": f"({' OR '.join(listed)}) AND p_size NOT IN ({sections})" if listed else "TRUE",
        "chosen_week": chosen if cfg.promo_week else "TRUE",
        "chosen_days": f"year_week = {week}" if cfg.week_reupload else "TRUE",
        "latest_only": "recency = 1" if cfg.week_reupload else "TRUE",
        "added": "(country, sku, listed_start, promo_end, store_number) IN "
        "(SELECT (country, sku, promo_start, promo_end, store_number) FROM v_added)" if cfg.added_promotions else "TRUE",
        "added_interval": "(country, sku, listed_start, promo_end) IN (SELECT (country, sku, promo_start, promo_end) FROM v_added)"
        if cfg.added_promotions
        else "TRUE",
        **{f"flagged_{n}": f"m.promo_{n} = 1" if cfg.added_promotions else "TRUE" for n in range(1, 8)},
        "early": early,
        "departments": f"'{','.join(map(str, cfg.departments or ()))}'",
        "sections": f"'{','.join(map(str, cfg.excluded_sections))}'",
        "week": f"'{cfg.promo_week or ''}'",
        "is_reupload": "'YES'" if cfg.week_reupload else "'NO'",
        "is_added": "'YES'" if cfg.added_promotions else "'NO'",
    }
    for name, value in values.items():
        text = text.replace(f"${name}$", value)
    return text


CHECKS: dict[str, Check] = {}


def register(name: str, build: Build, sql: str, columns: str, cfg: RunConfig = CFG) -> None:
    """``columns``: ``name:kind`` words, kind s(tring), i(nteger) or f(raction)."""
    CHECKS[name] = Check(build, sql, dict(word.split(":") for word in columns.split()), cfg)
