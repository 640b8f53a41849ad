"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import compare, second_engine

import __spark_entry__ as entry
from festivo.checks import all_checks

ROOT = "/root/testdata/sf0.001"
QUICK = (
    "fiscal_calendar", "holiday_week_pivot", "easter_shift_calendar", "open_day_grid", "promo_adjusted_sales", "store_shape_cluster",
    "hierarchy_rollup", "leaflet_week_flags", "eligible_stores", "latest_snapshot", "added_filter", "event_scope_filter",
    "prefix_fallback_lookup", "weekday_pivot", "closed_day_redistribution", "scope_audit",
)
NAMES = sorted(all_checks()) if os.environ.get("ALL_QUERIES") else QUICK

pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return second_engine(ROOT)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    ok, detail = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], ROOT)
    assert ok, detail


def test_every_query_of_an_operator_has_sql():
    assert set(all_checks()) <= set(entry.queries())
    assert set(all_checks()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns
