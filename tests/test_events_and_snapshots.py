"""Dated events, snapshot deliveries, interval joins, prefix inheritance, exact counts, the re-runnable sink and the audit."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from festivo.checks.registry import EASTERS
from festivo.config import RunConfig
from festivo.operators import allocation as A, calendar as C, clustering as K, events as E, intervals as I, matching as M, promotions as P, rollup as R
from festivo.sources.snapshots import SNAPSHOT, SnapshotTable
from festivo.sources.tables import write_partitions

CFG = RunConfig()


def calendar(spark, first: date, last: date, fold: bool = False):
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("iso_date"))
    return C.fiscal_calendar(days, fold_week_53=fold)


def controls(spark, rows: list[tuple]):
    """Control rows of (country, param, event_date); the event's year is its date's."""
    fixed = {"offset_from": -5, "offset_to": 0, "offset2_from": 1, "offset2_to": 2, **{c: 0.5 for c in C.COEFFICIENTS}}
    dates = spark.createDataFrame([(c, p, d.year, d) for c, p, d in rows], "country string, param string, year int, event_date date")
    raw = E.control_rows("X", dates, fixed, (4, 1))
    return C.event_controls(raw, calendar(spark, date(1997, 1, 1), date(2005, 12, 31)))


def test_easter_by_rule_is_easter_as_published():
    assert [E.easter_sunday(int(d[:4])).isoformat() for d in EASTERS] == list(EASTERS)
    assert E.easter_sunday(2038) == date(2038, 4, 25) and E.easter_sunday(1818) == date(1818, 3, 22)


def test_a_movable_event_maps_to_where_it_is_next_year(spark):
    c = controls(spark, [("A", "d", date(1999, 4, 4)), ("A", "d", date(2000, 4, 23)), ("B", "d", date(1999, 4, 11)), ("B", "d", date(2000, 4, 30))])
    cal = calendar(spark, date(1998, 1, 1), date(2001, 12, 31))
    days = {(r.country, r.iso_date): (r.fy_date, r.weekday_shift) for r in C.shift_calendar(cal, c).collect()}
    assert days["A", date(1999, 4, 4)] == (date(2000, 4, 23), 0)
    assert days["A", date(1999, 4, 2)] == (date(2000, 4, 21), 0)
    assert days["B", date(1999, 4, 11)] == (date(2000, 4, 30), 0)


def test_an_event_on_february_29(spark):
    c = controls(spark, [("A", "d", date(2000, 2, 29)), ("A", "d", date(2001, 2, 28))])
    days = {r.iso_date: r.fy_date for r in C.shift_calendar(calendar(spark, date(1999, 1, 1), date(2002, 12, 31)), c).collect()}
    assert days[date(2000, 2, 29)] == date(2001, 2, 28) and days[date(2000, 3, 1)] == date(2001, 3, 1)


def test_timeline_differs_by_country_and_division(spark):
    c = controls(spark, [("A", "d", date(1999, 12, 24)), ("A", "e", date(1999, 12, 23)), ("B", "d", date(1999, 12, 25))])
    rows = E.event_timeline(c, 1999, date(1999, 11, 15)).collect()
    at = {(r.country, r.division, r.iso_date): r for r in rows}
    day = date(1999, 12, 24)
    assert [at[k].event_offset for k in (("A", "d", day), ("A", "e", day), ("B", "d", day))] == [0, 1, -1]
    assert not at["A", "d", date(1999, 11, 15)].in_event and at["A", "d", date(1999, 11, 22)].in_event
    assert ("A", "d", date(1999, 11, 14)) not in at
    spans = E.event_spans(c.unionByName(controls(spark, [("A", "d", date(1998, 12, 24))])), 1999, (1998, 1999))
    assert spans[1998] == (date(1998, 11, 22), date(1999, 1, 2))


def test_gap_week_is_chosen_per_country(spark):
    schema = "country string, param string, node_id string, fiscal_year int, fiscal_week string, event_offset int, offset_from int, peak_year_week string"
    rows = [("A", "d", "n", 1999, w, o, -5, "199951") for w, o in (("48", -25), ("49", -18), ("50", -6))]
    rows += [("B", "d", "n", 1999, "48", -25, -5, "199951"), ("B", "d", "n", 1999, "49", -4, -5, "199951")]
    shifts = spark.createDataFrame([("A", "d", 2), ("B", "d", 2)], "country string, param string, days_shift int")
    out = {r.country: r.year_week for r in M.gap_source_week(spark.createDataFrame(rows, schema), shifts).collect()}
    assert out == {"A": "199950", "B": "199948"}


def test_snapshots_are_read_by_partition(spark, tmp_path):
    day = date(2000, 12, 1)
    rows = spark.createDataFrame([(k, day - timedelta(days=k % 10), "v") for k in range(100)], f"k int, {SNAPSHOT} date, v string")
    table = SnapshotTable(spark, str(tmp_path / "t")).deliver(rows)
    assert table.dates() == [day - timedelta(days=k) for k in range(9, -1, -1)]
    assert {r.k % 10 for r in table.on(day).collect()} == {0}
    assert {r.k % 10 for r in table.since(day - timedelta(days=6), day).collect()} == set(range(7))
    assert {r.k % 10 for r in table.newest(day - timedelta(days=3)).collect()} == {3}
    with pytest.raises(ValueError):
        table.newest(day - timedelta(days=30))

    def plan(df) -> str:
        return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")

    for one in (table.on(day), table.since(day - timedelta(days=6), day)):
        filters = [line for line in plan(one).splitlines() if "PartitionFilters" in line]
        assert filters and "2000-1" in filters[0]
    again = spark.createDataFrame([(7, day, "new")], f"k int, {SNAPSHOT} date, v string")
    assert [r.v for r in table.deliver(again).on(day).collect()] == ["new"]
    assert table.on(day - timedelta(days=1)).count() == 10


def test_snapshots_of_the_days_a_table_names(spark, tmp_path):
    day = date(2000, 12, 1)
    rows = spark.createDataFrame([(k, day - timedelta(days=k)) for k in range(20)], f"k int, {SNAPSHOT} date")
    table = SnapshotTable(spark, str(tmp_path / "t")).deliver(rows)
    weeks = calendar(spark, date(2000, 11, 1), date(2000, 12, 31)).filter("fiscal_week = '47'")
    named = table.on_days_of(weeks, "iso_date")
    assert sorted(r.k for r in named.collect()) == [5, 6, 7, 8, 9, 10, 11]


def test_overlap_join_finds_each_pair_once(spark):
    d = date(2000, 1, 1)
    left = [("a", i, d + timedelta(days=7 * i % 90), d + timedelta(days=7 * i % 90 + i % 60)) for i in range(80)]
    right = [("a", j, d + timedelta(days=11 * j % 120), d + timedelta(days=11 * j % 120 + 5 * j % 45)) for j in range(30)]
    left += [("b", 500, d, d), ("a", 501, None, d), ("a", 502, d, d - timedelta(days=1))]
    a = spark.createDataFrame(left, "k string, i int, s date, e date")
    b = spark.createDataFrame(right, "k string, j int, f date, t date")
    got = sorted((r.i, r.j) for r in I.overlap_join(a, b, ["k"], ("s", "e"), ("f", "t"), 10).collect())
    wanted = sorted((i, j) for k, i, s, e in left if s and s <= e for m, j, f, t in right if k == m and s <= t and f <= e)
    assert got == wanted and len(wanted) > 300


def test_reach_keeps_what_an_early_start_brings_in(spark):
    scope = spark.createDataFrame([("A", "d", date(2000, 12, 1), date(2000, 12, 31))], "country string, division string, scope_from date, scope_to date")
    ends = [(date(2000, 11, 1), date(2000, 11, 30)), (date(2000, 11, 1), date(2000, 12, 1)), (date(2001, 1, 1), date(2001, 1, 5)), (date(2001, 1, 2), date(2001, 1, 5))]
    rows = spark.createDataFrame([("A", "d", i, *e) for i, e in enumerate(ends)], "country string, division string, i int, promo_start date, promo_end date")
    assert sorted(r.i for r in P.within_reach(rows, scope).collect()) == [1, 2]


def test_a_day_beyond_the_calendar_stops_the_run(spark):
    cal = calendar(spark, date(2000, 1, 1), date(2000, 12, 31))
    schema = "promo_start date, promo_end date"
    fine = spark.createDataFrame([(date(2000, 5, 1), date(2000, 5, 9)), (None, date(2000, 5, 9))], schema)
    assert sorted(str(r.start_week) for r in P.promo_weeks(fine, cal).collect()) == ["200018", "None"]
    late = spark.createDataFrame([(date(2000, 12, 30), date(2030, 1, 2))], schema)
    with pytest.raises(PySparkException, match="2030-01-02"):
        P.promo_weeks(late, cal).collect()
    with pytest.raises(PySparkException, match="2030-01-02"):
        P.promo_weeks(late, cal, "inner").collect()
    with pytest.raises(PySparkException, match="no calendar row"):
        A.promo_day_explode(late.withColumn("promo_end", F.lit(date(2001, 1, 3))), cal, CFG).collect()


def test_codes_inherit_from_their_longest_prefix(spark):
    days = ", ".join(f"day_{n} double" for n in range(1, 8))
    plan = spark.createDataFrame(
        [("X", "AB123", 5.0, *[None] * 6), ("X", "AB1 ", 3.0, 3.0, *[None] * 5), ("X", "A", *[1.0] * 7), ("Y", "A", *[9.0] * 7)],
        f"country string, plan_code string, {days}",
    )
    codes = spark.createDataFrame([("X", "AB1234"), ("X", "AZ0000"), ("Y", "B")], "country string, code string")
    tree = P.prefix_tree(plan, F.lit(True), ["country"])
    out = {r.code: (r.day_1, r.day_2, r.day_3) for r in P.inherited(codes, tree, ["country"], (5, 4, 3, 2, 1)).collect()}
    assert out == {"AB1234": (5.0, 3.0, 1.0), "AZ0000": (1.0, 1.0, 1.0)}


def test_exact_percentiles_and_counts(spark):
    values = [("a", float(v % 7) if v % 5 else None) for v in range(200)] + [("b", None)]
    rows = spark.createDataFrame(values, "k string, v double")
    got = {r.k: (r.p, r.q) for r in K.exact_percentiles(rows, ["k"], "v", {"p": 0.25, "q": 0.65}).collect()}
    con = duckdb.connect()
    wanted = con.execute("SELECT quantile_cont(v, 0.25), quantile_cont(v, 0.65) FROM (SELECT unnest(?) AS v)", [[v for k, v in values if k == "a"]]).fetchone()
    assert got["a"] == pytest.approx(wanted) and got["b"] == (None, None)
    skus = spark.createDataFrame([("a", n * 997 % 100_000) for n in range(5000)] * 3 + [("b", 1)], "k string, sku long")
    assert {r.k: r.n_distinct for r in K.distinct_per_key(skus, ["k"], "sku").collect()} == {"a": 5000, "b": 1}


def baseline(spark):
    codes = ("division string, department string, section string, grp string, subgroup string")
    day = date(1999, 12, 20)
    rows = []
    for store in (1, 2):
        for grp, sub, sales in (("g", "u", 5.0), ("g", "x", 7.0), ("h", "u", 0.0)):
            rows.append(("A", "v", "p", "s", grp, sub, f"v-p-s-{grp}-{sub}", "L", 0, -4, 1999, "51", day, 1, 0, store, 2.0, sales, 0.0, sales))
    schema = (
        f"country string, {codes}, node_id string, store_cluster string, is_base int, event_offset int, fiscal_year int, fiscal_week string, "
        "iso_date date, weekday int, is_holiday int, store int, avg_products double, sales_promo double, sales_regular double, sales double"
    )
    listed = [("X", "A", "v-p-s-g-x", 5, 0, 1), ("X", "B", "v-p-s-g-u", 5, 0, 1), ("X", "A", "v-p-s", 3, 1, 0), ("Z", "A", "v-p-s-h", 4, 1, 0)]
    enforced = spark.createDataFrame(listed, "event_id string, country string, node_id string, level int, enforce_calculation int, exclusion_grp int")
    return spark.createDataFrame(rows, schema), enforced


def test_levels_add_up_from_below(spark):
    rows, enforced = baseline(spark)
    out = {r.node_id: r for r in R.hierarchy_rollup(rows, enforced, "x").collect()}
    assert out["v-p-s-g-x"].sales == 14.0 and out["v-p-s-g"].sales == 10.0 and out["v-p-s"].sales == out["v"].sales == 24.0
    assert out["v-p-s-h"].zero_count == 2 and out["v"].store_count == 2 and out["v"].zero_count == 0
    assert out["v"].avg_products == 6.0 and out["v-p-s-g"].avg_products == 2.0
    assert {n for n, r in out.items() if r.enforced} == {"v-p-s"}
    plan = R.store_levels(rows, enforced, "x")
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert "Generate explode" not in text


def test_partitions_of_other_runs_stay(spark, tmp_path):
    path = str(tmp_path / "targets")

    def run(event: str, country: str, value: float):
        rows = spark.createDataFrame([(event, country, "n", value)], "event_id string, country string, node_id string, final_target double")
        write_partitions(rows, path, ("event_id", "country"))

    run("CHRISTMAS", "A", 1.0)
    run("EASTER", "A", 2.0)
    run("CHRISTMAS", "B", 3.0)
    run("CHRISTMAS", "A", 4.0)
    out = {(r.event_id, r.country): r.final_target for r in spark.read.orc(path).collect()}
    assert out == {("CHRISTMAS", "A"): 4.0, ("EASTER", "A"): 2.0, ("CHRISTMAS", "B"): 3.0}


def test_audit_states_partition_the_promotions(spark):
    schema = "country string, division string, sku int, promo_start date, promo_end date"
    d = date(2000, 12, 1)
    rows = [("A", "v", 1, d, d), ("A", "v", 2, d - timedelta(days=9), d - timedelta(days=8)), ("A", "v", 3, d, d), ("B", "v", 4, d, d), ("C", "v", 5, d, d)]
    promotions = spark.createDataFrame(rows, schema)
    scope = spark.createDataFrame([("A", "v", d, d), ("B", "v", d, d)], "country string, division string, scope_from date, scope_to date")
    final = spark.createDataFrame([("A", 1, 1, d, d), ("B", 2, 4, d, d)], "country string, store int, sku int, promo_start date, promo_end date")
    stores = spark.createDataFrame([("A", 1, 1001), ("B", 2, 1002), ("C", 3, 1001)], "country string, store int, store_number int")
    cfg = replace(CFG, early_start_stores=(("B", 1002), ("A", 9999)))
    states = A.audit_states(promotions, scope, final, stores, cfg)
    got = {r.sku: r.state for r in states.collect()}
    assert got == {1: A.IN_SCOPE + A.GENERATED, 2: 0, 3: A.IN_SCOPE, 5: 0}
    messages = {r.sku: r.message for r in A.scope_audit(states, cfg).collect()}
    assert messages == {1: "promo target generated", 2: "excluded - not in event scope", 5: "excluded - not in event scope"}


def test_store_range_counts_stores_of_the_model_only(spark):
    day = date(2000, 12, 1)
    ranged = spark.createDataFrame([("A", s, k, day, None) for s in range(6) for k in range(3 + s)], "country string, store int, sku long, valid_from date, valid_to date")
    stores = spark.createDataFrame(
        [("A", 0, 1001, 1.0, day, None), ("A", 1, 999, 1.0, day, None), ("A", 2, 1003, None, day, None), ("A", 3, 1004, 1.0, day + timedelta(days=1), None),
         ("A", 4, 1005, 1.0, day, day + timedelta(days=5)), ("A", 5, 1006, 1.0, day, day + timedelta(days=60))],
        "country string, store int, store_number int, net_area double, open_date date, close_date date",
    )
    out = {r.store: (r.n_products, r.cluster_size) for r in K.store_range_size(ranged, stores, day, 2).collect()}
    assert out == {0: (3, "Small-"), 5: (8, "Large-")}


def test_promotions_of_other_seasons_go_before_their_product_is_looked_up(spark):
    """near_event keeps all that within_reach can keep, by country alone; nothing of another season or country passes."""
    day = lambda text: date.fromisoformat(text)
    scope = spark.createDataFrame(
        [("A", "D1", day("2000-12-10"), day("2000-12-20")), ("A", "D2", day("2000-12-22"), day("2000-12-28")), ("B", "D1", None, None)],
        "country string, division string, scope_from date, scope_to date",
    )
    spans = [("2000-11-01", "2000-12-09"), ("2000-11-01", "2000-12-10"), ("2000-12-21", "2000-12-21"), ("2000-12-29", "2001-01-05"), ("2000-12-30", "2001-01-05"), ("2000-12-28", None)]
    rows = [(i, c, day(a), b and day(b)) for c in ("A", "B", "C", None) for i, (a, b) in enumerate(spans)]
    promos = spark.createDataFrame(rows, "i int, country string, promo_start date, promo_end date")
    near = P.near_event(promos, scope)
    assert near.columns == promos.columns
    assert sorted((r.country, r.i) for r in near.collect()) == [("A", 1), ("A", 2), ("A", 3)]


def test_equal_promotions_may_stay_for_the_audit(spark):
    day = date(2000, 12, 1)
    promos = spark.createDataFrame([("A", 1, 2, day, day, "")] * 2, "country string, promo_code long, sku long, promo_start date, promo_end date, leaflet_dates string")
    products = spark.createDataFrame([(2, "D", "E", "F", "G", "H", "ring I/O")], "sku long, division string, department string, section string, grp string, subgroup string, description string")
    calendar = spark.createDataFrame([(day, 2000, "48", 5)], "iso_date date, fiscal_year int, fiscal_week string, weekday int")
    counts = [P.dated_promotions(promos, products, calendar, RunConfig(), distinct).count() for distinct in (True, False)]
    assert counts == [1, 2]
