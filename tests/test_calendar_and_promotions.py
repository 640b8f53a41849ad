from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from festivo.config import EARLY_START_STORES, RunConfig
from festivo.operators import allocation as A, calendar as C, promotions as P

CFG = RunConfig()


def days(spark, first: date, last: date):
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("iso_date"))


def test_week_53_folds_into_next_year(spark):
    cal = C.fiscal_calendar(days(spark, date(1998, 12, 28), date(1999, 1, 4)))
    rows = {r.iso_date: (r.fiscal_year, r.fiscal_week, r.weekday) for r in cal.collect()}
    assert rows[date(1998, 12, 28)] == (1999, "01", 1)
    assert rows[date(1999, 1, 4)] == (1999, "01", 1)
    raw = C.fiscal_calendar(days(spark, date(1998, 12, 28), date(1998, 12, 28)), fold_week_53=False).first()
    assert (raw.fiscal_year, raw.fiscal_week) == (1998, "53")


def controls(spark, event_days: list[date]):
    row = {"weeks_before": "2", "weeks_after": "1", "offset_from": "-5", "offset_to": "0"}
    row |= {"offset2_from": "1", "offset2_to": "2", **{c: "0.5" for c in C.COEFFICIENTS}}
    data = [{"country": "X", "param": "d", "year": str(d.year), "event_date": d.isoformat(), **row} for d in event_days]
    return spark.createDataFrame(data)


def test_digit_arithmetic_finds_no_week_across_a_year_end(spark):
    cal = C.fiscal_calendar(days(spark, date(1999, 1, 1), date(2001, 12, 31)), fold_week_53=False)
    raw = controls(spark, [date(2000, 1, 5), date(2000, 6, 1)])
    by_weeks = {r.event_date: r for r in C.event_controls(raw, cal).collect()}
    by_digits = {r.event_date: r for r in C.event_controls(raw, cal, digit_arithmetic=True).collect()}
    june, january = date(2000, 6, 1), date(2000, 1, 5)
    assert by_weeks[june].date_from == by_digits[june].date_from == date(2000, 5, 15)
    assert by_weeks[january].date_from == date(1999, 12, 20)
    assert by_digits[january].date_from is None and by_digits[january].year_week_from == "199999"
    assert str(by_weeks[june].c_uplift) == "0.500"


def test_year_offset(spark):
    cal = C.fiscal_calendar(days(spark, date(1997, 1, 1), date(2001, 12, 31)), fold_week_53=False)
    c = C.event_controls(controls(spark, [date(y, 12, 24) for y in (1998, 1999, 2000)]), cal)
    shift = {r.ly_year: r.days_shift for r in C.year_offset(c, "CHRISTMAS").collect()}
    assert shift == {1998: 1, 1999: 2}
    assert {r.days_shift for r in C.year_offset(c, "Easter").collect()} == {0}


def test_open_day_grid(spark):
    cal = C.fiscal_calendar(days(spark, date(2000, 11, 1), date(2001, 6, 30)))
    hours = "country string, store_number int, label string, created_date date, snapshot_date date, " + ", ".join(
        f"hours_{n} int" for n in range(1, 8)
    )
    wed, thu = date(2000, 11, 29), date(2000, 11, 30)
    rows = [
        ("X", 1001, "THIS WEEK CLOSE", wed, wed, 0, 1, 2, 9, 9, 9, 9),
        ("X", 1002, "STANDARD CLOSE", wed, wed, 1, 1, 1, 1, 1, 1, 1),
        ("X", 1003, "STANDARD CLOSE", wed, wed, 1, 1, 1, 1, 1, 1, 0),
        ("X", 1004, "THIS WEEK CLOSE", thu, thu, 9, 9, 9, 9, 9, 9, 9),
        ("X", 1005, "UNKNOWN", wed, wed, 9, 9, 9, 9, 9, 9, 9),
        ("X", 1006, "WEEK + 4 CLOSE", wed, wed, 9, 9, 9, 9, 9, 9, 9),
    ]
    holidays = spark.createDataFrame([(date(2000, 12, 25),), (date(2000, 12, 24),)], "holiday_date date")
    grid = C.open_day_grid(spark.createDataFrame(rows, hours), cal, C.holiday_week_pivot(cal, holidays))
    by_store: dict[int, list] = {}
    for r in grid.collect():
        by_store.setdefault(r.store_number, []).append(r)
    first = by_store[1001][0]
    assert [first[f"day_{n}"] for n in range(1, 8)] == [0, 0, 1, 1, 1, 1, 1]
    assert len(by_store[1002]) == 14 and 1003 not in by_store and 1004 not in by_store and 1005 not in by_store
    holiday_week = by_store[1006][0]
    assert holiday_week.fiscal_week == "52" and holiday_week.day_1 == 0 and holiday_week.day_7 == 1


def test_promo_flags_keep_equal_rows_of_two_extracts(spark):
    schema = "country string, store_number int, sku int, " + ", ".join(f"step_{n} string" for n in range(1, 8))
    row = ("CZ", 1001, 1, "P", "B", "N", None, "P", "X", "B")
    a = spark.createDataFrame([row, row, ("CZ", 5000, 1, *["P"] * 7)], schema)
    flags = P.promo_day_flags([a, spark.createDataFrame([row], schema)]).collect()
    assert len(flags) == 2
    assert [flags[0][f"promo_{n}"] for n in range(1, 8)] == [1, 1, 0, 0, 1, 0, 1]


def test_leaflets(spark):
    start = date(2000, 3, 1)
    text = "2000-03-01 00:00,2000-03-07,bad,2000-03-08,2000-05-09,2000-05-10"
    rows = spark.createDataFrame([(1, start, text), (2, start, "")], "id int, promo_start date, leaflet_dates string")
    out = {r.id: r for r in P.leaflet_week_flags(P.leaflet_parse(rows)).collect()}
    assert out[1].leaflet_3 is None and out[1].leaflet_4 == date(2000, 3, 8) and out[1].leaflet_10 is None
    assert [n for n in range(1, 11) if out[1][f"leaflet_w{n}"]] == [1, 2, 10]
    assert not any(out[2][f"leaflet_w{n}"] for n in range(1, 11))
    many = spark.createDataFrame([(start, ",".join(["2000-03-02"] * 11 + ["2000-03-20"]))], "promo_start date, leaflet_dates string")
    flags = P.leaflet_week_flags(P.leaflet_parse(many)).first()
    assert [n for n in range(1, 11) if flags[f"leaflet_w{n}"]] == [1, 3]


def test_latest_snapshot_keeps_ties(spark):
    rows = spark.createDataFrame([(1, "a", 2), (1, "b", 2), (1, "c", 1)], "sku int, v string, part int")
    assert {r.v for r in P.latest_snapshot(rows, ["sku"], "part").collect()} == {"a", "b"}


def test_prefix_fallback(spark):
    plan_schema = (
        "country string, store int, plan_sku bigint, plan_code string, next_calc_week string, validity_days int, "
        "updated_by string, kind string, " + ", ".join(f"day_{n} double" for n in range(1, 8))
    )

    def plan(sku, code, following, validity, value, first=True):
        values = [value if first else None, *[value] * 6]
        return ("X", 1, sku, code, following, validity, "SYSTEM", "PTP", *values)

    plans = spark.createDataFrame(
        [
            plan(7, "AB1234", "209952", None, 6.0, first=False),
            plan(7, "AB123", "200048", 56, 5.5),
            plan(8, "AB123", "200048", 56, 5.5),
            plan(9, "AB123", "200047", 49, 9.9),
            plan(0, "AB1", "209952", None, 3.0),
            plan(0, "A", "209952", None, 1.0),
        ],
        plan_schema,
    )
    base = spark.createDataFrame(
        [("X", 1, 7, "AB1234"), ("X", 1, 8, "AB1234"), ("X", 1, 9, "AB1234"), ("X", 1, 5, "AC0000"), ("X", 1, 5, "Z")],
        "country string, store int, sku bigint, code string",
    )
    out = {(r.sku, r.code): r for r in P.prefix_fallback_lookup(base, plans).collect()}
    assert (out[7, "AB1234"].plan_day_1, out[7, "AB1234"].plan_day_2) == (5.5, 6.0)
    assert out[8, "AB1234"].plan_day_1 == 5.5
    assert out[9, "AB1234"].plan_day_1 == 3.0
    assert out[5, "AC0000"].plan_day_1 == 1.0
    assert out[5, "Z"].plan_day_1 is None


def test_early_start(spark):
    rows = spark.createDataFrame(
        [("CZ", 1029, date(2000, 3, 1), 3, 7), ("CZ", 1029, date(2000, 3, 3), 5, 7), ("SK", 1029, date(2000, 3, 1), 3, 7)],
        "country string, store_number int, promo_start date, start_weekday int, promo_duration int",
    )
    out = [tuple(r)[2:] for r in P.early_start_shift(rows, EARLY_START_STORES).collect()]
    assert out == [(date(2000, 2, 29), 2, 8), (date(2000, 3, 3), 5, 7), (date(2000, 3, 1), 3, 7)]


def redistribution_rows(spark, opened: list[int | None], values: list[float], code: int = 1):
    rows = [
        ("X", code, 1, date(2000, 3, 1), date(2000, 3, 31), 1, date(2000, 3, i + 1), o, v)
        for i, (o, v) in enumerate(zip(opened, values, strict=True))
    ]
    schema = (
        "country string, promo_code int, sku int, promo_start date, promo_end date, store int, promo_date date, "
        "store_open int, target_all double"
    )
    out = A.closed_day_redistribution(spark.createDataFrame(rows, schema)).orderBy("promo_date").collect()
    return [r.target_final for r in out]


def test_redistribution(spark):
    assert redistribution_rows(spark, [1, 1, 1], [1.0, 2.0, 3.0]) == [1.0, 2.0, 3.0]
    assert redistribution_rows(spark, [0, 0], [1.0, 2.0]) == [0.0, 0.0]
    mid = redistribution_rows(spark, [1] * 5 + [0, 1, 1], [10.0] * 8)
    assert mid[:2] == [10.0, 10.0] and mid[5] == 0.0 and mid[7] == 10.0
    assert [round(x, 6) for x in (mid[2], mid[3], mid[4], mid[6])] == [12.5] * 4
    assert abs(sum(mid) - 80.0) < 1e-9
    first = redistribution_rows(spark, [0, 1, 1], [6.0, 4.0, 2.0])
    assert [round(x, 6) for x in first] == [0.0, 10.0, 2.0]
    assert redistribution_rows(spark, [None, 1], [3.0, 4.0]) == [0.0, 4.0]


def test_target_fallback_prefers_level_then_user(spark):
    day = date(2000, 12, 20)
    targets = spark.createDataFrame(
        [
            ("X", "a-b-c-d-e", day, "L", "SYSTEM", 1.0),
            ("X", "a-b-c-d", day, "L", "USER", 2.0),
            ("X", "a", day, "L", "SYSTEM", 3.0),
            ("X", "a", day, "L", "USER", 4.0),
        ],
        "country string, node_id string, iso_date date, store_cluster string, target_type string, final_target double",
    )
    levels = ["node_division", "node_department", "node_section", "node_grp", "node_subgroup"]

    def ids(path: str):
        parts = path.split("-")
        return tuple("-".join(parts[: i + 1]) for i in range(5))

    base = spark.createDataFrame(
        [("X", "L", day, day, *ids("a-b-c-d-e")), ("X", "L", day, day, *ids("a-b-c-d-f")), ("X", "L", day, day, *ids("a-x-c-d-e"))],
        "country string, store_cluster string, promo_start date, promo_end date, " + ", ".join(f"{x} string" for x in levels),
    )
    rows = base.withColumn("promo_date", F.col("promo_start"))
    out = {r.node_subgroup: r.target for r in A.target_fallback_lookup(rows, base, targets).collect()}
    assert out == {"a-b-c-d-e": 1.0, "a-b-c-d-f": 2.0, "a-x-c-d-e": 4.0}


def test_promo_day_rank_and_reupload(spark):
    cal = C.fiscal_calendar(days(spark, date(2000, 1, 1), date(2000, 12, 31)))
    base = spark.createDataFrame(
        [(1, date(2000, 1, 3), date(2000, 3, 20)), (2, date(2000, 2, 2), date(2000, 2, 1))],
        "promo_code int, promo_start date, promo_end date",
    )
    rows = A.promo_day_rank(A.promo_day_explode(base, cal, CFG)).filter("promo_code = 1").collect()
    weeks = {r.promo_day: r.promo_week for r in rows}
    assert len(rows) == 78 and (weeks[1], weeks[7], weeks[8], weeks[70], weeks[71]) == (1, 1, 2, 10, 0)
    cfg = replace(CFG, week_reupload=True, promo_week="200002")
    assert A.promo_day_explode(base, cal, cfg).count() == 7
