from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import Window, functions as F

from festivo.config import DEFAULT_GATES, LEVELS, RunConfig
from festivo.functions.expressions import clamp, node_id, ratio
from festivo.operators import blending as B, clustering as K, rollup as R, sales as S, series as T
from festivo.sources.tables import stage, write_table

CFG = RunConfig()


def test_expressions(spark):
    row = spark.createDataFrame([(1.0, 0.0, None, "1", "-", "2")], "a double, z double, n double, p string, q string, r string")
    out = row.select(
        ratio(F.col("a"), F.col("z")).alias("none"),
        clamp(F.col("n"), -1, 1).alias("null"),
        clamp(F.col("a") * 5, -1, 1).alias("capped"),
        node_id([F.col("p"), F.col("r"), F.col("q")]).alias("node"),
    ).first()
    assert (out.none, out.null, out.capped, out.node) == (None, None, 1.0, "1-2")


def test_coverage_counts_every_promotion_of_a_day(spark):
    d = date(2000, 5, 1)
    sales = spark.createDataFrame([("X", 1, d + timedelta(days=i)) for i in (0, 2, 5, 9)], "country string, sku int, sale_date date")
    depth = spark.createDataFrame(
        [("X", 1, d, d + timedelta(days=5), 0), ("X", 1, d + timedelta(days=2), d + timedelta(days=2), 1), ("X", 2, d, d, 1)],
        "country string, sku int, promo_start date, promo_end date, zero_saving int",
    )
    out = [(r.n_cut, r.n_flat) for r in S.promo_coverage(sales, depth).orderBy("sale_date").collect()]
    assert out == [(1, 0), (1, 1), (1, 0), (0, 0)]


def test_discount_depth_takes_the_larger_cut(spark):
    rows = spark.createDataFrame([(100.0, 90.0, 80.0), (100.0, 100.0, 100.0), (0.0, 1.0, None)], "price_normal double, price_promo double, price_club double")
    out = [(round(r.saving, 2), r.zero_saving) for r in S.promo_discount_depth(rows).collect()]
    assert out == [(0.2, 0), (0.0, 1), (0.0, 1)]


@pytest.mark.parametrize("stores,expected", [(6, "Small-Moderate"), (7, "Small-Intense")])
def test_thin_clusters_merge(spark, stores, expected):
    rows = [
        ("X", s, "d", "Small-", o, 2.0, p50, 1.0, 9.0, None)
        for s in range(stores)
        for o, p50 in ((-1, 1.0), (-2, 1.0), (-3, 1.0))
    ]
    rows += [("X", 99, "d", "Small-", o, 9.0, 1.0, 1.0, 9.0, None) for o in (-1, -2, -3)]
    schema = (
        "country string, store int, division string, cluster_size string, event_offset int, uplift double, p50_day double, "
        "p65_day double, p80_day double, weak_weekend int"
    )
    out = {r.store: r.store_cluster for r in K.store_shape_cluster(spark.createDataFrame(rows, schema)).collect()}
    assert out[0] == expected and out[99] == "Small-Heavy"


def gate_row(spark, **changes):
    values = {
        "level": 5, "enforced": 0, "sales_ratio": 3.0, "sales_ratio_base": 3.0, "minimum_sales": 80.0, "total_sales": 2000.0,
        "n_rows": 10, "max_promo_ratio_weekly": 0.5, "event_base_ratio": 0.8,
    }
    values |= changes
    schema = ", ".join(f"{k} {'int' if k in ('level', 'enforced', 'n_rows') else 'double'}" for k in values)
    return R.node_quality_gate(spark.createDataFrame([tuple(values.values())], schema), DEFAULT_GATES).count()


def test_quality_gate(spark):
    assert gate_row(spark) == 1
    assert gate_row(spark, minimum_sales=70.0) == 0
    assert gate_row(spark, minimum_sales=11.0, enforced=1) == 1
    assert gate_row(spark, sales_ratio_base=0.0) == 0
    assert gate_row(spark, max_promo_ratio_weekly=0.75) == 0
    assert gate_row(spark, max_promo_ratio_weekly=0.75, level=4) == 1
    assert gate_row(spark, minimum_sales=60.0, total_sales=900.0, level=2) == 1
    assert gate_row(spark, minimum_sales=1.0, total_sales=1.0, level=1) == 1


def test_moving_average_and_forward_ratio(spark):
    rows = spark.createDataFrame([("n", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 0, 6])], "node string, day int, sales double")
    out = T.centered_moving_average(rows, ["node"], ["day"]).orderBy("day").collect()
    assert out[0].ma_6 == 2.0 and out[0].cma == 2.25
    assert out[4].cma_ratio is None and out[4].seasonal_factor is None
    assert all(-0.999 <= r.seasonal_factor <= 0.999 for r in out if r.seasonal_factor is not None)
    ahead = R.rolling_forward_ratio(rows, Window.partitionBy("node"), ["day"]).orderBy("day").collect()
    assert ahead[0].forward_ratio == 2.0 and ahead[5].forward_ratio == 1.0


def test_minmax_normalise(spark):
    codes = ("d", "p", "s", "g", "u")
    rows = [("X", *codes, "L", 1999, 1999, o, 1 if o >= 0 else 0, h, s) for o, h, s in ((-2, 0, 5.0), (-1, 0, 15.0), (0, 1, 99.0), (1, 0, 10.0))]
    rows += [("X", "flat", *codes[1:], "L", 1999, 1999, o, 0, 0, 7.0) for o in (-2, -1)]
    schema = (
        "country string, division string, department string, section string, grp string, subgroup string, store_cluster string, "
        "norm_year int, fiscal_year int, event_offset int, is_peak int, is_holiday int, sales double"
    )
    out = T.norm_union_cap(T.minmax_normalise(spark.createDataFrame(rows, schema))).filter("level = 1").collect()
    by = {(r.node_id, r.event_offset): r for r in out}
    assert by["d", 0].norm_sales == 0.0
    assert abs(by["d", -1].norm_sales - 10 / 94) < 1e-12
    assert by["d", 0].norm_factor == -0.999
    assert by["flat", -1].norm_sales is None and by["flat", -1].norm_factor is None


def test_explode_levels(spark):
    row = spark.createDataFrame([("a", "b", "c", "d", "e", 1)], ", ".join(f"{c} string" for c in LEVELS) + ", v int")
    out = {r.level: (r.node_id, r.subgroup) for r in R.explode_levels(row).collect()}
    assert out == {1: ("a", "-"), 2: ("a-b", "-"), 3: ("a-b-c", "-"), 4: ("a-b-c-d", "-"), 5: ("a-b-c-d-e", "e")}


def blended(spark, **changes):
    values = {
        "day_index": 2, "iso_date": date(2000, 12, 20), "is_holiday": False, "uplift": 1.5, "coef_uplift": 1.0, "offset_uplift": None,
        "coef_offset_uplift": None, "seasonal_factor": 0.1, "coef_seasonal": 1.0, "norm_factor": None, "coef_norm": 1.0,
        "base_share_ly": 0.2, "coef_share_base": 1.0, "base_share_fy": 0.3, "coef_share_offset": None, "department": "x",
        "section": "-", "node_id": "n", "offset_base_sales": None, "offset_base_date": None, "offset_sales_promo": None,
        "offset_sales_regular": None, "offset_sales": None, "offset_date": None,
    }
    values |= changes
    kinds = {"day_index": "int", "iso_date": "date", "is_holiday": "boolean", "department": "string", "section": "string", "node_id": "string"}
    schema = ", ".join(f"{k} {kinds.get(k, 'double')}" for k in values)
    return B.blend_uplift(spark.createDataFrame([tuple(values.values())], schema), CFG).first()


def test_blend(spark):
    assert abs(blended(spark).final_uplift - 1.6) < 1e-12
    assert abs(blended(spark).draft_target - 0.32) < 1e-12
    assert blended(spark, base_share_ly=0.001).draft_target == 0.02
    assert blended(spark, base_share_ly=5.0).draft_target == 0.999
    assert blended(spark, is_holiday=True).draft_target == 0.0
    empty = blended(spark, coef_uplift=None, coef_seasonal=None, coef_norm=None)
    assert (empty.final_uplift, empty.draft_target) == (0.0, 0.02)
    damped = blended(spark, day_index=1, iso_date=date(2000, 12, 5), uplift=2.0, seasonal_factor=0.0)
    assert abs(damped.final_uplift - 1.1) < 1e-12
    assert blended(spark, department="0012", section="1299") is None
    assert blended(spark, department="0012", section="1206") is not None


def test_final_targets_drop_the_placeholder(spark):
    model = spark.createDataFrame(
        [("E", "X", "n", date(2000, 12, 1), "L", "SYSTEM", 0.25)],
        "event_id string, country string, node_id string, iso_date date, store_cluster string, target_type string, draft_target double",
    )
    user = B.user_override_schema(spark, CFG).unionByName(
        spark.createDataFrame([("E", "X", "n", date(2000, 12, 1), "L", 0.5)], B.USER_SCHEMA)
    )
    out = {(r.target_type, r.final_target) for r in B.final_targets(model, user).collect()}
    assert out == {("SYSTEM", 25.0), ("USER", 50.0)}


def test_stage_and_orc(spark, tmp_path):
    df = spark.range(5)
    assert stage(df, "t").count() == 5
    write_table(df, str(tmp_path / "orc"))
    assert spark.read.orc(str(tmp_path / "orc")).count() == 5
