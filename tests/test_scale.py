"""Steps that were rewritten to exchange and write less: the same rows as before, and the narrower plan."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from festivo.checks.registry import CFG
from festivo.operators import allocation as A, promotions as P
from festivo.sources import retail as S


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_sums_along_a_product_s_days_equal_sums_by_row(spark):
    day = date(2000, 12, 20)
    rows = [("A", i % 2, 1 + i % 3, day + timedelta(days=5 * i % 23) if i % 7 else None, 2.0 * i if i % 5 else None, 1.0) for i in range(60)]
    sales = spark.createDataFrame(rows, "country string, store int, sku int, sale_date date, qty_promo double, qty_regular double")
    key = ["country", "store", "sku"]
    held = sales.groupBy(*key).agg(F.collect_list(F.struct("sale_date", "qty_promo", "qty_regular")).alias("days"))
    summed = held.select(*key, S.week_days("days")).select(*key, *S.weekday_totals("days"))
    assert sorted(map(tuple, summed.collect()), key=repr) == sorted(map(tuple, S.weekday_sums(sales, key).collect()), key=repr)


def write_star(spark, root: str) -> None:
    """A few orders, one part listed twice under one code and one under two, and a sale on two days of one week."""
    t = "timestamp_ntz"
    tables = {
        "region": ([(0, "AFRICA")], "r_regionkey int, r_name string"),
        "nation": ([(0, 0), (1, 0)], "n_nationkey int, n_regionkey int"),
        "supplier": ([(1, 0, 5.0), (2, 1, 6.0), (3, 1, 7.0)], "s_suppkey long, s_nationkey int, s_acctbal double"),
        "part": (
            [(7, "red pen", "Brand#11", "PROMO TIN", 10), (7, "red pen", "Brand#11", "PROMO TIN", 10),
             (8, "blue ink", "Brand#12", "SMALL TIN", 3), (8, "blue ink", "Brand#12", "SMALL TIN", 4)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
        ),
        "orders": ([(i, f"2000-12-{10 + i}") for i in range(1, 7)], "o_orderkey long, o_orderdate string"),
        "lineitem": (
            [(i, 7 + i % 2, 1 + i % 3, f"2000-12-{11 + d}", float(i), 0.04 + 0.02 * (i % 3), 0.0, 10.0 * i, "N", "O") for i in range(1, 7) for d in (0, i, i)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate string, l_quantity double, l_discount double, l_tax double, "
            "l_extendedprice double, l_returnflag string, l_linestatus string",
        ),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        for c in ("o_orderdate", "l_shipdate"):
            if c in df.columns:
                df = df.withColumn(c, F.col(c).cast(t))
        df.write.parquet(f"{root}/{name}.parquet")


def test_day_plan_needs_no_exchange_of_product_weeks_and_keeps_repeated_products(spark, tmp_path):
    write_star(spark, str(tmp_path))
    r = S.Retail(spark, str(tmp_path), CFG)
    sales = r.daily_sales().join(r.products.select("sku", "code"), "sku")
    weekly = S.fiscal_calendar(sales.filter(F.col("qty_promo") > 0), "sale_date")
    weekly = weekly.withColumn("week", S.year_week(F.col("fiscal_year"), F.col("fiscal_week")))
    place = ["country", "store"]
    columns = ["country", "store", "plan_sku", "plan_code", *[f"day_{n}" for n in range(1, 8)]]
    expected = S.shares(S.weekday_sums(weekly, [*place, "sku", "code", "week"])).withColumnsRenamed({"sku": "plan_sku", "code": "plan_code"})
    user = r.day_plan.filter((F.col("kind") == "PTG") & (F.col("plan_sku") != 0))
    assert sorted(map(tuple, user.select(*columns).collect())) == sorted(map(tuple, expected.select(*columns).collect()))
    own = S.weekday_sums(sales, [*place, "sku", "code"])
    code = F.when(F.col("n_rows") == 2, F.substring("code", 1, 5)).otherwise(F.col("code")).alias("plan_code")
    expected = S.shares(own).withColumn("plan_sku", F.col("sku")).withColumn("plan_code", code)
    system = r.day_plan.filter((F.col("kind") == "PTP") & (F.col("plan_sku") != 0))
    assert sorted(map(tuple, system.select(*columns).collect())) == sorted(map(tuple, expected.select(*columns).collect()))
    assert "Exchange hashpartitioning" not in plan_of(user).split("== Physical Plan ==")[1]


def test_promo_intervals_are_the_promotions_without_prices(spark, tmp_path):
    write_star(spark, str(tmp_path))
    r = S.Retail(spark, str(tmp_path), CFG)
    without = r.promos.drop("price_normal", "price_promo", "price_club")
    assert r.promo_intervals.columns == without.columns
    assert sorted(map(tuple, r.promo_intervals.collect())) == sorted(map(tuple, without.collect()))


def test_days_of_a_promotion_are_exchanged_side_by_side(spark):
    first = date(2000, 12, 20)
    nodes = {f"node_{level}": "d" for level in ("division", "department", "section", "grp", "subgroup")}
    base = [{"country": "A", **nodes, "store_cluster": "L", "promo_start": first, "promo_end": first + timedelta(days=3)}]
    base = spark.createDataFrame(base, "country string, " + ", ".join(f"{n} string" for n in nodes) + ", store_cluster string, promo_start date, promo_end date")
    rows = base.select("country", "node_subgroup", "store_cluster", F.explode(F.sequence("promo_start", "promo_end")).alias("promo_date"))
    rows = rows.unionByName(rows.limit(1).withColumn("promo_date", F.lit(None).cast("date")))
    targets = spark.createDataFrame(
        [("A", "d", first, "L", "SYSTEM", 1.0), ("A", "d", first + timedelta(days=2), "L", "USER", 2.0)],
        "country string, node_id string, iso_date date, store_cluster string, target_type string, final_target double",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = A.target_fallback_lookup(rows, base, targets)
        assert [r.target for r in found.orderBy("promo_date").collect()] == [None, 1.0, None, 2.0, None]
        assert "country, node_subgroup, store_cluster, promo_date, target".split(", ") == found.columns
        top = [line for line in plan_of(found).split("== Physical Plan ==")[1].splitlines() if "SortMergeJoin" in line][0]
        assert "promo_date" not in top
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_user_plans_of_other_weeks_drop_out(spark):
    plan = spark.createDataFrame(
        [("200051", "USER"), ("200052", "USER"), (None, "USER"), ("200040", "SYSTEM"), ("200040", None)], "plan_week string, updated_by string"
    )
    weeks = spark.createDataFrame([("200051",), ("200051",)], "plan_week string")
    kept = P.reachable_plans(plan, weeks)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([("200051", "USER"), ("200040", "SYSTEM"), ("200040", None)], key=repr)


def test_added_run_meets_only_the_stores_that_were_added(spark):
    promos = spark.createDataFrame([("A", 1, d) for d in range(3)], "country string, sku int, d int")
    promos = promos.select("country", "sku", F.expr("date_add(date'2000-12-01', d)").alias("promo_start"), F.lit(date(2000, 12, 9)).alias("promo_end"))
    added = promos.filter(F.day("promo_start") < 3).withColumn("store_number", F.explode(F.array(F.lit(1001), F.lit(1001), F.lit(1002))))
    added = added.filter((F.day("promo_start") == 1) | (F.col("store_number") == 1002))
    met = P.added_stores(promos, added).orderBy("promo_start").collect()
    assert [sorted(r.added_in) for r in met] == [[1001, 1002], [1002]]
