import re

import pytest
from pyspark.sql import functions as F

from finflow.operators.joins import band_join, broadcast_join, cross_join, fits_in_broadcast, outer_join, pair_join
from finflow.plans.catalog import QUERIES
from finflow.plans.explain import join_strategies, plan_text, pushed_filters, scanned_columns, shuffles
from finflow.plans.registry import Tables
from finflow.schemas import PERSON, ROLE
from test_windows import LIMITS, same


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(200).select(
        F.when(F.col("id") % 10 != 9, F.col("id") % 23).alias("k"), F.col("id").alias("l")
    )
    right = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 7 != 1, F.col("id") % 40).alias("k"),
        F.col("id").alias("r"),
    )
    return left.persist(), right.persist()


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("how", ["left", "right", "full", "left_outer", "outer", "full_outer"])
def test_outer_join(sides, how, limits):
    left, right = sides
    same(outer_join(left, right, ["k"], how, **limits), left.join(right, ["k"], how))


def test_pair_join_absent_side_is_null(spark):
    people = spark.createDataFrame([(1, "Ann", "Lee"), (2, "Bo", "Ray")], PERSON)
    roles = spark.createDataFrame([(1, "Lead"), (3, "Odd")], ROLE)
    full = pair_join(people, roles, [("id", "id")], "full")
    got = sorted(
        (r["_1"]["id"] if r["_1"] else 0, r["_2"]["id"] if r["_2"] else 0) for r in full.collect()
    )
    assert got == [(0, 3), (1, 1), (2, 0)]
    inner = pair_join(people, roles, [("id", "id")])
    assert [(r["_1"]["first"], r["_2"]["role"]) for r in inner.collect()] == [("Ann", "Lead")]


def test_band_join_edges(spark):
    values = spark.createDataFrame([(0.0,), (9.9,), (10.0,), (25.0,), (-3.0,)], "v double")
    bands = spark.createDataFrame(
        [("a", -5.0, 10.0), ("b", 10.0, 25.0), ("c", 5.0, 5.0)], "band string, lo double, hi double"
    )
    got = sorted(map(tuple, band_join(values, bands, "v", "lo", "hi", 10.0).select("v", "band").collect()))
    assert got == [(-3.0, "a"), (0.0, "a"), (9.9, "a"), (10.0, "b")]


def test_broadcast_only_below_the_limit(spark, small):
    t = Tables(spark, small)
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    customer = t.customer.select("c_custkey", "c_name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shipped = broadcast_join(orders, customer, ["c_custkey"])
        shuffled = broadcast_join(orders, customer, ["c_custkey"], max_bytes=100)
        assert join_strategies(shipped) == ["BroadcastHashJoin"]
        assert join_strategies(shuffled) == ["SortMergeJoin"]
        same(shipped, shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hopeless_sides_are_not_measured(spark, small, monkeypatch):
    """Far over the limit by the optimizer's count: no job to find out."""
    orders = Tables(spark, small).orders
    group = "measure"
    spark.sparkContext.setJobGroup(group, group)
    assert not fits_in_broadcast(orders, max_bytes=1)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(group) == []
    assert not fits_in_broadcast(orders, max_bytes=100) and fits_in_broadcast(orders)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(group) != []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("max_bytes", [10, 700, 5000, 1 << 20])
def test_cross_join_of_any_size(spark, max_bytes):
    """Repeated rows and nulls included; blocks meet once each."""
    left = spark.range(60).select(F.when(F.col("id") % 7 != 0, F.col("id") % 40).alias("a"), F.lit("x").alias("name"))
    right = spark.range(50).select((F.col("id") % 45).alias("b"), F.when(F.col("id") % 3 == 0, F.lit("y")).alias("other"))
    same(cross_join(left, right, max_bytes), left.crossJoin(right))
    assert cross_join(left.limit(0), right, max_bytes).count() == cross_join(left, right.limit(0), max_bytes).count() == 0


def test_cross_join_in_blocks_has_no_nested_loop(spark):
    left, right = spark.range(1000).toDF("a"), spark.range(900).toDF("b")
    plan = plan_text(cross_join(left, right, max_bytes=2000))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_cross_join_in_blocks_broadcasts_no_copies(spark):
    """The optimizer expects a side without its copies, which would go through the driver."""
    left, right = spark.range(1000).toDF("a"), spark.range(900).toDF("b")
    assert "Broadcast" not in plan_text(cross_join(left, right, max_bytes=200))


def test_cross_join_query_pairs_parts_that_are_alike_once(spark, tmp_path):
    parts = [(i, ["B1", "B2", None][i % 3], None if i % 5 == 0 else i % 2) for i in range(300)]
    suppliers = [(None if i % 7 == 0 else i, i % 4 or None) for i in range(60)] + [(1, 1)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    wanted = {}
    for _, brand, size in parts:
        for key, nation in suppliers:
            n, weight = wanted.get((brand, nation), (0, None))
            if size is not None and key is not None:
                weight = (weight or 0) + size * key
            wanted[brand, nation] = n + 1, weight
    got = QUERIES["jon_08_cross_join_in_blocks"](spark, str(tmp_path))
    assert {(r["p_brand"], r["s_nationkey"]): (r["pairs"], r["weight"]) for r in got.collect()} == wanted
    assert re.search(r"Keys \[2\]: \[p_brand#\d+, p_size", plan_text(got))


@pytest.mark.parametrize("width", [None, 0.5, 10.0, 1e6])
def test_band_join_of_any_width(spark, width):
    """Narrow, wide and open bands, far and tiny values, against the condition itself."""
    inf, nan = float("inf"), float("nan")
    numbers = [0.0, -0.0, 1.0, 9.99, 10.0, 250.0, -3.0, 1e-300, -1e-9, 1e15, 1e15 + 1, 1e308, -1e308, inf, -inf, nan, None, 2.0**53]
    ends = [-inf, -1e308, -1e10, -3.0, 0.0, 1e-300, 1.0, 9.99, 10.0, 10.000001, 1e10, 1e15, 1e15 + 1, 1e308, inf, nan, None]
    values = spark.createDataFrame([(i, v) for i, v in enumerate(numbers)], "n int, v double")
    bands = spark.createDataFrame([(f"{a} {b}", a, b) for a in ends for b in ends], "band string, lo double, hi double")
    got = sorted(map(tuple, band_join(values, bands, "v", "lo", "hi", width).select("n", "band").collect()))
    real = lambda x: x is not None and x == x
    wanted = [(i, f"{a} {b}") for i, v in enumerate(numbers) for a in ends for b in ends if real(v) and real(a) and real(b) and a <= v < b]
    assert got == sorted(wanted)
    assert band_join(values.limit(0), bands, "v", "lo", "hi", width).count() == 0
    assert band_join(values, bands.limit(0), "v", "lo", "hi", width).count() == 0


def test_band_join_is_an_equi_join(spark):
    values = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    bands = spark.range(20).select((F.col("id") * 7.5).alias("lo"), (F.col("id") * 7.5 + F.pow(F.lit(10.0), "id")).alias("hi"))
    plan = plan_text(band_join(values, bands, "v", "lo", "hi"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_filters_and_columns_reach_the_scan(spark, small):
    df = Tables(spark, small).orders.where("o_totalprice > 1000").select("o_orderkey")
    assert "GreaterThan(o_totalprice,1000.0)" in pushed_filters(df)[0]
    assert scanned_columns(df) == ["o_orderkey:bigint,o_totalprice:double"]
    assert shuffles(df) == 0
    assert "Scan parquet" in plan_text(df)
