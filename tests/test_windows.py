"""Both paths of the window operators, against plain windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from finflow.operators import skew
from finflow.operators.skew import Heat
from finflow.operators.windows import (
    lookback_rows, numbered, previous, range_totals, ranked, running_totals, time_bucket,
)
from finflow.plans.explain import plan_text
from finflow.schemas import STATUS

KEYS, ORDER = ["account"], ["day", "id"]
LIMITS = [
    {},  # no key is hot
    {"heat": Heat(30, 0.0, range_rows=150)},  # some are, in several ranges
    {"heat": Heat(0, 0.0, range_rows=40)},  # all are
    {"heat": Heat(0, 0.0)},  # all are, in one range
]


@pytest.fixture(scope="module")
def rows(spark):
    """Two thousand rows, a third on account 0, some on no account, with ties and null amounts."""
    number = F.col("id")
    return spark.range(2000).select(
        "id",
        F.when(number % 3 == 0, 0).when(number % 31 != 1, number % 17).alias("account"),
        F.date_add(F.lit("2020-01-01").cast("date"), (number * 7919 % 60).cast("int")).alias("day"),
        F.when(number % 11 != 0, number * 37 % 101).alias("amount"),
    ).persist()


def same(one, two):
    assert sorted(one.columns) == sorted(two.columns)
    columns = sorted(one.columns)
    one, two = one.select(columns), two.select(columns)
    assert one.exceptAll(two).count() == 0
    assert two.exceptAll(one).count() == 0


def whole():
    return Window.partitionBy("account").orderBy("day", "id")


@pytest.mark.parametrize("limits", LIMITS)
def test_lookback_rows(rows, limits):
    made = {
        "rolling": lambda w: F.sum("amount").over(w.rowsBetween(-4, 0)),
        "before": lambda w: F.lag("amount", 3, -1).over(w),
    }
    plain = rows.select("*", *[m(whole()).alias(n) for n, m in made.items()])
    same(lookback_rows(rows, KEYS, ORDER, 4, made, **limits), plain)


@pytest.mark.parametrize("limits", LIMITS)
def test_lookback_over_many_small_buckets(rows, limits):
    """Looking back further than a bucket is long."""
    made = {"rolling": lambda w: F.count("id").over(w.rowsBetween(-40, 0))}
    plain = rows.select("*", made["rolling"](whole()).alias("rolling"))
    same(lookback_rows(rows, KEYS, ORDER, 40, made, **limits), plain)


@pytest.mark.parametrize("limits", LIMITS)
def test_range_totals(rows, limits):
    day = F.unix_date("day")
    frame = Window.partitionBy("account").orderBy(day).rangeBetween(-9, 0)
    plain = rows.select(
        "*",
        F.sum("amount").over(frame).alias("r_sum"),
        F.count("amount").over(frame).alias("r_count"),
        F.min("amount").over(frame).alias("r_min"),
        F.max("amount").over(frame).alias("r_max"),
    )
    same(range_totals(rows, KEYS, day, 9, "amount", "r_", **limits), plain)


@pytest.mark.parametrize("limits", LIMITS)
def test_numbered(rows, limits):
    plain = rows.withColumn("n", F.row_number().over(whole()).cast("bigint"))
    same(numbered(rows, KEYS, ORDER, "n", **limits), plain)


@pytest.mark.parametrize("limits", LIMITS)
def test_numbered_descending(rows, limits):
    backwards = Window.partitionBy("account").orderBy(F.col("day").desc(), "id")
    plain = rows.withColumn("n", F.row_number().over(backwards).cast("bigint"))
    same(numbered(rows, KEYS, ["-day", "id"], "n", **limits), plain)


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("order", [["day"], ["-day"], ["day", "-amount"]])
def test_ranked(rows, limits, order):
    columns = {"r": "rank", "d": "dense_rank", "p": "percent_rank"}
    by = [F.col(o[1:]).desc() if o[0] == "-" else F.col(o) for o in order]
    w = Window.partitionBy("account").orderBy(*by)
    plain = rows.select(
        "*",
        F.rank().over(w).cast("bigint").alias("r"),
        F.dense_rank().over(w).cast("bigint").alias("d"),
        F.percent_rank().over(w).alias("p"),
    )
    same(ranked(rows, KEYS, order, columns, **limits), plain)


@pytest.mark.parametrize("limits", LIMITS)
def test_running_totals(rows, limits):
    so_far = whole().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = rows.select(
        "*",
        F.sum("amount").over(so_far).alias("running_sum"),
        F.count("amount").over(so_far).alias("running_count"),
        F.sum("amount").over(Window.partitionBy("account")).alias("key_total"),
    )
    same(running_totals(rows, KEYS, ORDER, "amount", **limits), plain)


def test_ranks_of_ties(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "account string, day int")
    columns = {"r": "rank", "d": "dense_rank", "p": "percent_rank"}
    for limits in LIMITS:
        got = ranked(rows, KEYS, ["day"], columns, **limits).select("r", "d", "p")
        assert sorted(map(tuple, got.collect())) == [(1, 1, 0.0), (1, 1, 0.0), (3, 2, 1.0)]


def test_previous_status(spark):
    rows = spark.createDataFrame([(1, "Ann", "New"), (2, "Ann", "Open")], STATUS)
    for limits in LIMITS:
        got = previous(rows, ["customer"], ["id"], "status", "before", **limits)
        assert {r["id"]: r["before"] for r in got.collect()} == {1: None, 2: "New"}


def test_split_keeps_all_rows(rows):
    hot = Heat(200, 0.0).find(rows, KEYS)
    cold, warm = hot.split(rows)
    assert {r[0] for r in warm.select("account").distinct().collect()} == {0} and hot.count == 1
    assert cold.count() + warm.count() == rows.count() and hot.rows == warm.count()


def test_share_bounds_the_number_of_hot_keys(rows):
    assert Heat(0, 0.25).find(rows, KEYS).count == 1
    assert Heat(0, 0.5).find(rows, KEYS).table is None


@pytest.mark.parametrize("cells", [1, 7, 1 << 20])
def test_sketch_never_misses_a_hot_key(rows, monkeypatch, cells):
    """However many keys share a counter; null is a key like any other."""
    monkeypatch.setattr(skew, "CELLS", cells)
    for keys in (["account"], ["account", "day"]):
        for least in (3, 100, 600, 2000):
            wanted = rows.groupBy(*keys).count().where(F.col("count") > least).collect()
            found = Heat(least, 0.0).find(rows, keys)
            got = [] if found.table is None else found.table.collect()
            assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, wanted)))
            assert found.count == len(wanted) and found.rows == sum(r["count"] for r in wanted)


def test_operators_share_one_list(rows):
    hot = Heat(30, 0.0, 150).find(rows, KEYS)
    plain = rows.withColumn("n", F.row_number().over(whole()).cast("bigint"))
    same(numbered(rows, KEYS, ORDER, "n", hot), plain)
    before = rows.withColumn("b", F.lag("amount").over(whole()))
    same(previous(rows, KEYS, ORDER, "amount", "b", heat=hot), before)
    with pytest.raises(ValueError):
        numbered(rows, ["day"], ["id"], "n", hot)


def test_ranges_and_hot_cells_stay_few(rows, monkeypatch):
    """Very many ranges get larger instead, and very many large cells are not listed."""
    monkeypatch.setattr(skew, "MOST_RANGES", 4)
    monkeypatch.setattr(skew, "MOST_BROADCAST", 1)
    hot = Heat(3, 0.0, range_rows=2).find(rows, KEYS)
    assert hot.count == rows.groupBy(*KEYS).count().where("count > 3").count() > 1
    assert "Broadcast" not in plan_text(hot.split(rows)[1])
    assert hot.in_ranges(rows, [F.col("id").asc()]).select("_range").distinct().count() == 4
    plain = rows.withColumn("n", F.row_number().over(whole()).cast("bigint"))
    same(numbered(rows, KEYS, ORDER, "n", hot), plain)


def test_a_hot_key_on_one_day_is_cut_evenly(spark):
    """A third of the rows on one account and one day: no task has over twice the rows of the median task."""
    number = F.col("id")
    rows = spark.range(60_000).select(
        "id",
        F.when(number % 3 == 0, -1).otherwise(number % 5000).alias("account"),
        F.when(number % 3 == 0, F.lit("2024-05-05")).otherwise(F.lit("2024-01-01")).cast("date").alias("day"),
        (number % 101).alias("amount"),
    )
    heat = Heat(1000, 0.0, range_rows=250)
    hot = heat.find(rows, KEYS)
    placed = hot.in_ranges(hot.split(rows)[1], [F.col("day"), F.col("id")])
    sizes = sorted(r["count"] for r in placed.groupBy("_range").count().collect())
    assert len(sizes) == 80 and sizes[-1] <= 2 * sizes[40]
    # The tasks of the window over ranges, as the shuffle deals them.
    dealt = placed.repartition(4, "account", "_range").groupBy(F.spark_partition_id()).count()
    tasks = sorted(r["count"] for r in dealt.collect())
    assert len(tasks) == 4 and tasks[-1] <= 2 * tasks[2]
    same(numbered(rows, KEYS, ORDER, "n", hot), rows.withColumn("n", F.row_number().over(whole()).cast("bigint")))


def test_null_times_have_no_window(spark):
    rows = spark.createDataFrame([(1, None), (2, "2024-01-01 00:20:00")], "id int, at string")
    got = time_bucket(rows.withColumn("at", F.col("at").cast("timestamp")), "at", "1 hour")
    assert [r["id"] for r in got.collect()] == [2]


def test_without_hot_keys_the_final_plan_is_the_plain_one(spark, small):
    """No counter of the sketch is large, so nothing is planned for hot keys."""
    orders = spark.read.parquet(f"{small}/orders.parquet").select("o_custkey", "o_orderdate", "o_orderkey")
    df = numbered(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "n")
    df.collect()
    final = plan_text(df, "extended").split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1
    assert "Join" not in final and "Union" not in final
