"""Edge values: null orders, empty spans, NaN, spellings of numbers, corrections inside a batch."""

import math

import pytest
from pyspark.sql import functions as F

from finflow.operators.aggregates import drop_duplicates_by, first_and_last, first_by, last_by
from finflow.operators.layout import in_order, positioned
from finflow.operators.skew import Heat
from finflow.operators.transactions import is_red_flag, mark_possible_fraud, parse_lines
from finflow.operators.windows import range_totals
from finflow.sources.keyed import read_upserted, upsert_batch


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("span", [0, 1, 5])
def test_range_totals_keeps_rows_without_order(spark, span):
    rows = [("a", 1, 1.0), ("a", 1, 2.0), ("a", None, 4.0), ("a", None, 8.0), ("a", 6, 16.0), ("b", None, 32.0), (None, 3, 64.0)]
    df = spark.createDataFrame(rows, "k string, d int, v double")
    plain = as_rows(range_totals(df, ["k"], F.col("d"), span, "v"))
    hot = as_rows(range_totals(df, ["k"], F.col("d"), span, "v", heat=Heat(0, 0.0)))
    assert len(plain) == len(rows) and plain == hot


def test_duplicates_without_order_keep_their_columns(spark):
    rows = [("a", None, 7), ("b", 2, 8), ("b", None, 9), ("b", 1, 10)]
    df = spark.createDataFrame(rows, "k string, o int, x int")
    assert as_rows(drop_duplicates_by(df, ["k"], F.col("o"))) == [("a", None, 7), ("b", 1, 10)]


def test_first_and_last_without_order(spark):
    """Rows without an order answer only for groups and columns that have no others."""
    rows = [("a", None, 7, None), ("b", 2, None, 1), ("b", None, 9, 2), ("b", 1, 10, None), ("b", 3, 11, None), ("c", 1, None, None)]
    df = spark.createDataFrame(rows, "k string, o int, x int, y int")
    order, columns = F.col("o"), {"x": F.col("x"), "y": F.col("y")}
    assert as_rows(first_by(df, ["k"], order, **columns)) == [("a", 7, None), ("b", 10, 1), ("c", None, None)]
    assert as_rows(last_by(df, ["k"], order, **columns)) == [("a", 7, None), ("b", 11, 1), ("c", None, None)]
    both = first_and_last(df, ["k"], order, **columns)
    assert both.columns == ["k", "first_x", "last_x", "first_y", "last_y"]
    assert as_rows(both) == [("a", 7, 7, None, None), ("b", 10, 11, 1, 1), ("c", None, None, None, None)]


def test_last_write_of_a_batch_wins(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1, 500.0, 1), (1, 300.0, 2), (2, 5.0, None), (3, 1.0, 1), (3, 9.0, 1)], "id int, amount double, at int")
    for _ in range(2):
        upsert_batch(first, 0, path, ["id"], order=F.col("at"))
    assert as_rows(read_upserted(spark, path, ["id"])) == [(1, 300.0, 2), (2, 5.0, None), (3, 9.0, 1)]
    upsert_batch(spark.createDataFrame([(1, 100.0, 0)], first.schema), 1, path, ["id"], order=F.col("at"))
    assert as_rows(read_upserted(spark, path, ["id"]))[0] == (1, 100.0, 0)


def test_not_a_number_flags_nothing(spark):
    df = spark.createDataFrame([(math.nan, 0.0), (5000.0, math.nan), (math.inf, 0.0), (None, 9000.0), (0.0, 0.0)], "a double, w double")
    flags = [r[0] for r in df.select(is_red_flag(F.col("a"), F.col("w"), F.lit(0.0))).collect()]
    assert flags == [False, True, True, True, False]
    assert [r["is_possible_fraud"] for r in mark_possible_fraud(df, "a").collect()] == [False, True, True, None, False]


def test_spelling_of_amounts(spark):
    amounts = ["nan", "NaN", "inf", "Infinity", "-Infinity", "INFINITY", "1e3", "1.5"]
    lines = spark.createDataFrame([(f"{i},01/02/2020,a,{x},d",) for i, x in enumerate(amounts)], "value string")
    errors = [r["error"] for r in parse_lines(lines).orderBy("line").collect()]
    assert errors == ["bad_amount", None, "bad_amount", None, None, "bad_amount", None, None]


def test_order_checks_see_the_order(spark):
    df = spark.range(1000).repartition(7).withColumn("x", F.col("id") * 7919 % 1009)
    assert positioned(df.orderBy("x")).where("position = 1").first()["x"] == df.agg(F.min("x")).first()[0]
    assert in_order(df.sortWithinPartitions("x"), ["x"]).where("not in_order").count() == 0
    assert in_order(df, ["x"]).where("not in_order").count() > 0
