import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from finflow.functions.words import capitalize_words, capitalize_words_udf, register_capitalize_words
from finflow.operators.aggregates import collect_lists, first_by, flat_map_groups, last_by, reduce_groups
from finflow.operators.layout import glom, stable_sample, stable_split
from finflow.operators.clean import clean_finances
from finflow.operators.transactions import (
    account_profile, is_red_flag, malformed, mark_possible_fraud, merge_state, parse_lines, safe_average, valid,
)
from finflow.schemas import (
    EVALUATED_TRANSACTION, MALFORMED_LINE, SIMPLE_TRANSACTION, TRANSACTION, TRANSACTION_FOR_AVERAGE,
)

LINES = {
    "1,01/31/2020,A1,10.5,food": None,
    "2,1/2/2020,A1,-3,pay": None,
    "+3,13/45/2020,A1,1e3,carried": None,
    "4,1/2/2020xyz,A1, 7 ,tail": None,
    "5,01/02/2020,,1,no account": None,
    "6,01/02/2020,A1,NaN,odd": None,
    "7,01/02/2020,A1,1,": "field_count",
    "8,01/02/2020,A1,1,a,b": "field_count",
    "": "field_count",
    ",,,,": "field_count",
    " 9,01/02/2020,A1,1,x": "bad_id",
    "1.5,01/02/2020,A1,1,x": "bad_id",
    "99999999999999999999,01/02/2020,A1,1,x": "bad_id",
    "10,soon,A1,1,x": "bad_date",
    "11,01-02-2020,A1,1,x": "bad_date",
    "12,01/02/2020,A1,much,x": "bad_amount",
}


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(line,) for line in LINES], "value string")


def test_verdicts(lines):
    got = {r["line"]: r["error"] for r in parse_lines(lines).collect()}
    assert got == LINES


def test_a_row_has_a_record_or_an_error(lines):
    parsed = parse_lines(lines)
    assert valid(parsed).count() + malformed(parsed).count() == len(LINES)
    bad = parsed.where("error is not null").where(
        "id is not null or account_number is not null or date is not null or amount is not null"
    )
    assert bad.count() == 0


def test_records_have_the_declared_schemas(lines):
    parsed = parse_lines(lines)
    assert valid(parsed).schema.simpleString() == SIMPLE_TRANSACTION.simpleString()
    assert malformed(parsed).schema.simpleString() == MALFORMED_LINE.simpleString()


def test_clean_finances_on_nested_records(spark):
    account, nobody = ("A1", "Ann", "Lee"), (None, "Bo", "Ray")
    day = datetime.date(2020, 1, 2)
    rows = spark.createDataFrame(
        [
            (1, account, day, 5.0, None),
            (2, account, day, 0.0, "food"),
            (3, account, day, 0.0, None),
            (4, account, day, None, "food"),
            (None, nobody, None, None, None),
        ],
        TRANSACTION,
    )
    got = sorted((r["id"], r["description"]) for r in clean_finances(rows).collect())
    assert got == [(1, "Unknown"), (3, "Unknown")]
    averaged = clean_finances(rows).select("account.number", "amount", "description", "date")
    averaged = averaged.toDF(*TRANSACTION_FOR_AVERAGE.names)
    assert averaged.schema.simpleString() == TRANSACTION_FOR_AVERAGE.simpleString()
    assert account_profile(averaged).first()["average_transaction"] == 2.5


def test_evaluated_transactions(spark, lines):
    marked = mark_possible_fraud(valid(parse_lines(lines)))
    packed = marked.select(F.struct(*SIMPLE_TRANSACTION.names).alias("tx"), "is_possible_fraud")
    assert packed.schema.simpleString() == EVALUATED_TRANSACTION.simpleString()


def test_dates_carry_over(lines):
    dates = {r["id"]: r["date"] for r in valid(parse_lines(lines)).collect()}
    assert dates[1] == datetime.date(2020, 1, 31)
    assert dates[3] == datetime.date(2021, 2, 14)
    assert dates[4] == datetime.date(2020, 1, 2)


def test_strict_dates(lines):
    got = {r["line"]: r["error"] for r in parse_lines(lines, strict=True).collect()}
    assert got["+3,13/45/2020,A1,1e3,carried"] == "bad_date"
    assert got["4,1/2/2020xyz,A1, 7 ,tail"] == "bad_date"
    assert got["2,1/2/2020,A1,-3,pay"] is None


def test_merge_cases(spark):
    schema = "account_number string, total_spending double, num_tx bigint"
    old = spark.createDataFrame([("idle", 10.0, 2), ("both", 6.0, 3)], schema)
    new = spark.createDataFrame([("both", 4.0, 1), ("new", 8.0, 4)], schema)
    got = {r[0]: tuple(r)[1:] for r in merge_state(old, new).collect()}
    assert got == {"idle": (10.0, 2, 0.0), "both": (10.0, 4, 4.0), "new": (8.0, 4, 2.0)}


def test_flags(spark):
    rows = spark.createDataFrame(
        [(2000.0, 0.0, 0.0), (2000.1, 0.0, 0.0), (0.0, 2500.0, 400.0)], "a double, w double, h double"
    )
    flags = [r[0] for r in rows.select(is_red_flag(F.col("a"), F.col("w"), F.col("h"))).collect()]
    assert flags == [False, True, True]
    marks = mark_possible_fraud(spark.createDataFrame([(4000.0,), (4000.5,)], "amount double"))
    assert [r["is_possible_fraud"] for r in marks.collect()] == [False, True]
    guarded = spark.createDataFrame([(0.0, 0), (9.0, 3)], "t double, n int")
    assert [r[0] for r in guarded.select(safe_average("t", "n")).collect()] == [0.0, 3.0]


def test_capitalize_words_agree(spark):
    texts = ["two words", " lead", "a  b ", "", "mIxed CASE", None]
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    register_capitalize_words(spark)
    got = rows.select(
        capitalize_words(F.col("s")).alias("native"),
        capitalize_words_udf("s").alias("udf"),
        F.expr("capitalizeWords(s)").alias("sql"),
    ).collect()
    assert [r["native"] for r in got] == ["Two Words", " Lead", "A  B", "", "MIxed CASE", None]
    assert all(r["native"] == r["udf"] == r["sql"] for r in got)


@pytest.mark.parametrize("combine_rows", [1, 7, 100_000])
def test_reduce_groups(spark, combine_rows):
    def largest(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values("v", ascending=False).drop_duplicates("k")

    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 != 1, F.col("id") % 200).alias("k"),
        (F.col("id") * 7919 % 5003).alias("v"),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = reduce_groups(rows, ["k"], largest, "k bigint, v bigint", combine_rows)
        got = sorted(map(tuple, got.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = rows.groupBy("k").agg(F.max("v"))
    assert got == sorted(map(tuple, expected.collect()), key=str)


@pytest.mark.parametrize("order", [["id"], ["-id"], ["-half", "id"]])
@pytest.mark.parametrize(("chunk_rows", "range_rows"), [(8, 5), (32, 1000), (1000, 1000)])
def test_collect_lists_chunks_add_up(spark, order, chunk_rows, range_rows):
    """All groups are longer than a list, some are, none is."""
    rows = spark.range(100).select(
        F.when(F.col("id") % 4 != 0, 0).otherwise(F.col("id") % 3).alias("k"),
        F.col("id"),
        F.floor(F.col("id") / 2).alias("half"),
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("v"),
    )
    got = {}
    for r in collect_lists(rows, ["k"], order, "v", "vs", chunk_rows, range_rows=range_rows).orderBy("k", "chunk").collect():
        assert len(r["vs"]) <= chunk_rows
        got.setdefault(r["k"], []).extend(r["vs"])
    place = {"id": lambda i: i, "-id": lambda i: -i, "-half": lambda i: (-(i // 2), i)}[order[0]]
    assert got == {
        k: sorted((v for v in range(100) if v % 10 and (0 if v % 4 else v % 3) == k), key=place) for k in range(3)
    }


def test_flat_map_groups_keeps_the_null_group(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 9), (None, 5), (None, 6), ("b", 2)], "k string, v int")
    above = F.when(F.col("v") > F.col("_avg"), F.array("v", F.col("v") * 10))
    got = flat_map_groups(rows, ["k"], {"_avg": F.avg("v")}, above, "x")
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 9), ("a", 90), (None, 6), (None, 60)]


def test_first_and_last_skip_nulls(spark):
    rows = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "x"), ("a", 3, "y"), ("a", 4, None), ("b", 1, None)],
        "k string, id int, v string",
    )
    first = {r[0]: r[1] for r in first_by(rows, ["k"], F.col("id"), v=F.col("v")).collect()}
    last = {r[0]: r[1] for r in last_by(rows, ["k"], F.col("id"), v=F.col("v")).collect()}
    assert first == {"a": "x", "b": None} and last == {"a": "y", "b": None}


def test_split_parts_are_disjoint_and_cover(spark):
    rows = spark.range(3000)
    parts = stable_split(rows, ["id"], [8, 1, 1])
    counts = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sum(counts.values()) == 3000 and set(counts) == {0, 1, 2}
    assert 2300 < counts[0] < 2500
    again = stable_split(rows.repartition(7), ["id"], [8, 1, 1])
    assert again.exceptAll(parts).count() == 0
    with pytest.raises(ValueError):
        stable_split(rows, ["id"], [0, 0])


def test_sample_does_not_depend_on_layout(spark):
    one = stable_sample(spark.range(2000), ["id"], 0.1)
    two = stable_sample(spark.range(2000).repartition(5), ["id"], 0.1)
    assert one.exceptAll(two).count() == 0 and 120 < one.count() < 280


def test_glom_holds_each_partition(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        packed = glom(spark.range(50).repartition(3), "id").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(v for r in packed for v in r["items"]) == list(range(50))
    assert {r["partition_id"] for r in packed} == {0, 1, 2}
    assert max(len(r["items"]) for r in packed) <= 8
