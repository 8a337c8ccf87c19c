import os

import pytest
from pyspark.sql import functions as F

from finflow.operators.clean import corrupted, drop_if_all_null, has_column, nonzero_or_unknown
from finflow.plans.explain import plan_text
from finflow.schemas import TRANSACTION
from finflow.session import shared_folder, work_folder
from finflow.sources.keyed import read_upserted, upsert_batch
from finflow.sources.readers import query_file, read_json, read_table
from finflow.sources.writers import for_each_partition, for_each_row, to_json_rows, write_parquet, write_table


@pytest.fixture(scope="module")
def broken(tmp_path_factory):
    path = tmp_path_factory.mktemp("json") / "rows.json"
    path.write_text('{"id": 1, "name": "a"}\n{"id": 2, "na\n{"id": 3, "name": null}\n')
    return str(path)


SCHEMA = "id bigint, name string"


def test_drop_malformed(spark, broken):
    rows = read_json(spark, broken, "DROPMALFORMED", SCHEMA)
    assert sorted(r["id"] for r in rows.collect()) == [1, 3]


def test_fail_fast(spark, broken):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json(spark, broken, "FAILFAST", SCHEMA).collect()


def test_permissive_keeps_the_text(spark, broken):
    rows = read_json(spark, broken, "PERMISSIVE", SCHEMA)
    assert rows.count() == 3
    bad = corrupted(rows)
    assert [r[0] for r in bad.collect()] == ['{"id": 2, "na']


def test_inferred_schema_has_corrupt_column(spark, broken):
    rows = read_json(spark, broken)
    assert has_column(rows, "_corrupt_record")
    assert corrupted(rows).count() == 1


def test_no_corrupt_column_no_corrupt_rows(spark):
    assert corrupted(spark.range(3)) is None


def test_whole_file(spark, tmp_path):
    (tmp_path / "doc.json").write_text('[{"id": 1,\n "name": "a"},\n {"id": 2}]')
    rows = read_json(spark, str(tmp_path), "FAILFAST", SCHEMA, whole_file=True)
    assert sorted((r["id"], r["name"]) for r in rows.collect()) == [(1, "a"), (2, None)]


def test_sampling_ratio_is_checked(spark, broken):
    assert read_json(spark, broken, sampling_ratio=1.0).count() == 3
    for ratio in (0.0, 1.5):
        with pytest.raises(ValueError):
            read_json(spark, broken, sampling_ratio=ratio)
    with pytest.raises(ValueError):
        read_json(spark, broken, mode="LENIENT")


def test_has_column(spark):
    rows = spark.createDataFrame([], TRANSACTION)
    nested = rows.select("id", F.array("account").alias("accounts"), "account")
    assert has_column(rows, "ID") and has_column(rows, "account.number")
    assert has_column(nested, "accounts.first_name")
    assert not has_column(rows, "account.street") and not has_column(rows, "id.number")
    assert not has_column(rows, "missing")


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(10), path, files=3)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 3
    write_parquet(spark.range(4), path)
    assert query_file(spark, path).count() == 4


def test_partitioned_table_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("part", F.col("id") % 2)
    write_table(rows, path, partition_by=["part"])
    odd = read_table(spark, path, ["id", "part"]).where("part = 1")
    assert sorted(r["id"] for r in odd.collect()) == [1, 3, 5, 7, 9]
    assert "PartitionFilters: [isnotnull(part" in plan_text(odd)


def test_absent_connector_is_reported(spark):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        read_table(spark, None, ["a"], kind="no.such.connector", table="t")


def test_json_rows_leave_out_nulls(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "id int, name string")
    assert sorted(r[0] for r in to_json_rows(rows).collect()) == ['{"id":1}', '{"id":2,"name":"x"}']


def test_keyed_log_is_folded(spark, tmp_path):
    """Forty batches stay a bounded number of folders; the table is what it was without folding."""
    folded, plain = str(tmp_path / "folded"), str(tmp_path / "plain")
    for n in range(40):
        batch = spark.range(n % 7, n % 7 + 5).select("id", F.lit(n).alias("v"), F.when(F.col("id") % 2 == 0, F.lit(f"b{n}")).alias("w"))
        for path, most in ((folded, 4), (plain, 1000)):
            upsert_batch(batch.coalesce(1), n, path, ["id"], most_batches=most)
            if n in (3, 17):  # the same batch again, before and after it was folded
                upsert_batch(batch.coalesce(1), n, path, ["id"], most_batches=most)
    rows = lambda p: sorted(map(tuple, read_upserted(spark, p, ["id"]).collect()))
    assert rows(folded) == rows(plain) and len(rows(folded)) == 11
    names = [p.name for p in (tmp_path / "folded").iterdir() if p.is_dir()]
    assert len(names) <= 2 * 4 + 2 and sum(n.startswith("base=") for n in names) == 2


def test_upsert_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (1, "a")], "id int, v string")
    second = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    upsert_batch(first, 0, path, ["id"])
    for _ in range(2):
        upsert_batch(second, 1, path, ["id"])
    got = read_upserted(spark, path, ["id"])
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_side_effects_run_on_all_rows(spark, tmp_path):
    folder = str(tmp_path)

    def save(rows):
        import uuid

        ids = [str(r["id"]) for r in rows]
        if ids:
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                out.write("\n".join(ids))

    for_each_partition(spark.range(20).repartition(3), save)
    seen = [line for name in os.listdir(folder) for line in open(f"{folder}/{name}").read().split()]
    assert sorted(map(int, seen)) == list(range(20))

    def touch(row):
        open(f"{folder}/row-{row['id']}", "w").close()

    for_each_row(spark.range(3), touch)
    assert sum(name.startswith("row-") for name in os.listdir(folder)) == 3


def test_null_rules(spark):
    rows = spark.createDataFrame(
        [(None, None), (None, "Unknown"), (0.0, "x"), (5.0, "x"), (None, "x")],
        "amount double, description string",
    )
    assert drop_if_all_null(rows).count() == 4
    kept = nonzero_or_unknown(rows)
    assert sorted(map(tuple, kept.collect()), key=str) == [(5.0, "x"), (None, "Unknown")]


def test_work_folders_are_below_the_shared_one(spark):
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one != two and one.startswith(shared_folder(spark))
