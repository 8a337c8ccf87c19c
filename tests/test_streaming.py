import datetime
import time

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from finflow.plans.explain import shuffles
from finflow.session import work_folder
from finflow.sources.keyed import read_upserted, upsert_batch
from finflow.streaming.joins import stream_join
from finflow.streaming.monitor import ProgressFiles, describe
from finflow.streaming.run import batch_folder, finish, run_available, start, to_batches, to_files
from finflow.streaming.sources import read_stream, replay, stream_lines, stream_queue, stream_table
from finflow.streaming.state import (
    KEY, StateTable, advance_state, empty_state, keep_state, list_windows, state_intervals, window_totals,
)
from finflow.streaming.tracked import active_totals, state_snapshot, track_active
from finflow.streaming.windows import window_counts, with_event_time


def at(hour):
    return datetime.datetime(2024, 1, 1, hour)


def totals(spark, *rows):
    return spark.createDataFrame(rows, f"{KEY} string, window_end timestamp, spent double, n bigint")


def states(df):
    return {
        (r[KEY], r["window_end"].hour): (r["total_spending"], r["num_tx"], r["window_avg"])
        for r in df.collect()
    }


def test_every_known_account_in_every_window(spark):
    news = totals(spark, ("a", at(1), 10.0, 2), ("b", at(2), 4.0, 1), ("a", at(4), 2.0, 1))
    got = states(advance_state(empty_state(spark), news, "1 hour", F.lit(at(4))))
    assert got == {
        ("a", 1): (10.0, 2, 5.0), ("a", 2): (10.0, 2, 0.0), ("a", 3): (10.0, 2, 0.0), ("a", 4): (12.0, 3, 2.0),
        ("b", 2): (4.0, 1, 4.0), ("b", 3): (4.0, 1, 0.0), ("b", 4): (4.0, 1, 0.0),
    }


def test_state_in_steps_equals_state_at_once(spark):
    news = totals(
        spark, ("a", at(1), 10.0, 2), ("b", at(2), 4.0, 1), ("a", at(4), 2.0, 1), ("c", at(6), 1.0, 1)
    )
    for timeout in (None, "2 hours"):
        once = states(advance_state(empty_state(spark), news, "1 hour", F.lit(at(6)), timeout))
        first = advance_state(
            empty_state(spark), news.where(F.col("window_end") <= at(3)), "1 hour", F.lit(at(3)), timeout
        )
        second = advance_state(
            first.where(F.col("window_end") == at(3)),
            news.where(F.col("window_end") > at(3)), "1 hour", F.lit(at(6)), timeout,
        )
        assert {**states(first), **states(second)} == once


def test_timeout_forgets_and_restarts(spark):
    news = totals(spark, ("a", at(1), 10.0, 2), ("a", at(6), 3.0, 1))
    got = states(advance_state(empty_state(spark), news, "1 hour", F.lit(at(6)), "2 hours"))
    assert got == {
        ("a", 1): (10.0, 2, 5.0), ("a", 2): (10.0, 2, 0.0), ("a", 3): (10.0, 2, 0.0), ("a", 6): (3.0, 1, 3.0)
    }


def test_initial_state_is_visited_from_the_first_window(spark):
    seed = spark.createDataFrame(
        [("s", 7.0, 1, 0.0, None, at(0))], empty_state(spark).schema
    )
    news = totals(spark, ("a", at(2), 10.0, 2), ("s", at(3), 1.0, 1))
    got = states(advance_state(seed, news, "1 hour", F.lit(at(3)), first=F.lit(at(2))))
    assert got[("s", 2)] == (7.0, 1, 0.0) and got[("s", 3)] == (8.0, 2, 1.0)


def test_runs_of_equal_state(spark):
    """Two transactions a million windows apart are three runs; a busy account has one per window."""
    begin = datetime.datetime(2024, 1, 1)
    late = begin + datetime.timedelta(seconds=1_000_000)
    news = totals(spark, ("a", begin, 10.0, 2), ("a", late, 3.0, 1), ("b", late, 4.0, 1))
    seed = spark.createDataFrame([("s", 7.0, 1, 0.5, begin, begin)], empty_state(spark).schema)
    runs = state_intervals(seed, news, "1 second", F.lit(late))
    got = sorted((r[KEY], r["total_spending"], r["num_tx"], r["window_avg"], r["first_end"], r["last_end"]) for r in runs.collect())
    second = datetime.timedelta(seconds=1)
    assert got == [
        ("a", 10.0, 2, 0.0, begin + second, late - second), ("a", 10.0, 2, 5.0, begin, begin), ("a", 13.0, 3, 3.0, late, late),
        ("b", 4.0, 1, 4.0, late, late), ("s", 7.0, 1, 0.0, begin + second, late),
    ]
    assert list_windows(runs, "1 second").count() == 2 * 1_000_000 + 2
    forgotten = state_intervals(seed, news, "1 second", F.lit(late), "10 seconds").collect()
    assert sorted((r[KEY], r["num_tx"], (r["last_end"] - r["first_end"]).seconds) for r in forgotten) == [
        ("a", 1, 0), ("a", 2, 0), ("a", 2, 9), ("b", 1, 0), ("s", 1, 9)
    ]


def test_a_million_active_windows_of_one_account(spark):
    """Linear: a few seconds for what a lookup per window in a list of all windows would not finish."""
    news = spark.range(1_000_000).select(
        F.lit("a").alias(KEY), F.timestamp_seconds(F.col("id") * 2).alias("window_end"), F.lit(1.0).alias("spent"), F.lit(1).cast("bigint").alias("n")
    )
    upto = F.lit("1970-01-24 03:33:18").cast("timestamp")
    runs = state_intervals(empty_state(spark), news, "1 second", upto)
    assert runs.agg(F.count(F.lit(1)), F.max("num_tx"), F.max("last_end")).first()[:2] == (1_999_999, 1_000_000)


def test_tracked_state_seeds_and_timers(spark, tmp_path):
    """Key by key: one idles out, one returns anew, one goes on from its seed, one only has a seed."""
    def arrive(*rows):
        schema = f"{KEY} string, ts timestamp, amount double"
        spark.createDataFrame([(k, at(0) + datetime.timedelta(hours=h), x) for k, h, x in rows], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    seeds = [("seeded", 100.0, 4, at(0)), ("only seed", 7.0, 1, at(1)), ("late seed", 9.0, 1, at(0)), ("lasting seed", 1.0, 1, at(0) + datetime.timedelta(hours=47))]
    spark.createDataFrame(seeds, f"{KEY} string, total_spending double, num_tx bigint, last_seen timestamp").write.parquet(f"{tmp_path}/seeds")
    arrive(("idle", 1, 5.0), ("back", 2, 6.0), ("back", 3, 1.0), ("seeded", 5, 1.0))
    arrive(("busy", 30, 1.0), ("back", 31, 2.0))
    arrive(("busy", 50, 1.0), ("late seed", 51, 2.0), ("back", 54, 8.0))
    arrive(("busy", 70, 1.0), ("busy", 71, 3.0))
    stream = stream_table(spark, f"{tmp_path}/in", 1)
    tracked = track_active(stream, "ts", "1 hour", "24 hours", stream_table(spark, f"{tmp_path}/seeds"))
    rows = []
    run_available(to_batches(tracked, lambda batch, i: rows.extend((i, *r) for r in batch.collect()), "update"), f"{tmp_path}/checkpoint")
    ended = {r[1]: r[2:4] for r in rows if r[6]}
    assert ended == {"idle": (5.0, 1), "only seed": (7.0, 1), "seeded": (101.0, 5)}
    newest = {r[1]: (r[2], r[3], r[4], r[6]) for r in sorted(rows)}
    assert newest["back"] == (10.0, 2, 8.0, False)
    assert newest["busy"] == (6.0, 4, 3.0, False) and newest["late seed"][:2] == (2.0, 1)
    alive = {k: v for k, v in newest.items() if not v[3]}
    held = {r[KEY]: (r["total_spending"], r["num_tx"], r["window_avg"], False) for r in state_snapshot(spark, f"{tmp_path}/checkpoint").collect()}
    assert held == alive and "lasting seed" in held
    with pytest.raises(ValueError, match="shorter"):
        track_active(stream, "ts", "2 hours", "1 hour")


def test_tracked_accounts_share_a_few_calls(spark, tmp_path):
    """Many accounts in few groups, one without a number, over two batches: a call and a state for each group."""
    rows = [(f"a{i % 70}" if i % 7 else None, at(i % 5), float(i)) for i in range(280)]
    frame = lambda part: spark.createDataFrame(part, f"{KEY} string, ts timestamp, amount double").coalesce(1)
    for part in (rows[:200], rows[200:]):
        frame(part).write.mode("append").parquet(f"{tmp_path}/in")
    tracked = track_active(stream_table(spark, f"{tmp_path}/in", 1), "ts", "1 hour", groups=3)
    told = []
    run_available(to_batches(tracked, lambda batch, i: told.extend((i, *r) for r in batch.collect()), "update"), f"{tmp_path}/checkpoint")
    assert spark.read.format("statestore").load(f"{tmp_path}/checkpoint").count() <= 3
    held = {r[KEY]: (r["total_spending"], r["num_tx"]) for r in state_snapshot(spark, f"{tmp_path}/checkpoint").collect()}
    wanted = {}
    for account, _, amount in rows:
        total, n = wanted.get(account, (0.0, 0))
        wanted[account] = total + amount, n + 1
    assert held == wanted
    assert {(i, account) for i, account, *_ in told} == {(int(j >= 200), r[0]) for j, r in enumerate(rows)}
    assert {r[1]: r[2:4] for r in sorted(told, key=lambda r: r[0])} == wanted


def test_active_totals_forget_closed_windows(spark, tmp_path):
    rows = [("a", at(1), 1.0), ("a", at(1), 2.0), ("a", at(5), 4.0), ("b", at(9), 8.0), (None, at(9), 16.0)]
    table = spark.createDataFrame(rows, f"{KEY} string, ts timestamp, amount double")
    files = replay(table, f"{tmp_path}/in", 3, "ts")
    stream = with_event_time(stream_table(spark, f"{tmp_path}/in", files), "ts")
    got = {}
    run_available(
        to_batches(active_totals(stream, "ts", "1 hour"), lambda b, i: got.update({(r[0], r[1].hour): r[2:] for r in b.collect()}), "update"),
        f"{tmp_path}/checkpoint",
    )
    assert got == {("a", 1): (3.0, 2), ("a", 5): (4.0, 1), ("b", 9): (8.0, 1), (None, 9): (16.0, 1)}


def test_repeated_batch_changes_nothing(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"), partitions=2)
    handle = keep_state(table, "1 hour", output=str(tmp_path / "out"))
    handle(totals(spark, ("a", at(1), 10.0, 2)), 0)
    handle(totals(spark), 1)
    news = totals(spark, ("a", at(2), 2.0, 1), ("b", at(2), 5.0, 1))
    handle(news, 2)
    once = states(table.read())
    handle(news, 2)
    assert states(table.read()) == once == {("a", 2): (12.0, 3, 2.0), ("b", 2): (5.0, 1, 5.0)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_state_survives_reopening_and_stays_bounded(spark, tmp_path):
    path = tmp_path / "state"
    for hour in range(1, 7):
        table = StateTable(spark, str(path))
        keep_state(table, "1 hour")(totals(spark, ("a", at(hour), 1.0, 1)), hour)
    assert states(StateTable(spark, str(path)).read()) == {("a", 6): (6.0, 6, 1.0)}
    assert len([p for p in path.iterdir() if p.name.startswith("folder=")]) == 3


def test_state_without_its_checkpoint_is_refused(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    keep_state(table, "1 hour")(totals(spark, ("a", at(1), 1.0, 1)), 4)
    with pytest.raises(ValueError, match="batch 4"):
        keep_state(table, "1 hour")(totals(spark, ("a", at(1), 1.0, 1)), 0)


def test_windows_are_listed_after_the_last_shuffle(spark, small):
    """Window totals are shuffled by window and account, then by account, and that is all."""
    payments = spark.read.parquet(f"{small}/orders.parquet").select(
        F.col("o_custkey").cast("string").alias(KEY),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("amount"),
    )
    rows = advance_state(
        empty_state(spark), window_totals(payments, "ts", "30 days"), "30 days", F.lit(at(1))
    )
    assert shuffles(rows) == 2


def test_state_partition_count(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), partitions=3)
    rows = [(f"k{i}", at(1), 1.0, 1) for i in range(50)]
    keep_state(table, "1 hour")(totals(spark, *rows), 0)
    files = list((tmp_path / "s" / "folder=1").glob("*.parquet"))
    assert len(files) == 3


def test_late_rows_are_dropped_and_open_windows_wait(spark, tmp_path):
    schema = "ts timestamp, kind string"
    folder = str(tmp_path / "in")

    def arrive(*hours):
        rows = [(at(h), "x") for h in hours]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = with_event_time(read_stream(spark, "parquet", folder, schema), "ts")
        counts = window_counts(stream, "ts", "1 hour", "kind")
        run_available(to_files(counts, str(tmp_path / "out")), str(tmp_path / "cp"))
        rows = spark.read.schema(counts.schema).parquet(str(tmp_path / "out")).collect()
        return sorted((r["window_start"].hour, r["count"]) for r in rows)

    assert arrive(1, 1, 5) == [(1, 2)]
    assert arrive(2, 8) == [(1, 2), (5, 1)]


def test_restart_reads_new_files_once(spark, tmp_path):
    folder = str(tmp_path / "in")
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).write.mode("append").parquet(folder)
        stream = read_stream(spark, "parquet", folder, "id bigint")
        run_available(to_files(stream, str(tmp_path / "out")), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["id"] for r in got.collect()) == list(range(30))


def test_failed_batch_is_run_again(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(10).write.parquet(folder)
    save, calls = batch_folder(str(tmp_path / "out")), []

    def flaky(batch, batch_id):
        save(batch, batch_id)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost")

    for attempt in range(2):
        stream = read_stream(spark, "parquet", folder, "id bigint")
        writer = to_batches(stream, flaky)
        if attempt == 0:
            with pytest.raises(PySparkException):
                run_available(writer, str(tmp_path / "cp"))
        else:
            run_available(writer, str(tmp_path / "cp"))
    assert calls == [0, 0]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_replay_fills_the_batches(spark, tmp_path):
    path, sizes = str(tmp_path / "in"), []
    files = replay(spark.range(400), path, 5)
    stream = stream_table(spark, path, files)
    run_available(to_batches(stream, lambda b, i: sizes.append(b.count())), str(tmp_path / "cp"))
    assert len(sizes) == 5 and sum(sizes) == 400 and min(sizes) > 0


def test_empty_batch_reaches_the_sink(spark, small, tmp_path):
    seen = []
    stream = with_event_time(stream_table(spark, f"{small}/events.parquet"), "ts")
    counts = window_counts(stream, "ts", "1 day", "event_type")
    run_available(to_batches(counts, lambda b, i: seen.append(b.isEmpty())), str(tmp_path / "cp"))
    assert seen == [True, False]


def test_processing_time_trigger_and_monitoring(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(10).write.parquet(folder)
    log = ProgressFiles(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        stream = read_stream(spark, "parquet", folder, "id bigint", arrival_time="at")
        query = start(to_files(stream, str(tmp_path / "out")).queryName("watched"), str(tmp_path / "cp"), "1 second")
        query.processAllAvailable()
        assert query.isActive and describe(query)["is_active"]
        assert query in spark.streams.active or query.id in [q.id for q in spark.streams.active]
        assert finish(query, timeout=1.0) is False
        facts = describe(query)
        assert facts["exception"] is None and not facts["is_active"] and facts["name"] == "watched"
        assert log.wait(query)
        assert log.table().agg(F.sum("input_rows")).first()[0] == 10
        assert log.ended[str(query.runId)] is None
    finally:
        spark.streams.removeListener(log)


def test_progress_of_more_batches_than_spark_keeps(spark, tmp_path):
    """A hundred and thirty batches, and a second run of the same query, add up; files stay few."""
    folder, log = str(tmp_path / "in"), ProgressFiles(spark, str(tmp_path / "progress"), rows_per_file=50)
    spark.range(130).repartition(130, "id").sortWithinPartitions("id").write.option("maxRecordsPerFile", 1).parquet(folder)
    spark.streams.addListener(log)
    try:
        for _ in range(2):
            stream = read_stream(spark, "parquet", folder, "id bigint", maxFilesPerTrigger=1)
            query = run_available(to_files(stream, str(tmp_path / "out")), str(tmp_path / "cp"))
            assert log.wait(query)
            spark.range(130, 135).coalesce(1).write.mode("append").parquet(folder)
    finally:
        spark.streams.removeListener(log)
    assert log.table().agg(F.sum("input_rows"), F.count_distinct("run_id")).first()[:] == (135, 2)
    assert len(query.recentProgress) <= 100 and len(list((tmp_path / "progress").glob("*.json"))) == 4


def test_keyed_table_belongs_to_its_stream(spark, tmp_path):
    """A lost checkpoint is noticed before an old batch is overwritten; a kept one goes on."""
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")

    def run(first, last, checkpoint):
        spark.range(first, last).select("id", (F.col("id") * 10).alias("v")).coalesce(1).write.mode("append").parquet(folder)
        stream = read_stream(spark, "parquet", folder, "id bigint, v bigint", maxFilesPerTrigger=1)
        run_available(to_batches(stream, lambda b, i: upsert_batch(b, i, table, ["id"])), str(tmp_path / checkpoint))

    run(0, 3, "cp")
    run(2, 5, "cp")
    with pytest.raises(PySparkException, match="belongs to stream"):
        run(5, 6, "other")
    assert sorted(r["id"] for r in read_upserted(spark, table, ["id"]).collect()) == [0, 1, 2, 3, 4]
    run(6, 7, "cp")
    assert read_upserted(spark, table, ["id"]).count() == 7
    sink = batch_folder(str(tmp_path / "batches"))
    run_available(to_batches(read_stream(spark, "parquet", folder, "id bigint"), sink), str(tmp_path / "cp2"))
    with pytest.raises(PySparkException, match="belongs to stream"):
        run_available(to_batches(read_stream(spark, "parquet", folder, "id bigint"), sink), str(tmp_path / "cp3"))


@pytest.mark.parametrize("how", ["inner", "left", "right"])
@pytest.mark.parametrize("cell_bands", [1, 8])
def test_join_by_time_cells_equals_the_join(spark, how, cell_bands):
    """On tables, where both can be asked: bands across cell edges, repeated rows, null keys and times."""
    time = F.timestamp_seconds(F.col("id") * 37 % 5000)
    key = F.when(F.col("id") % 11 != 0, F.col("id") % 3)
    left = spark.range(300).select("id", key.alias("k"), F.when(F.col("id") % 13 != 0, time).alias("lt")).unionByName(
        spark.range(5).select("id", F.lit(1).cast("long").alias("k"), F.timestamp_seconds(F.lit(-70)).alias("lt")))
    right = spark.range(200).select(F.col("id").alias("rid"), key.alias("rk"), time.alias("rt"))
    near = F.expr("k = rk and rt >= lt and rt <= lt + interval 90 seconds")
    wanted = left.join(right, near, {"inner": "inner", "left": "left_outer", "right": "right_outer"}[how])
    got = stream_join(left, right, "k", "rk", "lt", "rt", "90 seconds", how, cell_bands)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))


def test_text_stream_of_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\n")
    stream = stream_lines(spark, str(tmp_path / "in"), files_per_trigger=1)
    run_available(to_files(stream, str(tmp_path / "out"), "text"), str(tmp_path / "cp"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["one", "two"]


def test_queue_needs_its_connector(spark):
    """The connector is a jar the user adds; without it Spark says so."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        stream_queue(spark, "nowhere:9092", "transaction")


def test_work_folder_is_fresh(spark):
    assert work_folder(spark, "a") != work_folder(spark, "a")
