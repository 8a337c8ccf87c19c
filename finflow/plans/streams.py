"""Streams run to the end of what is there, and their results as tables (STM, JON-14 to 16, SNK-05 to 07).

A stream that waits for a watermark leaves its last windows open; the SQL then
asks for windows that end before the newest time less the delay.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.operators.aggregates import group_count
from finflow.operators.transactions import parse_lines, valid
from finflow.plans.inputs import TRANSACTIONS, transaction_lines
from finflow.plans.registry import query
from finflow.session import work_folder
from finflow.sources.keyed import read_upserted, upsert_batch
from finflow.streaming.joins import enrich, stream_join
from finflow.streaming.monitor import ProgressFiles
from finflow.streaming.run import batch_folder, finish, run_available, start, to_batches, to_files
from finflow.streaming.sources import (
    read_stream, replay, stream_lines, stream_table,
)
from finflow.streaming.windows import (
    cogroup_windows, sliding_records, sliding_totals, slice_archive, window_aggregate, window_counts, with_event_time,
)


def _events(t):
    return stream_table(t.spark, t.path("events"))


def _timed_events(t, delay="10 seconds"):
    return with_event_time(_events(t), "ts", delay)


def _collected(t, stream):
    """Run ``stream`` into files and read them."""
    out = work_folder(t.spark, "stream")
    run_available(to_files(stream, f"{out}/rows"), f"{out}/checkpoint")
    return t.spark.read.schema(stream.schema).parquet(f"{out}/rows")


def _plain_times(df):
    """Window bounds without a zone, as the given tables have them."""
    return df.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end") if c in df.columns}
    )


_CLOSED = "window_end <= (select max(ts) - interval 10 seconds from events)"


def _tumbling(length, columns, keys):
    named = ", ".join(keys)
    return f"""
    select * from (
        select time_bucket(interval {length}, ts, timestamp '1970-01-01') as window_start,
               time_bucket(interval {length}, ts, timestamp '1970-01-01') + interval {length} as window_end,
               {named}, {columns}
        from events group by 1, 2, {named})"""


@query(
    "snk_05_stream_to_files",
    "select event_type || ':' || event_id as value from events",
)
def _(t):
    out = work_folder(t.spark, "text")
    lines = _events(t).select(F.concat_ws(":", "event_type", F.col("event_id").cast("string")).alias("value"))
    run_available(to_files(lines, f"{out}/rows", "text"), f"{out}/checkpoint")
    return t.spark.read.text(f"{out}/rows")


@query(
    "snk_06_stream_to_keyed_table",
    """select id, account_number, amount, date::varchar as date, description from (""" + TRANSACTIONS + """)
       where id in (select o_orderkey from orders where o_orderstatus <> 'P')""",
)
def _(t):
    """Lines arrive, partly twice; the table holds each valid transaction once."""
    out = work_folder(t.spark, "keyed")
    lines = transaction_lines(t)
    lines.unionAll(lines.where(F.col("value").contains("HIGH"))).write.text(f"{out}/lines")
    parsed = valid(parse_lines(stream_lines(t.spark, f"{out}/lines")))

    def save(batch, batch_id):
        upsert_batch(batch, batch_id, f"{out}/table", ["id"])

    run_available(to_batches(parsed, save), f"{out}/checkpoint")
    return read_upserted(t.spark, f"{out}/table", ["id"]).withColumn("date", F.col("date").cast("string"))


@query(
    "snk_07_custom_batch_sink",
    "select event_type, count(*) as n from events group by event_type",
)
def _(t):
    out = work_folder(t.spark, "sink")
    save = batch_folder(f"{out}/rows")

    def sink(batch, batch_id):
        save(group_count(batch, "event_type", out="n"), batch_id)

    run_available(to_batches(_events(t), sink), f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/rows").groupBy("event_type").agg(F.sum("n").alias("n"))


@query("stm_01_stream_source", "select event_id, value, true as has_arrival_time from events")
def _(t):
    schema = t.events.schema
    folder = work_folder(t.spark, "source")
    t.events.write.parquet(folder)
    stream = read_stream(t.spark, "parquet", folder, schema, arrival_time="arrived")
    rows = _collected(t, stream)
    return rows.select("event_id", "value", F.col("arrived").isNotNull().alias("has_arrival_time"))


@query(
    "stm_04_replay_source",
    "select event_type, count(*) as n, round(sum(value), 2) as total, true as six_batches"
    " from events group by event_type",
)
def _(t):
    """Events in six equal micro-batches."""
    out = work_folder(t.spark, "replay")
    files = replay(t.events.select("event_id", "event_type", "value"), f"{out}/files", 6)
    stream = stream_table(t.spark, f"{out}/files", files)
    run_available(to_batches(stream, batch_folder(f"{out}/rows")), f"{out}/checkpoint")
    rows = t.spark.read.parquet(f"{out}/rows")
    batches = rows.agg(F.count_distinct("batch_id")).scalar()
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("value"), 2).alias("total"),
    ).withColumn("six_batches", batches == 6)


@query(
    "stm_05_watermark_drops_late_rows",
    _tumbling("1 day", "count(*) as count", ["event_type"])
    + f" where window_start >= timestamp '2024-01-10' and {_CLOSED}",
)
def _(t):
    """Days from January 10 first; what comes afterwards for earlier days is too late."""
    out = work_folder(t.spark, "late")
    early = F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")
    for rows in (t.events.where(~early), t.events.where(early)):
        rows.write.mode("append").parquet(f"{out}/events")
        stream = read_stream(t.spark, "parquet", f"{out}/events", rows.schema)
        counts = window_counts(with_event_time(stream, "ts"), "ts", "1 day", "event_type")
        run_available(to_files(counts, f"{out}/rows"), f"{out}/checkpoint")
    return _plain_times(t.spark.read.schema(counts.schema).parquet(f"{out}/rows"))


@query(
    "stm_06_tumbling_window_count",
    _tumbling("1 hour", "count(*) as count", ["event_type"]) + f" where {_CLOSED}",
)
def _(t):
    return _plain_times(_collected(t, window_counts(_timed_events(t), "ts", "1 hour", "event_type")))


_SLIDING = """
    select window_start, window_start + interval 3 hours as window_end, {keys}, {columns}
    from (select *, time_bucket(interval 1 hour, ts) - to_hours(back) as window_start
          from events, (values (0), (1), (2)) v(back))
    where window_start + interval 3 hours <= (select max(ts) - interval 10 seconds from events)
    group by window_start, {keys}"""


@query("stm_07_sliding_window_count", _SLIDING.format(keys="event_type", columns="count(*) as count"))
def _(t):
    counts = window_counts(_timed_events(t), "ts", "3 hours", "event_type", slide="1 hour")
    return _plain_times(_collected(t, counts))


@query(
    "stm_08_append_mode",
    _tumbling("1 day", "count(*) as count, round(sum(value), 2) as total", ["event_type"]) + f" where {_CLOSED}",
)
def _(t):
    totals = window_aggregate(
        _timed_events(t), "ts", "1 day", ["event_type"],
        {"count": F.count(F.lit(1)), "total": F.round(F.sum("value"), 2)},
    )
    return _plain_times(_collected(t, totals))


@query(
    "stm_09_update_mode",
    _tumbling("1 day", "count(*) as count", ["event_type"]),
)
def _(t):
    """Changed windows are upserted, so open ones are there too; events arrive in order of time."""
    out = work_folder(t.spark, "update")
    files = replay(t.events.select("ts", "event_type"), f"{out}/files", 3, "ts")
    timed = with_event_time(stream_table(t.spark, f"{out}/files", files), "ts")
    counts = window_counts(timed, "ts", "1 day", "event_type")

    def save(batch, batch_id):
        upsert_batch(batch, batch_id, f"{out}/table", ["window_start", "event_type"])

    run_available(to_batches(counts, save, "update"), f"{out}/checkpoint")
    return _plain_times(read_upserted(t.spark, f"{out}/table", ["window_start", "event_type"]))


@query(
    "stm_09_complete_mode",
    "select event_type, count(*) as count from events group by event_type",
)
def _(t):
    """The whole result replaces itself in every batch."""
    out = work_folder(t.spark, "complete")
    files = replay(t.events.select("event_type"), f"{out}/files", 3)
    counts = group_count(stream_table(t.spark, f"{out}/files", files), "event_type")

    def save(batch, _):
        batch.write.mode("overwrite").parquet(f"{out}/table")

    run_available(to_batches(counts, save, "complete"), f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/table")


@query("stm_10_processing_time_trigger", "select event_id, event_type from events")
def _(t):
    """A batch every second until all there is has been read; then the query is stopped."""
    out = work_folder(t.spark, "trigger")
    stream = _events(t).select("event_id", "event_type")
    running = start(to_files(stream, f"{out}/rows"), f"{out}/checkpoint", every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return t.spark.read.schema(stream.schema).parquet(f"{out}/rows")


@query(
    "stm_28_start_await_stop",
    "select event_type, count(*) as n, true as ended, false as is_active from events group by event_type",
)
def _(t):
    out = work_folder(t.spark, "await")
    running = start(to_files(_events(t).select("event_type"), f"{out}/rows"), f"{out}/checkpoint")
    ended = finish(running)
    return t.spark.read.parquet(f"{out}/rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(ended).alias("ended"),
        F.lit(running.isActive).alias("is_active"),
    )


@query(
    "stm_11_counts_per_batch",
    "select event_type as value, count(*) as count, (select count(*) from events) as all_rows"
    " from events group by event_type",
)
def _(t):
    """Count and count by value of each micro-batch, tagged with it; then added up."""
    out = work_folder(t.spark, "counts")
    files = replay(t.events.select("event_type"), f"{out}/files", 4)
    values, sizes = batch_folder(f"{out}/values"), batch_folder(f"{out}/sizes")

    def count(batch, batch_id):
        by_value = group_count(batch.withColumnRenamed("event_type", "value"), "value")
        values(by_value, batch_id)
        sizes(batch.agg(F.count(F.lit(1)).alias("rows")), batch_id)

    run_available(to_batches(stream_table(t.spark, f"{out}/files", files), count), f"{out}/checkpoint")
    all_rows = t.spark.read.parquet(f"{out}/sizes").agg(F.sum("rows")).scalar()
    by_value = t.spark.read.parquet(f"{out}/values").groupBy("value").agg(F.sum("count").alias("count"))
    return by_value.withColumn("all_rows", all_rows)


@query(
    "stm_12_map_filter_flatmap_reduce",
    """select word, count(*) as count, sum(length(word))::bigint as letters
       from (select unnest(string_split_regex(lower(text), '[ \n]+')) as word from documents where lang = 'en')
       where word <> '' group by word""",
)
def _(t):
    """Words of the English documents."""
    out = work_folder(t.spark, "words")
    documents = stream_table(t.spark, t.path("documents")).where("lang = 'en'")
    words = documents.select(F.explode(F.split(F.lower("text"), "[ \n]+")).alias("word")).where("word <> ''")
    counts = words.groupBy("word").agg(
        F.count(F.lit(1)).alias("count"), F.sum(F.length("word")).alias("letters")
    )

    def save(batch, _):
        batch.write.mode("overwrite").parquet(f"{out}/table")

    run_available(to_batches(counts, save, "complete"), f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/table")


@query(
    "stm_13_union_of_streams",
    "select c_custkey as key, c_name as name from customer union all select s_suppkey, s_name from supplier",
)
def _(t):
    customers = stream_table(t.spark, t.path("customer")).select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name")
    )
    suppliers = stream_table(t.spark, t.path("supplier")).select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return _collected(t, customers.union(suppliers))


@query(
    "stm_14_transform",
    """select event_id, event_type, value, value > 50 as is_large from events where event_type <> 'error'""",
)
def _(t):
    def marked(df):
        return df.select("event_id", "event_type", "value", (F.col("value") > 50).alias("is_large"))

    def without_errors(df):
        return df.where("event_type <> 'error'")

    return _collected(t, _events(t).transform(without_errors).transform(marked))


@query(
    "stm_15_time_slice",
    """select event_id, ts, value from events
       where ts >= timestamp '2024-01-08 06:00:00' and ts < timestamp '2024-01-20 18:30:00'""",
)
def _(t):
    """The stream is archived by day; a slice reads its days only."""
    out = work_folder(t.spark, "archive")
    stream = _events(t).select("event_id", "ts", "value", F.to_date("ts").alias("day"))
    run_available(to_files(stream, f"{out}/rows", partition_by=("day",)), f"{out}/checkpoint")
    archive = t.spark.read.parquet(f"{out}/rows")
    return slice_archive(archive, "2024-01-08 06:00:00", "2024-01-20 18:30:00").drop("day")


@query(
    "stm_16_keyed_aggregates",
    """select user_id, count(*) as n, round(sum(value), 2) as total, min(value) as least, max(value) as most
       from events group by user_id""",
)
def _(t):
    out = work_folder(t.spark, "keyed")
    per_user = _events(t).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("value"), 2).alias("total"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
    )

    def save(batch, batch_id):
        upsert_batch(batch, batch_id, f"{out}/table", ["user_id"])

    run_available(to_batches(per_user, save, "update"), f"{out}/checkpoint")
    return read_upserted(t.spark, f"{out}/table", ["user_id"])


@query(
    "stm_17_windowed_records",
    """select user_id, event_id, value, time_bucket(interval 10 seconds, ts, timestamp '1970-01-01') as window_start,
              time_bucket(interval 10 seconds, ts, timestamp '1970-01-01') + interval 10 seconds as window_end
       from events""",
)
def _(t):
    """Keyed records with the ten-second window they belong to; nothing is grouped yet."""
    timed = _timed_events(t).select(
        "user_id", "event_id", "value", F.window("ts", "10 seconds").alias("w")
    )
    rows = timed.select(
        "user_id", "event_id", "value",
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
    )
    return _plain_times(_collected(t, rows))


@query(
    "stm_19_incremental_sliding_totals",
    _SLIDING.format(keys="user_id", columns="round(sum(value), 2) as total, count(value)::bigint as count"),
)
def _(t):
    totals = sliding_totals(_timed_events(t), "ts", "3 hours", "1 hour", ["user_id"], "value")
    return _plain_times(_collected(t, totals)).withColumn("total", F.round("total", 2))


_RECORDS = _SLIDING.replace("select *, time_bucket", "select *, (event_id % 2)::integer as part, time_bucket").format(
    keys="user_id, part", columns="string_agg(event_id::varchar, ',' order by event_id) as events"
)


@query("stm_19_sliding_records", _RECORDS)
def _(t):
    """The records of every window themselves: events of three hours each hour, by user, in two lists."""
    rows = sliding_records(
        _timed_events(t), "ts", "3 hours", "1 hour", ["user_id"], F.col("event_id"), part=F.col("event_id") % 2
    )
    listed = rows.select("window_start", "window_end", "user_id", "part", F.array_join(F.col("records").cast("array<string>"), ",").alias("events"))
    return _plain_times(_collected(t, listed))


@query(
    "stm_27_progress_table",
    "select count(*) as input_rows, true as has_batches, true as ended_well from events",
)
def _(t):
    """Rows read by the query, by its own account of every batch, written as it went."""
    out = work_folder(t.spark, "progress")
    log = ProgressFiles(t.spark, f"{out}/progress")
    t.spark.streams.addListener(log)
    try:
        files = replay(t.events.select("event_id"), f"{out}/files", 5)
        stream = stream_table(t.spark, f"{out}/files", files)
        ran = run_available(to_files(stream, f"{out}/rows"), f"{out}/checkpoint")
        complete = log.wait(ran)
    finally:
        t.spark.streams.removeListener(log)
    return log.table().agg(
        F.sum("input_rows").alias("input_rows"),
        (F.count("batch_id") > 0).alias("has_batches"),
        F.lit(complete and ran.exception() is None).alias("ended_well"),
    )


@query(
    "jon_14_stream_static_join",
    "select o_orderkey, c_custkey, c_name from orders join customer on o_custkey = c_custkey",
)
def _(t):
    orders = stream_table(t.spark, t.path("orders")).select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey")
    )
    return _collected(t, enrich(orders, t.customer.select("c_custkey", "c_name"), "c_custkey"))


def _visits(t):
    clicks = _timed_events(t, "10 minutes").where("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("clicker"), F.col("ts").alias("clicked")
    )
    purchases = _timed_events(t, "10 minutes").where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer"), F.col("ts").alias("bought")
    )
    return clicks, purchases


def _visit_join(t, how):
    clicks, purchases = _visits(t)
    joined = stream_join(clicks, purchases, "clicker", "buyer", "clicked", "bought", "2 hours", how)
    return _collected(t, joined.select("click_id", "clicker", "purchase_id", "buyer"))


_VISITS = """
    with c as (select event_id as click_id, user_id as clicker, ts as clicked from events where event_type = 'click'),
         p as (select event_id as purchase_id, user_id as buyer, ts as bought from events where event_type = 'purchase'),
         mark as (select least((select max(clicked) from c), (select max(bought) from p))
                         - interval 10 minutes as w),
         pairs as (select * from c join p on clicker = buyer and bought >= clicked
                                         and bought <= clicked + interval 2 hours)
    select click_id, clicker, purchase_id, buyer from pairs"""

_LEFT_ONLY = """
    union all select click_id, clicker, null, null from c
    where click_id not in (select click_id from pairs) and clicked + interval 2 hours < (select w from mark)"""

_RIGHT_ONLY = """
    union all select null, null, purchase_id, buyer from p
    where purchase_id not in (select purchase_id from pairs) and bought < (select w from mark)"""


@query("jon_15_stream_stream_inner", _VISITS)
def _(t):
    """Purchases within two hours of a click of the same user."""
    return _visit_join(t, "inner")


@query("jon_16_stream_stream_left_outer", _VISITS + _LEFT_ONLY)
def _(t):
    """A click is reported alone once no purchase can follow any more."""
    return _visit_join(t, "left")


@query("jon_16_stream_stream_right_outer", _VISITS + _RIGHT_ONLY)
def _(t):
    return _visit_join(t, "right")


@query("jon_16_stream_stream_full_outer", _VISITS + _LEFT_ONLY + _RIGHT_ONLY)
def _(t):
    return _visit_join(t, "full")


@query(
    "jon_13_cogroup_of_streams",
    """with clicks as (select user_id, time_bucket(interval 1 day, ts, timestamp '1970-01-01') as d, count(*) as n
                       from events where event_type = 'click' group by 1, 2),
            buys as (select user_id, time_bucket(interval 1 day, ts, timestamp '1970-01-01') as d, count(*) as n,
                            max(value) as most
                     from events where event_type = 'purchase' group by 1, 2),
            mark as (select least(max(ts) filter (event_type = 'click'), max(ts) filter (event_type = 'purchase'))
                            - interval 10 minutes as w from events)
       select d as window_start, d + interval 1 day as window_end, user_id, coalesce(clicks.n, 0) as clicks,
              coalesce(buys.n, 0) as purchases, most
       from clicks full join buys using (d, user_id), mark where d + interval 1 day <= w""",
)
def _(t):
    """Clicks and purchases of each user and day, from a stream each; days that only one has are there too."""
    rows = cogroup_windows(
        _timed_events(t, "10 minutes").where("event_type = 'click'"),
        _timed_events(t, "10 minutes").where("event_type = 'purchase'"),
        "ts", "ts", "1 day", ["user_id"],
        {"n_clicks": F.count(F.lit(1))},
        {"n_purchases": F.count(F.lit(1)), "most": F.max("value")},
        {"clicks": F.coalesce("n_clicks", F.lit(0)), "purchases": F.coalesce("n_purchases", F.lit(0)), "most": F.col("most")},
    )
    return _plain_times(_collected(t, rows))
