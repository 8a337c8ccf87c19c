"""Account state and the fraud pipeline, streamed and on tables (STM-18 to 26, UDF-04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.operators.transactions import mark_possible_fraud
from finflow.plans.inputs import steady
from finflow.plans.registry import query
from finflow.session import work_folder
from finflow.sources.keyed import read_upserted, upsert_batch
from finflow.streaming.fraud import fraud_on_table, run_fraud_stream
from finflow.streaming.run import run_available, to_batches, to_files
from finflow.streaming.sources import read_stream, replay, stream_lines, stream_table
from finflow.streaming.state import (
    KEY, StateTable, advance_state, empty_state, keep_state, last_window_end, window_totals,
)
from finflow.streaming.tracked import active_totals, state_snapshot, track_active
from finflow.streaming.windows import with_event_time

LENGTH = "30 days"
LIVE_FROM = "2000-01-01"
SECOND_ARRIVAL_FROM = "2000-09-01"


def payments(orders):
    """Orders as transactions with the event time ``ts``."""
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias(KEY),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("amount"),
    )


def _live(t):
    return t.orders.where(F.col("o_orderdate") >= F.lit(LIVE_FROM).cast("timestamp_ntz"))


def _past(t):
    return t.orders.where(F.col("o_orderdate") < F.lit(LIVE_FROM).cast("timestamp_ntz"))


def history(t):
    """Average of each account before the live part."""
    return payments(_past(t)).groupBy(KEY).agg(F.avg("amount").alias("average_transaction"))


def _run_state(t, initial=None, timeout=None, partitions=None):
    """Live payments in two arrivals, each processed by its own run of the same stream.

    Returns the state table and the folder with the state after every window.
    """
    out = work_folder(t.spark, "state")
    table = StateTable(t.spark, f"{out}/state", initial, partitions=partitions)
    live = _live(t)
    later = F.col("o_orderdate") >= F.lit(SECOND_ARRIVAL_FROM).cast("timestamp_ntz")
    handle = keep_state(table, LENGTH, timeout, output=f"{out}/windows")
    for arrival in (live.where(~later), live.where(later)):
        arrival.write.mode("append").parquet(f"{out}/orders")
        stream = payments(read_stream(t.spark, "parquet", f"{out}/orders", live.schema))
        totals = window_totals(with_event_time(stream, "ts"), "ts", LENGTH)
        run_available(to_batches(totals, handle), f"{out}/checkpoint")
    return table, f"{out}/windows"


def _shown(states):
    """State rows as reported: rounded, and times without a zone."""
    return states.select(
        KEY,
        F.round("total_spending", 2).alias("total_spending"),
        "num_tx",
        steady("window_avg").alias("window_avg"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
    )


_WINDOWS = f"""
    with tx as (select o_custkey::varchar as account_number, o_orderdate as ts, o_totalprice as amount from orders
                where o_orderdate >= timestamp '{LIVE_FROM}'),
         totals as (select account_number, sum(amount) as s, count(*) as n,
                           time_bucket(interval 30 days, ts, timestamp '1970-01-01') + interval 30 days as window_end
                    from tx group by 1, 4),
         closed as (select * from totals
                    where window_end <= (select max(ts) - interval 10 seconds from tx)),
         grid as (select account_number, unnest(generate_series(min(window_end),
                         (select max(window_end) from closed), interval 30 days)) as window_end
                  from closed group by account_number),
         states as (select account_number, window_end, round(sum(coalesce(s, 0)) over w, 2) as total_spending,
                           (sum(coalesce(n, 0)) over w)::bigint as num_tx,
                           round(case when n > 0 then s / n else 0 end + 1e-6, 4) as window_avg
                    from grid left join closed using (account_number, window_end)
                    window w as (partition by account_number order by window_end
                                 rows between unbounded preceding and current row))"""

_ALL_STATES = _WINDOWS + " select * from states"
_LAST_STATES = _WINDOWS + " select * from states where window_end = (select max(window_end) from closed)"


@query("stm_18_state_every_window", _ALL_STATES)
def _(t):
    """Every known account after every window, streamed in two arrivals."""
    _, windows = _run_state(t)
    return _shown(t.spark.read.parquet(windows))


@query("stm_18_state_on_table", _ALL_STATES)
def _(t):
    """The same states for a table."""
    live = payments(_live(t))
    newest = live.agg(F.max("ts") - F.expr("interval 10 seconds")).scalar()
    closed = window_totals(live, "ts", LENGTH).where(F.col("window_end") <= newest)
    upto = last_window_end(live, "ts", LENGTH, newest)
    return _shown(advance_state(empty_state(t.spark), closed, LENGTH, upto))


@query("stm_21_state_snapshot", _LAST_STATES)
def _(t):
    table, _ = _run_state(t)
    return _shown(table.read())


@query(
    "stm_24_state_partitions",
    _WINDOWS + """ select 3::bigint as partitions, count(*) as accounts, sum(num_tx)::bigint as transactions
                   from states where window_end = (select max(window_end) from closed)""",
)
def _(t):
    """The state written in three partitions by account."""
    table, _ = _run_state(t, partitions=3)
    return table.read().select("*", F.input_file_name().alias("file")).agg(
        F.count_distinct("file").alias("partitions"),
        F.count(F.lit(1)).alias("accounts"),
        F.sum("num_tx").alias("transactions"),
    )


@query(
    "stm_22_initial_state",
    _WINDOWS + """,
         past as (select o_custkey::varchar as account_number, sum(o_totalprice) as s, count(*) as n from orders
                  where o_orderdate < timestamp '2000-01-01' group by 1),
         live as (select account_number, sum(s) as s, sum(n) as n,
                         sum(s) filter (window_end = u) / sum(n) filter (window_end = u) as window_avg
                  from closed, (select max(window_end) as u from closed) group by 1)
    select account_number, round(coalesce(past.s, 0) + coalesce(live.s, 0), 2) as total_spending,
           (coalesce(past.n, 0) + coalesce(live.n, 0))::bigint as num_tx,
           round(coalesce(window_avg, 0) + 1e-6, 4) as window_avg,
           (select max(window_end) from closed) as window_end
    from past full join live using (account_number)""",
)
def _(t):
    """The totals before the live part are there from the start."""
    initial = payments(_past(t)).groupBy(KEY).agg(
        F.sum("amount").alias("total_spending"),
        F.count("amount").alias("num_tx"),
        F.lit(0.0).alias("window_avg"),
        F.lit(None).cast("timestamp").alias("window_end"),
        F.max("ts").alias("last_seen"),
    )
    table, _ = _run_state(t, initial)
    return _shown(table.read())


@query(
    "stm_23_idle_timeout",
    f"""{_WINDOWS.rsplit("states as", 1)[0]}
         gaps as (select *, window_end - interval 30 days - interval 90 days >
                            lag(window_end) over (partition by account_number order by window_end) as returns
                  from closed),
         lives as (select *, coalesce(sum(returns::integer) over (partition by account_number order by window_end), 0)
                             as life from gaps),
         last_life as (select account_number, life, sum(s) as s, sum(n) as n, max(window_end) as seen,
                              arg_max(s / n, window_end) as newest_avg from lives group by 1, 2
                       qualify row_number() over (partition by account_number order by life desc) = 1)
    select account_number, round(s, 2) as total_spending, n::bigint as num_tx,
           round(case when seen = u then newest_avg else 0 end + 1e-6, 4) as window_avg, u as window_end
    from last_life, (select max(window_end) as u from closed)
    where u - interval 90 days <= seen""",
)
def _(t):
    """Accounts idle for over 90 days are forgotten; who returns starts from nothing."""
    table, _ = _run_state(t, timeout="90 days")
    return _shown(table.read())


def _event_payments(events):
    return events.select(
        F.col("user_id").cast("string").alias(KEY),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("amount"),
    )


@query(
    "stm_20_state_of_active_accounts",
    """with w as (select user_id::varchar as account_number, sum(value) as s, count(*) as n,
                         time_bucket(interval 1 day, ts, timestamp '1970-01-01') as start from events group by 1, 4)
       select account_number, round(sum(s), 2) as total_spending, sum(n)::bigint as num_tx,
              round(arg_max(s / n, start) + 1e-6, 4) as window_avg
       from w group by account_number""",
)
def _(t):
    """Totals of accounts with news, events in four micro-batches in order of time: a native streaming aggregate."""
    out = work_folder(t.spark, "tracked")
    files = replay(t.events.select("user_id", "ts", "value"), f"{out}/files", 4, "ts")
    stream = with_event_time(_event_payments(stream_table(t.spark, f"{out}/files", files)), "ts")

    def save(batch, batch_id):
        upsert_batch(batch, batch_id, f"{out}/table", [KEY, "window_start"])

    run_available(to_batches(active_totals(stream, "ts", "1 day"), save, "update"), f"{out}/checkpoint")
    return read_upserted(t.spark, f"{out}/table", [KEY, "window_start"]).groupBy(KEY).agg(
        F.round(F.sum("spent"), 2).alias("total_spending"),
        F.sum("n").alias("num_tx"),
        steady(F.max_by(F.col("spent") / F.col("n"), "window_start")).alias("window_avg"),
    )


SEEDED_TO = "2024-01-12"
PATIENCE = "2 days"


def _run_seeded(t):
    """Events from ``SEEDED_TO`` on, in five micro-batches in order of time, on state seeded with those before."""
    out = work_folder(t.spark, "seeded")
    events, start = t.events.select("user_id", "ts", "value"), F.lit(SEEDED_TO).cast("timestamp_ntz")
    past = _event_payments(events.where(F.col("ts") < start)).groupBy(KEY).agg(
        F.sum("amount").alias("total_spending"), F.count("amount").alias("num_tx"), F.max("ts").alias("last_seen")
    )
    past.write.parquet(f"{out}/seeds")
    files = replay(events.where(F.col("ts") >= start), f"{out}/files", 5, "ts")
    stream = _event_payments(stream_table(t.spark, f"{out}/files", files))
    tracked = track_active(stream, "ts", "1 day", PATIENCE, stream_table(t.spark, f"{out}/seeds"))

    def save(batch, batch_id):
        upsert_batch(batch, batch_id, f"{out}/table", [KEY])

    run_available(to_batches(tracked, save, "update"), f"{out}/checkpoint")
    return out


def _shown_tracked(states):
    return states.select(
        KEY,
        F.round("total_spending", 2).alias("total_spending"),
        "num_tx",
        steady("window_avg").alias("window_avg"),
        F.col("last_seen").cast("timestamp_ntz").alias("last_seen"),
    )


_SEEDED = f"""
    with marks as (select user_id::varchar as account_number, ts, value as s, 1 as n,
                          time_bucket(interval 1 day, ts, timestamp '1970-01-01') as start
                   from events where ts >= timestamp '{SEEDED_TO}'
                   union all
                   select user_id::varchar, max(ts), sum(value), count(*), null
                   from events where ts < timestamp '{SEEDED_TO}' group by 1),
         gaps as (select *, ts - lag(ts) over w > interval {PATIENCE} as fresh from marks
                  window w as (partition by account_number order by ts)),
         lives as (select *, sum(coalesce(fresh, false)::integer) over (partition by account_number order by ts) as life
                   from gaps),
         last_life as (select * from lives qualify life = max(life) over (partition by account_number)),
         newest as (select *, max(start) over (partition by account_number) as newest from last_life)
    select account_number, round(sum(s), 2) as total_spending, sum(n)::bigint as num_tx,
           round(coalesce(avg(s) filter (start = newest), 0) + 1e-6, 4) as window_avg, max(ts) as last_seen
    from newest group by account_number
    having max(ts) >= (select max(ts) from events) - interval {PATIENCE} - interval 10 seconds"""


@query("stm_20_seeded_state_with_timeout", _SEEDED)
def _(t):
    """Python state with event-time timers: seeds are where accounts start, two idle days where they end."""
    table = read_upserted(t.spark, f"{_run_seeded(t)}/table", [KEY])
    return _shown_tracked(table.where("not expired"))


@query("stm_21_snapshot_from_state_store", _SEEDED)
def _(t):
    """The same states, read out of the state store the stream left in its checkpoint."""
    return _shown_tracked(state_snapshot(t.spark, f"{_run_seeded(t)}/checkpoint"))


@query(
    "udf_04_custom_state_function",
    """with w as (select o_custkey::varchar as account_number, sum(o_totalprice) as s, count(*) as n,
                         time_bucket(interval 30 days, o_orderdate, timestamp '1970-01-01') as start
                  from orders group by 1, 4)
       select account_number, round(sum(s), 2) as total_spending, sum(n)::bigint as num_tx,
              round(arg_max(s / n, start) + 1e-6, 4) as window_avg
       from w group by account_number""",
)
def _(t):
    """The same Python state function over all orders."""
    out = work_folder(t.spark, "custom")
    stream = payments(stream_table(t.spark, t.path("orders")))

    def save(batch, batch_id):
        upsert_batch(batch, batch_id, f"{out}/table", [KEY])

    run_available(to_batches(track_active(stream, "ts", LENGTH), save, "update"), f"{out}/checkpoint")
    return _shown_tracked(read_upserted(t.spark, f"{out}/table", [KEY])).drop("last_seen")


@query(
    "stm_20_evaluated_transactions",
    "select o_orderkey as id, o_custkey::varchar as account_number, o_totalprice as amount,"
    " o_totalprice > 4000 as is_possible_fraud from orders",
)
def _(t):
    """The marks of single transactions, the other output of the stateful map; no state needed."""
    out = work_folder(t.spark, "marks")
    marked = mark_possible_fraud(payments(stream_table(t.spark, t.path("orders"))).drop("ts"))
    run_available(to_files(marked, f"{out}/rows"), f"{out}/checkpoint")
    return t.spark.read.schema(marked.schema).parquet(f"{out}/rows")


def _flagged(source):
    return f"""{_WINDOWS},
         history as (select o_custkey::varchar as account_number, avg(o_totalprice) as h from orders
                     where o_orderdate < timestamp '{LIVE_FROM}' group by 1)
    select account_number, total_spending, num_tx, window_avg, window_end from {source} join history using (account_number)
    where (case when num_tx > 0 then total_spending / num_tx else 0 end) - h > 2000 or window_avg - h > 2000"""


@query("stm_25_fraud_stream", _flagged("states"))
def _(t):
    """Text lines to red flags, in two arrivals with a restart between them."""
    out = work_folder(t.spark, "fraud")
    live = _live(t)
    later = F.col("o_orderdate") >= F.lit(SECOND_ARRIVAL_FROM).cast("timestamp_ntz")
    table = StateTable(t.spark, f"{out}/state")
    for arrival in (live.where(~later), live.where(later)):
        _as_lines(arrival).write.mode("append").text(f"{out}/lines")
        run_fraud_stream(
            stream_lines(t.spark, f"{out}/lines"), history(t), table, f"{out}/flags", f"{out}/checkpoint", LENGTH
        )
    return _shown(t.spark.read.parquet(f"{out}/flags"))


def _as_lines(orders):
    return orders.select(
        F.concat_ws(
            ",",
            F.col("o_orderkey").cast("string"),
            F.date_format("o_orderdate", "MM/dd/yyyy"),
            F.col("o_custkey").cast("string"),
            F.format_string("%.2f", "o_totalprice"),
            "o_orderpriority",
        ).alias("value")
    )


def flagship(t):
    """Red flags on tables: state of each account after each window, against its history."""
    return _shown(fraud_on_table(payments(_live(t)), history(t), empty_state(t.spark), LENGTH))


_OPEN_WINDOWS = _flagged("states").replace(
    "where window_end <= (select max(ts) - interval 10 seconds from tx)", ""
)

query("stm_25_fraud_on_table", _OPEN_WINDOWS)(flagship)


@query(
    "stm_26_restart_from_checkpoint",
    "select event_id, event_type, value from events",
)
def _(t):
    """Events arrive in three parts, each read by a new run; none is lost or read twice."""
    out = work_folder(t.spark, "restart")
    events = t.events.select("event_id", "event_type", "value")
    parts = [events.where(F.col("event_type").isin(*kinds)) for kinds in (["click", "view"], ["purchase"])]
    parts.append(events.where(~F.col("event_type").isin("click", "view", "purchase")))
    for part in parts:
        part.write.mode("append").parquet(f"{out}/events")
        stream = read_stream(t.spark, "parquet", f"{out}/events", events.schema)
        run_available(to_files(stream, f"{out}/rows"), f"{out}/checkpoint")
    return t.spark.read.schema(events.schema).parquet(f"{out}/rows")
