"""Window functions and time buckets (WIN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.operators.windows import (
    numbered, previous, range_totals, ranked, rolling_average, running_totals, time_bucket,
)
from finflow.operators.skew import Heat
from finflow.plans.inputs import TRANSACTIONS, steady, transactions
from finflow.plans.registry import query

# With these limits the busier customers take the path for hot keys, in many ranges.
_LOW = {"heat": Heat(hot_rows=10, range_rows=100)}


BY_DATE = ["date", "id"]


def _slim(t):
    return transactions(t).select("id", "account_number", "date", "amount")


_ROLLING = """
    select id, account_number, amount,
           round(avg(amount) over (partition by account_number order by date, id
                                   rows between 4 preceding and current row) + 1e-6, 4) as rolling_avg
    from (""" + TRANSACTIONS + ")"


def _rolling(t, **limits):
    rows = rolling_average(
        _slim(t), ["account_number"], BY_DATE, "amount", 5, "rolling_avg", **limits,
    )
    return rows.select("id", "account_number", "amount", steady("rolling_avg").alias("rolling_avg"))


@query("win_01_rolling_average", _ROLLING)
def _(t):
    return _rolling(t)


@query("win_01_rolling_average_hot_keys", _ROLLING)
def _(t):
    return _rolling(t, **_LOW)


_RANGE = """
    select id, account_number, count(*) over w as in_90_days, round(sum(amount) over w, 2) as total_90_days,
           max(amount) over w as most_90_days
    from (""" + TRANSACTIONS + """)
    window w as (partition by account_number order by date
                 range between interval 90 days preceding and current row)"""


def _range(t, **limits):
    rows = range_totals(
        _slim(t), ["account_number"], F.unix_date("date"), 90, "amount", "in_90_days_", **limits
    )
    return rows.select(
        "id",
        "account_number",
        F.col("in_90_days_count").alias("in_90_days"),
        F.round("in_90_days_sum", 2).alias("total_90_days"),
        F.col("in_90_days_max").alias("most_90_days"),
    )


@query("win_02_range_frame", _RANGE)
def _(t):
    return _range(t)


@query("win_02_range_frame_hot_keys", _RANGE)
def _(t):
    return _range(t, **_LOW)


_RUNNING = """
    select id, round(sum(amount) over w, 2) as running_sum, count(amount) over w as running_count,
           round(sum(amount) over (partition by account_number), 2) as key_total
    from (""" + TRANSACTIONS + """)
    window w as (partition by account_number order by date, id
                 rows between unbounded preceding and current row)"""


def _running(t, **limits):
    rows = running_totals(
        _slim(t), ["account_number"], BY_DATE, "amount", **limits
    )
    return rows.select(
        "id",
        F.round("running_sum", 2).alias("running_sum"),
        "running_count",
        F.round("key_total", 2).alias("key_total"),
    )


@query("win_03_unbounded_frames", _RUNNING)
def _(t):
    return _running(t)


@query("win_03_unbounded_frames_hot_keys", _RUNNING)
def _(t):
    return _running(t, **_LOW)


def _statuses(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("date"),
    )


_STATUSES = "(select o_orderkey as id, o_custkey as customer, o_orderstatus as status, o_orderdate as date from orders)"


@query(
    "win_04_lag",
    "select id, customer, status, lag(status, 1) over (partition by customer order by date, id) as prev_status from "
    + _STATUSES,
)
def _(t):
    rows = previous(
        _statuses(t), ["customer"], BY_DATE, "status", "prev_status"
    )
    return rows.drop("date")


@query(
    "win_05_lag_offset_default",
    "select id, customer, status, lag(status, 3, 'none') over (partition by customer order by date, id)"
    " as third_last from " + _STATUSES,
)
def _(t):
    rows = previous(
        _statuses(t), ["customer"], BY_DATE, "status", "third_last",
        offset=3, default="none", **_LOW,
    )
    return rows.drop("date")


_NUMBERED = (
    "select id, customer, row_number() over (partition by customer order by date, id) as position from "
    + _STATUSES
)


def _numbered(t, **limits):
    rows = numbered(_statuses(t), ["customer"], BY_DATE, "position", **limits)
    return rows.select("id", "customer", "position")


@query("win_06_row_number", _NUMBERED)
def _(t):
    return _numbered(t)


@query("win_06_row_number_hot_keys", _NUMBERED)
def _(t):
    return _numbered(t, **_LOW)


def _by_year(t):
    """Orders of each customer with the year only, so that many tie."""
    return t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))


_BY_YEAR = "(select o_orderkey, o_custkey, year(o_orderdate) as year from orders)"


@query(
    "win_07_rank",
    "select o_orderkey, rank() over (partition by o_custkey order by year desc) as rank from " + _BY_YEAR,
)
def _(t):
    rows = ranked(
        _by_year(t), ["o_custkey"], ["-year"], {"rank": "rank"}
    )
    return rows.select("o_orderkey", "rank")


@query(
    "win_08_dense_rank",
    "select o_orderkey, dense_rank() over (partition by o_custkey order by year) as dense_rank from "
    + _BY_YEAR,
)
def _(t):
    rows = ranked(
        _by_year(t), ["o_custkey"], ["year"], {"dense_rank": "dense_rank"}
    )
    return rows.select("o_orderkey", "dense_rank")


@query(
    "win_09_percent_rank",
    "select o_orderkey, round(percent_rank() over (partition by o_custkey order by year), 6) as percent_rank from "
    + _BY_YEAR,
)
def _(t):
    rows = ranked(
        _by_year(t), ["o_custkey"], ["year"], {"percent_rank": "percent_rank"}
    )
    return rows.select("o_orderkey", F.round("percent_rank", 6).alias("percent_rank"))


@query(
    "win_09_all_ranks_hot_keys",
    """select o_orderkey, rank() over w as rank, dense_rank() over w as dense_rank,
              round(percent_rank() over w, 6) as percent_rank from """ + _BY_YEAR + """
       window w as (partition by o_custkey order by year desc)""",
)
def _(t):
    rows = ranked(
        _by_year(t), ["o_custkey"], ["-year"],
        {"rank": "rank", "dense_rank": "dense_rank", "percent_rank": "percent_rank"},
        **_LOW,
    )
    return rows.select(
        "o_orderkey", "rank", "dense_rank", F.round("percent_rank", 6).alias("percent_rank")
    )


@query(
    "win_10_tumbling_bucket",
    """select event_id, value, time_bucket(interval 30 days, ts, timestamp '1970-01-01 00:15:00') as window_start,
              time_bucket(interval 30 days, ts, timestamp '1970-01-01 00:15:00') + interval 30 days as window_end
       from events""",
)
def _(t):
    rows = time_bucket(t.events, "ts", "30 days", "30 days", "15 minutes")
    return rows.select("event_id", "value", "window_start", "window_end")


@query(
    "win_11_sliding_bucket",
    """select event_id, time_bucket(interval 1 hour, ts) - to_hours(back) as window_start,
              time_bucket(interval 1 hour, ts) - to_hours(back) + interval 3 hours as window_end
       from events, (values (0), (1), (2)) v(back)""",
)
def _(t):
    rows = time_bucket(t.events, "ts", "3 hours", "1 hour")
    return rows.select("event_id", "window_start", "window_end")
