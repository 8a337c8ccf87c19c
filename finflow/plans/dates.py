"""Date and time functions (DAT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.functions.dates import US_DATE, strict_us_date
from finflow.plans.registry import query


@query(
    "dat_01_now",
    "select event_type, count(*) as n, true as is_past, true as today_agrees from events group by event_type",
)
def _(t):
    """Today and now, compared with the events instead of shown."""
    return t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.every(F.col("ts") < F.current_timestamp().cast("timestamp_ntz")).alias("is_past"),
        F.every(F.current_date() == F.to_date(F.current_timestamp())).alias("today_agrees"),
    )


@query(
    "dat_02_unix_timestamp",
    """select event_id, epoch(date_trunc('second', ts))::bigint as seconds,
              epoch(date_trunc('day', ts))::bigint as from_text, true as now_is_later
       from events""",
)
def _(t):
    return t.events.select(
        "event_id",
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("seconds"),
        F.unix_timestamp(F.date_format("ts", "dd.MM.yyyy"), "dd.MM.yyyy").alias("from_text"),
        (F.unix_timestamp() > F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("now_is_later"),
    )


@query(
    "dat_03_add",
    """select o_orderkey, (o_orderdate::date + 45)::varchar as later, (o_orderdate::date - 10)::varchar as earlier,
              (o_orderdate + interval 1 month)::date::varchar as next_month
       from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.date_add("o_orderdate", 45).cast("string").alias("later"),
        F.date_sub("o_orderdate", 10).cast("string").alias("earlier"),
        F.add_months("o_orderdate", 1).cast("string").alias("next_month"),
    )


@query(
    "dat_04_difference",
    """select o_orderkey, date_diff('day', date '1998-03-15', o_orderdate::date)::integer as days,
              round(case when day(o_orderdate) = 15 then m::double
                    else m + (day(o_orderdate) - 15) / 31.0::double end, 8) as months
       from (select *, (year(o_orderdate) - 1998) * 12 + month(o_orderdate) - 3 as m from orders)""",
)
def _(t):
    """Days and months from March 15, 1998."""
    start = F.lit("1998-03-15").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.datediff("o_orderdate", start).alias("days"),
        F.months_between("o_orderdate", start).alias("months"),
    )


@query(
    "dat_05_fields",
    """select event_id, day(ts)::integer as day, dayofyear(ts)::integer as day_of_year, minute(ts)::integer as minute,
              month(ts)::integer as month, quarter(ts)::integer as quarter
       from events""",
)
def _(t):
    return t.events.select(
        "event_id",
        F.dayofmonth("ts").alias("day"),
        F.dayofyear("ts").alias("day_of_year"),
        F.minute("ts").alias("minute"),
        F.month("ts").alias("month"),
        F.quarter("ts").alias("quarter"),
    )


@query(
    "dat_06_last_and_next_day",
    """select o_orderkey, last_day(o_orderdate)::varchar as month_end,
              (o_orderdate::date + (7 - (dayofweek(o_orderdate) + 6) % 7)::integer)::varchar as next_monday
       from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.last_day("o_orderdate").cast("string").alias("month_end"),
        F.next_day("o_orderdate", "Mon").cast("string").alias("next_monday"),
    )


@query(
    "dat_07_format",
    """select event_id, strftime(ts, '%Y/%m/%d %H:%M') as formatted,
              strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as from_seconds
       from events""",
)
def _(t):
    return t.events.select(
        "event_id",
        F.date_format("ts", "yyyy/MM/dd HH:mm").alias("formatted"),
        F.from_unixtime(F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("from_seconds"),
    )


@query(
    "dat_08_to_date_and_utc",
    """select event_id, ts::date::varchar as day, ts + interval 5 hours as from_new_york
       from events""",
)
def _(t):
    """January events, when New York is five hours behind UTC."""
    return t.events.select(
        "event_id",
        F.to_date("ts").cast("string").alias("day"),
        F.to_utc_timestamp(F.col("ts").cast("timestamp"), "America/New_York")
        .cast("timestamp_ntz")
        .alias("from_new_york"),
    )


@query(
    "dat_09_us_date",
    """select o_orderkey, o_orderdate::date::varchar as plain, o_orderdate::date::varchar as via_sql,
              o_orderdate::date::varchar as short_form, null::varchar as of_bad_text
       from orders""",
)
def _(t):
    """Month/day/year text back to dates: in expressions, in SQL text, and with one-digit parts."""
    text = t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", US_DATE).alias("text"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("short"),
    )
    return text.select(
        "o_orderkey",
        F.to_date("text", US_DATE).cast("string").alias("plain"),
        F.expr(f"cast(to_date(cast(unix_timestamp(text, '{US_DATE}') as timestamp)) as string) as via_sql"),
        strict_us_date(F.col("short")).cast("string").alias("short_form"),
        strict_us_date(F.concat(F.lit("x"), "text")).cast("string").alias("of_bad_text"),
    )
