"""Event-time windows. Every function takes a table or a stream."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def with_event_time(df: DataFrame, time: str, delay: str = "10 seconds") -> DataFrame:
    """Make ``time`` the event time: rows over ``delay`` behind the newest may be dropped as late."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def window_aggregate(
    df: DataFrame,
    time: str,
    length: str,
    keys: Sequence[str],
    columns: Mapping[str, Column],
    slide: str | None = None,
) -> DataFrame:
    """Aggregates per time window and key, with ``window_start`` and ``window_end``."""
    grouped = df.groupBy(F.window(time, length, slide or length).alias("_window"), *keys).agg(
        *[c.alias(n) for n, c in columns.items()]
    )
    return grouped.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *keys,
        *columns,
    )


def window_counts(
    df: DataFrame, time: str, length: str, *keys: str, slide: str | None = None
) -> DataFrame:
    """Rows per time window and key."""
    return window_aggregate(df, time, length, keys, {"count": F.count(F.lit(1))}, slide)


def micros(spark: SparkSession, text: str) -> int:
    """Microseconds of an interval."""
    epoch = "timestamp '1970-01-01 00:00:00'"
    return spark.sql(f"select unix_micros({epoch} + interval {text}) - unix_micros({epoch})").first()[0]


def pane(spark: SparkSession, length: str, slide: str) -> str:
    """Length of the longest panes that make up all windows of ``length`` every ``slide``."""
    return f"{math.gcd(micros(spark, length), micros(spark, slide))} microseconds"


def sliding_totals(
    df: DataFrame, time: str, length: str, slide: str, keys: Sequence[str], value: str
) -> DataFrame:
    """Sum and count of ``value`` per sliding window and key.

    Rows are first summed per pane, and only panes are copied to the windows
    that overlap them. As panes leave and enter whole, no inverse function is needed.
    """
    panes = df.groupBy(F.window(time, pane(df.sparkSession, length, slide)).alias("_pane"), *keys).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_count")
    )
    timed = panes.select(F.window_time("_pane").alias("_time"), *keys, "_sum", "_count")
    return window_aggregate(
        timed, "_time", length, keys,
        {"total": F.sum("_sum"), "count": F.sum("_count")},
        slide,
    )


def sliding_records(
    df: DataFrame,
    time: str,
    length: str,
    slide: str,
    keys: Sequence[str],
    record: Column,
    part: Column | None = None,
) -> DataFrame:
    """The records of each sliding window and key: ``window_start, window_end``, keys, ``part``, ``records``.

    A record is held once, in the list of its pane; when a pane closes, its list goes to
    the windows that overlap it, and a window puts its panes' lists together.
    ``records`` is sorted. ``part``, a whole number made of the row, deals the records of
    a key to several lists, each with a row and a state of its own, so that none grows
    beyond what a task can hold; without it all are in part 0.
    """
    part = F.lit(0) if part is None else part
    panes = df.groupBy(
        F.window(time, pane(df.sparkSession, length, slide)).alias("_pane"), *keys, part.cast("int").alias("part")
    ).agg(F.collect_list(record).alias("_records"))
    timed = panes.select(F.window_time("_pane").alias("_time"), *keys, "part", "_records")
    whole = F.sort_array(F.flatten(F.collect_list("_records")))
    return window_aggregate(timed, "_time", length, [*keys, "part"], {"records": whole}, slide)


def cogroup_windows(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    length: str,
    keys: Sequence[str],
    left_facts: Mapping[str, Column],
    right_facts: Mapping[str, Column],
    combine: Mapping[str, Column],
) -> DataFrame:
    """One row per window and key that either side has, combined from aggregates of both groups.

    Each side shrinks to a row per window and key before the two meet; facts of an absent
    side are null. Two streams need a watermark each; a row comes once both have passed its
    window. Keys have the same names on both sides, facts different ones.
    """
    def grouped(df: DataFrame, time: str, facts: Mapping[str, Column], mark: str) -> DataFrame:
        rows = df.groupBy(F.window(time, length).alias(f"_window{mark}"), *keys).agg(*[c.alias(n) for n, c in facts.items()])
        return rows.withColumnsRenamed({k: f"_{k}{mark}" for k in keys})

    one, two = grouped(left, left_time, left_facts, "_l"), grouped(right, right_time, right_facts, "_r")
    match = F.col("_window_l") == F.col("_window_r")
    for k in keys:
        match = match & F.col(f"_{k}_l").eqNullSafe(F.col(f"_{k}_r"))
    window = F.coalesce("_window_l", "_window_r")
    return one.join(two, match, "full_outer").select(
        window["start"].alias("window_start"),
        window["end"].alias("window_end"),
        *[F.coalesce(f"_{k}_l", f"_{k}_r").alias(k) for k in keys],
        *[c.alias(n) for n, c in combine.items()],
    )


def slice_archive(
    archive: DataFrame, start: str, end: str, time: str = "ts", day: str = "day"
) -> DataFrame:
    """Rows of an archived stream with ``start <= time < end``; reads only the days in question."""
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    at = F.col(time).cast("timestamp")
    return archive.where(
        (F.col(day) >= F.to_date(first)) & (F.col(day) <= F.to_date(last)) & (at >= first) & (at < last)
    )
