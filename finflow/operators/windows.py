"""Window functions that hold up when one key owns a large part of the table.

Without hot keys (see ``skew``) these are a plain ``Window``: one shuffle, one
sort. The rows of hot keys are cut into *ranges* of about equal size in the
window's order; inside a range the plain window does the work, and what crosses
from range to range is a prefix scan over one small row per range.

Orders are lists of column names; a leading ``-`` means descending.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from finflow.operators.skew import Heat, HotKeys, aside

WindowColumn = Callable[[WindowSpec], Column]


def ordering(order: Sequence[str]) -> list[Column]:
    """Sort columns for names like ``date`` (ascending) or ``-date`` (descending)."""
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def _names(order: Sequence[str]) -> list[str]:
    return [o.removeprefix("-") for o in order]


def lookback_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    back: int,
    columns: Mapping[str, WindowColumn],
    heat: Heat | HotKeys = Heat(),
) -> DataFrame:
    """Add window columns that look at most ``back`` rows behind the current one.

    ``order`` must be total (name a unique column last). For a hot key only the
    first ``back`` rows of a range need rows of earlier ranges, and these are
    among the last ``back`` rows of each range: the second window runs over
    those edge rows alone.
    """
    whole = Window.partitionBy(*keys).orderBy(*ordering(order))
    plain = lambda rows: rows.select("*", *[make(whole).alias(name) for name, make in columns.items()])
    found = heat.find(df, keys)
    if found.table is None:
        return plain(df)
    cold, hot = found.split(df)
    part = Window.partitionBy(*keys, "_range").orderBy(*ordering(order))
    placed = found.in_ranges(hot, ordering(order)).withColumns(
        {
            "_pos": F.row_number().over(part),
            "_size": F.count(F.lit(1)).over(Window.partitionBy(*keys, "_range")),
        }
    )
    inner = placed.select(
        "*", *[make(part).alias(name) for name, make in columns.items()]
    ).where(F.col("_pos") > back)
    edges = placed.where((F.col("_pos") <= back) | (F.col("_pos") > F.col("_size") - back))
    heads = plain(edges).where(F.col("_pos") <= back)
    split = inner.unionByName(heads).drop("_range", "_pos", "_size")
    return plain(cold).unionByName(split)


def rolling_average(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    rows: int,
    out: str,
    heat: Heat | HotKeys = Heat(),
) -> DataFrame:
    """Average of ``value`` over the current row and the ``rows - 1`` before it."""
    back = rows - 1
    return lookback_rows(
        df, keys, order, back,
        {out: lambda w: F.avg(value).over(w.rowsBetween(-back, 0))},
        heat,
    )


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    offset: int = 1,
    default: object = None,
    heat: Heat | HotKeys = Heat(),
) -> DataFrame:
    """``value`` of the row ``offset`` places earlier, ``default`` where there is none."""
    return lookback_rows(
        df, keys, order, offset,
        {out: lambda w: F.lag(value, offset, default).over(w)},
        heat,
    )


def range_totals(
    df: DataFrame,
    keys: Sequence[str],
    by: Column,
    span: int,
    value: str,
    prefix: str = "",
    heat: Heat | HotKeys = Heat(),
) -> DataFrame:
    """Add ``sum``, ``count``, ``min`` and ``max`` of ``value`` over the rows of the
    key whose ``by`` lies in ``[by - span, by]``; names start with ``prefix``.

    ``by`` is an integer expression (days, seconds). All rows of a hot key with
    the same ``by`` share one answer, so they are first combined; the combined
    rows are cut into stretches of ``span`` units and also visit the next
    stretch, where they only serve as history. No task sees more than ``2 * span``
    of them.
    """
    df = df.withColumn("_by", by.cast("bigint"))
    names = {kind: f"{prefix}{kind}" for kind in ("sum", "count", "min", "max")}
    frame = Window.partitionBy(*keys).orderBy("_by").rangeBetween(-span, 0)
    plain = lambda rows: rows.select(
        "*",
        F.sum(value).over(frame).alias(names["sum"]),
        F.count(value).over(frame).alias(names["count"]),
        F.min(value).over(frame).alias(names["min"]),
        F.max(value).over(frame).alias(names["max"]),
    )
    found = heat.find(df, keys)
    if found.table is None:
        return plain(df).drop("_by")
    cold, hot = found.split(df)

    points = hot.groupBy(*keys, "_by").agg(
        F.sum(value).alias("_sum"),
        F.count(value).alias("_count"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    # Rows without an order value are peers of each other only, and so have a stretch of their own.
    own = F.coalesce(F.floor(F.col("_by") / F.lit(max(span, 1))), F.lit(-(1 << 62)))
    visiting = points.withColumn("_own", own).withColumn(
        "_bucket", F.explode(F.array(F.col("_own"), F.col("_own") + 1))
    )
    part = Window.partitionBy(*keys, "_bucket").orderBy("_by").rangeBetween(-span, 0)
    answers = visiting.select(
        *keys,
        "_by",
        "_own",
        "_bucket",
        F.sum("_sum").over(part).alias(names["sum"]),
        F.sum("_count").over(part).alias(names["count"]),
        F.min("_min").over(part).alias(names["min"]),
        F.max("_max").over(part).alias(names["max"]),
    ).where(F.col("_own") == F.col("_bucket"))
    answers, match = aside(answers, [*keys, "_by"])
    split = hot.join(answers, match, "inner").select(*df.columns, *names.values())
    return plain(cold).unionByName(split).drop("_by")


def _offsets(sizes: DataFrame, keys: Sequence[str], counts: Mapping[str, str]) -> DataFrame:
    """Per range, the total of each count over the ranges before it."""
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(n) for n, c in counts.items()],
    )


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    heat: Heat | HotKeys = Heat(),
) -> DataFrame:
    """Add the row number within the key.

    For a hot key the number inside a range is moved on by the sizes of the
    ranges before it.
    """
    whole = Window.partitionBy(*keys).orderBy(*ordering(order))
    found = heat.find(df, keys)
    if found.table is None:
        return df.withColumn(out, F.row_number().over(whole).cast("bigint"))
    cold, hot = found.split(df)
    plain = cold.withColumn(out, F.row_number().over(whole).cast("bigint"))

    placed = found.in_ranges(hot, ordering(order))
    sizes = placed.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before, match = aside(_offsets(sizes, keys, {"_rows_before": "_n"}), [*keys, "_range"])
    part = Window.partitionBy(*keys, "_range").orderBy(*ordering(order))
    split = (
        placed.withColumn("_pos", F.row_number().over(part))
        .join(before, match, "inner")
        .select(*df.columns, (F.col("_pos") + F.col("_rows_before")).alias(out))
    )
    return plain.unionByName(split)


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    heat: Heat | HotKeys = Heat(),
) -> DataFrame:
    """Add ranks: ``columns`` maps an output name to ``rank``, ``dense_rank`` or ``percent_rank``.

    A rank depends on the order values alone, so the rows of a hot key are first
    combined to one per distinct value with its count; ranks are found range by
    range on those and joined back.
    """
    whole = Window.partitionBy(*keys).orderBy(*ordering(order))
    plain_column = {
        "rank": lambda: F.rank().over(whole).cast("bigint"),
        "dense_rank": lambda: F.dense_rank().over(whole).cast("bigint"),
        "percent_rank": lambda: F.percent_rank().over(whole),
    }
    plain = lambda rows: rows.select("*", *[plain_column[kind]().alias(n) for n, kind in columns.items()])
    found = heat.find(df, keys)
    if found.table is None:
        return plain(df)
    cold, hot = found.split(df)

    distinct = [o for o in _names(order) if o not in keys]
    values = hot.groupBy(*keys, *distinct).agg(F.count(F.lit(1)).alias("_n"))
    values = found.in_ranges(values, ordering(order))
    sizes = values.groupBy(*keys, "_range").agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values")
    )
    before = _offsets(sizes, keys, {"_rows_before": "_rows", "_values_before": "_values"})
    totals = sizes.groupBy(*keys).agg(F.sum("_rows").alias("_total"))
    totals, same_key = aside(totals, keys)
    before = before.join(totals, same_key, "inner").select(
        *keys, "_range", "_rows_before", "_values_before", "_total"
    )
    before, match = aside(before, [*keys, "_range"])

    part = Window.partitionBy(*keys, "_range").orderBy(*ordering(order))
    ahead = F.coalesce(
        F.sum("_n").over(part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = values.withColumns({"_ahead": ahead, "_place": F.row_number().over(part)}).join(
        before, match, "inner"
    )
    ahead_of_all = F.col("_ahead") + F.col("_rows_before")
    split_column = {
        "rank": ahead_of_all + 1,
        "dense_rank": F.col("_place") + F.col("_values_before"),
        "percent_rank": F.when(F.col("_total") > 1, ahead_of_all / (F.col("_total") - 1)).otherwise(
            F.lit(0.0)
        ),
    }
    ranks = placed.select(*keys, *distinct, *[split_column[kind].alias(n) for n, kind in columns.items()])
    ranks, same_value = aside(ranks, [*keys, *distinct])
    split = hot.join(ranks, same_value, "inner").select(*df.columns, *columns)
    return plain(cold).unionByName(split)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    running_sum: str = "running_sum",
    running_count: str = "running_count",
    key_total: str = "key_total",
    heat: Heat | HotKeys = Heat(),
) -> DataFrame:
    """Add the running sum and count of ``value`` and its total over the whole key.

    ``order`` must be total. Frames: unbounded preceding to current row, and
    unbounded on both ends.
    """
    so_far = (
        Window.partitionBy(*keys).orderBy(*ordering(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    plain = lambda rows: rows.select(
        "*",
        F.sum(value).over(so_far).alias(running_sum),
        F.count(value).over(so_far).alias(running_count),
        F.sum(value).over(Window.partitionBy(*keys)).alias(key_total),
    )
    found = heat.find(df, keys)
    if found.table is None:
        return plain(df)
    cold, hot = found.split(df)

    placed = found.in_ranges(hot, ordering(order))
    part = (
        Window.partitionBy(*keys, "_range").orderBy(*ordering(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = placed.withColumns(
        {"_sum": F.sum(value).over(part), "_count": F.count(value).over(part)}
    )
    sizes = placed.groupBy(*keys, "_range").agg(
        F.sum(value).alias("_s"), F.count(value).alias("_n")
    )
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        *keys,
        "_range",
        F.sum("_s").over(earlier).alias("_sum_before"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_count_before"),
        F.sum("_s").over(Window.partitionBy(*keys)).alias("_total"),
    )
    before, match = aside(before, [*keys, "_range"])
    # A sum over no values is null, so add only the side that exists.
    total = F.coalesce(F.col("_sum") + F.col("_sum_before"), F.col("_sum"), F.col("_sum_before"))
    split = local.join(before, match, "inner").select(
        *df.columns,
        total.alias(running_sum),
        (F.col("_count") + F.col("_count_before")).alias(running_count),
        F.col("_total").alias(key_total),
    )
    return plain(cold).unionByName(split)


def time_bucket(
    df: DataFrame,
    time: str,
    length: str,
    slide: str | None = None,
    start: str | None = None,
    start_name: str = "window_start",
    end_name: str = "window_end",
) -> DataFrame:
    """Add the bounds of the time window(s) a row falls in.

    With ``slide`` below ``length`` a row appears once per overlapping window.
    Rows without a time are dropped, as the built-in does.
    """
    return (
        df.withColumn("_window", F.window(time, length, slide or length, start))
        .select(
            "*",
            F.col("_window.start").alias(start_name),
            F.col("_window.end").alias(end_name),
        )
        .drop("_window")
    )
