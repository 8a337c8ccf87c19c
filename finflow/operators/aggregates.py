"""Grouped aggregation in forms that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.operators.skew import Heat, HotKeys, aside
from finflow.operators.windows import numbered


def group_count(df: DataFrame, *keys: str, out: str = "count") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def group_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The keys of a grouping, each once."""
    return df.select(*keys).distinct()


def map_groups(df: DataFrame, keys: Sequence[str], **columns: Column) -> DataFrame:
    """One row per group. ``columns`` are aggregate expressions, so groups are
    reduced on the map side and no group is ever held together."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in columns.items()])


def flat_map_groups(
    df: DataFrame,
    keys: Sequence[str],
    facts: Mapping[str, Column],
    emit: Column,
    out: str,
) -> DataFrame:
    """Zero to n output rows per group.

    ``facts`` are aggregates of the group; ``emit`` is an array expression over
    a row and the facts, whose elements become the output. The rows of a group
    meet only its facts, so a large group is spread by the (skew-aware) join.
    """
    group, match = aside(map_groups(df, keys, **facts), keys)
    return df.join(group, match, "inner").select(*keys, F.explode(emit).alias(out))


def reduce_groups(
    df: DataFrame,
    keys: Sequence[str],
    reduce: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    combine_rows: int = 100_000,
) -> DataFrame:
    """Associative reduce of each group by a Python function.

    ``reduce`` takes rows of any number of groups (columns of ``schema``, which
    must equal those of ``df``) and returns one row per group. It runs on every
    ``combine_rows`` rows before the shuffle; after it, the partial rows arrive
    sorted by key and are reduced batch by batch, carrying over the one group
    that may continue. No call ever holds a whole large group. Where a built-in
    aggregate exists, prefer it.
    """
    keys = list(keys)

    def before_shuffle(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= combine_rows:
                yield reduce(pd.concat(held))
                held, rows = [], 0
        if rows:
            yield reduce(pd.concat(held))

    def after_shuffle(batches):
        carried = None
        for batch in batches:
            if batch.empty:
                continue
            last = batch[keys].iloc[-1]
            reduced = reduce(batch if carried is None else pd.concat([carried, batch]))
            same = reduced[keys].eq(last) | (reduced[keys].isna() & last.isna())
            is_open = same.all(axis=1)
            carried = reduced[is_open]
            yield reduced[~is_open]
        if carried is not None:
            yield carried

    return (
        df.mapInPandas(before_shuffle, schema)
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(after_shuffle, schema)
    )


def _first(c: Column, order: Column) -> Column:
    return F.min_by(c, F.when(c.isNotNull(), F.struct(order.isNull(), order)))


def _last(c: Column, order: Column) -> Column:
    return F.max_by(c, F.when(c.isNotNull(), F.struct(order.isNotNull(), order)))


def first_by(df: DataFrame, keys: Sequence[str], order: Column, **columns: Column) -> DataFrame:
    """Value of the first row of each group in ``order`` that is not null in the column.

    Rows without an order come last: they answer for a group that has no others.
    """
    return df.groupBy(*keys).agg(*[_first(c, order).alias(n) for n, c in columns.items()])


def last_by(df: DataFrame, keys: Sequence[str], order: Column, **columns: Column) -> DataFrame:
    """Value of the last row of each group in ``order`` that is not null in the column.

    Rows without an order come first: they answer for a group that has no others.
    """
    return df.groupBy(*keys).agg(*[_last(c, order).alias(n) for n, c in columns.items()])


def first_and_last(df: DataFrame, keys: Sequence[str], order: Column, **columns: Column) -> DataFrame:
    """``first_<name>`` and ``last_<name>`` of each column, in one aggregation."""
    ends = [f(c, order).alias(f"{p}_{n}") for n, c in columns.items() for p, f in (("first", _first), ("last", _last))]
    return df.groupBy(*keys).agg(*ends)


def drop_duplicates_by(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key, the first in ``order`` (nulls last); combines before the shuffle, unlike row_number."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(order.isNull(), order)).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def collect_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    chunk_rows: int,
    chunk: str = "chunk",
    range_rows: int = Heat.range_rows,
) -> DataFrame:
    """The non-null values of each group as lists in ``order``, at most ``chunk_rows`` to a list.

    A group that is longer continues in further rows with ``chunk`` 1, 2, ...; no
    row and no task ever holds an unbounded list. Groups that fit in one list
    take the plain aggregate.
    """
    values = df.where(F.col(value).isNotNull())
    long = Heat(hot_rows=chunk_rows, hot_share=0.0, range_rows=range_rows).find(values, keys, sure=True)
    place = F.struct(*[F.col(o.removeprefix("-")).alias(f"_{n}") for n, o in enumerate(order)])
    descending = {o.startswith("-") for o in order}

    def gathered(rows: DataFrame, at: Column, which: Column, falling: bool) -> DataFrame:
        items = F.sort_array(F.collect_list(F.struct(at.alias("_at"), F.col(value).alias("_value"))), not falling)
        lists = rows.groupBy(*keys, which.alias(chunk)).agg(items.alias("_items"))
        return lists.select(*keys, chunk, F.transform("_items", lambda item: item["_value"]).alias(out))

    def by_number(rows: DataFrame, heat: Heat | HotKeys) -> DataFrame:
        placed = numbered(rows, keys, order, "_pos", heat)
        which = F.floor((F.col("_pos") - 1) / F.lit(chunk_rows)).cast("int")
        return gathered(placed, F.col("_pos"), which, False)

    def short(rows: DataFrame) -> DataFrame:
        if len(descending) > 1:  # mixed directions: no array sort says them
            return by_number(rows, HotKeys(tuple(keys), long.heat))
        return gathered(rows, place, F.lit(0), True in descending)

    if long.table is None:
        return short(values)
    cold, hot = long.split(values)
    return short(cold).unionByName(by_number(hot, long))


def profile(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Average, sum, count and maximum of ``amount`` per key."""
    return df.groupBy(*keys).agg(
        F.avg(amount).alias("average_transaction"),
        F.sum(amount).alias("total_transaction"),
        F.count(amount).alias("num_transactions"),
        F.max(amount).alias("max_transaction"),
    )
