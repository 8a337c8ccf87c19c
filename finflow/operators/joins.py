"""Joins.

Inner, semi and anti joins on large inputs are left to Spark: adaptive
execution splits a skewed partition of a sort-merge join by itself. It cannot
do so for a full outer join, nor for the side that an outer join fills with
nulls; ``outer_join`` covers these.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finflow.operators.layout import expected_bytes
from finflow.operators.skew import Heat, HotKeys

# Other names of the outer joins.
OUTER_NAMES = {
    "left": "left", "leftouter": "left",
    "right": "right", "rightouter": "right",
    "full": "full", "outer": "full", "fullouter": "full",
}

BROADCAST_BYTES = 64 * 1024 * 1024

# An expected size this many times the limit is not worth measuring.
_HOPELESS = 1000

# Values beyond this share the outermost cells of a band join.
_FARTHEST = 1e300

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def measured_bytes(df: DataFrame) -> Column:
    """Aggregate expression: bytes of ``df``, by value length for everything of variable width."""
    widths = [F.lit(16)]
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _FIXED_WIDTH):
            widths.append(F.lit(8))
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(column), F.lit(0)))
        else:
            packed = F.to_json(F.struct(column.alias("v")))
            widths.append(F.coalesce(F.octet_length(packed), F.lit(0)))
    return F.sum(reduce(lambda a, b: a + b, widths).cast("long"))


def fits_in_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` measures at most ``max_bytes``.

    Runs one distributed aggregation, unless the optimizer expects ``_HOPELESS`` times as much:
    then the join is shuffled without reading ``df`` an extra time.
    """
    if expected_bytes(df) > _HOPELESS * max_bytes:
        return False
    size = df.agg(measured_bytes(df).alias("size")).first()["size"]
    return (size or 0) <= max_bytes


def broadcast_join(
    large: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join that ships ``small`` to every task, if it measures at most ``max_bytes``.

    A larger ``small`` gives the same rows by a shuffled join. The measuring job
    runs when the join is built.
    """
    if fits_in_broadcast(small, max_bytes):
        small = F.broadcast(small)
    return large.join(small, list(on), how)


def outer_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    heat: Heat | HotKeys = Heat(),
) -> DataFrame:
    """Left, right or full outer join by column names with any key allowed to be hot.

    Adaptive execution splits a hot key on the preserved side by itself. Keys hot
    on a side that may be filled with nulls are joined apart, as an inner join
    (which it can split on both sides) plus the rows without a partner, found
    by an anti join against the distinct keys of the other side.
    """
    on, how = list(on), OUTER_NAMES[how.replace("_", "")]
    filled = {"left": [right], "right": [left], "full": [left, right]}[how]
    # The keys of all sides that may be filled, a side's keys counted for themselves.
    sides = reduce(lambda a, b: a.union(b), [s.select(*on, F.lit(n).alias("_side")) for n, s in enumerate(filled)])
    hot = heat if isinstance(heat, HotKeys) else heat.find(sides, [*on, "_side"])
    if hot.table is None:
        return left.join(right, on, how)
    hot = replace(hot, keys=tuple(on), table=hot.table.select(*on).distinct())
    cold_left, hot_left = hot.split(left)
    cold_right, hot_right = hot.split(right)
    plain = cold_left.join(cold_right, on, how)

    parts = [hot_left.join(hot_right, on, "inner")]
    if how in ("left", "full"):
        parts.append(hot_left.join(hot_right.select(*on).distinct(), on, "left_anti"))
    if how in ("right", "full"):
        parts.append(hot_right.join(hot_left.select(*on).distinct(), on, "left_anti"))
    split = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return plain.unionByName(split, allowMissingColumns=True)


def pair_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    heat: Heat = Heat(),
) -> DataFrame:
    """Join that keeps both records whole, in the struct columns ``_1`` and ``_2``.

    The absent side of an outer join is a null struct. ``on`` pairs a left
    column with a right column.
    """
    keys = [f"_key_{i}" for i in range(len(on))]
    packed_left = left.select(
        *[F.col(a).alias(k) for k, (a, _) in zip(keys, on)], F.struct("*").alias("_1")
    )
    packed_right = right.select(
        *[F.col(b).alias(k) for k, (_, b) in zip(keys, on)], F.struct("*").alias("_2")
    )
    if how == "inner":
        joined = packed_left.join(packed_right, keys, how)
    else:
        joined = outer_join(packed_left, packed_right, keys, how, heat)
    return joined.select("_1", "_2")


def cross_join(left: DataFrame, right: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every combination of rows.

    A ``right`` that measures at most ``max_bytes`` goes to every task. Otherwise both
    sides are cut by hash into blocks of about that size, and every pair of blocks is one
    group of an equi join: each task holds two blocks, and a row travels once for each
    block of the other side, the least that a product of that size allows. Equal rows
    are in one block. Both sides are sorted and merged: the optimizer sees the tables
    without their copies, and would broadcast all copies of a small one. The measuring
    jobs run when the join is built.

    The pairs grow with the product of the sides. Where only totals over pairs are asked,
    combine rows that are alike for them first.
    """
    size = lambda df: df.agg(measured_bytes(df).alias("size")).first()["size"] or 0
    right_bytes = size(right)
    if right_bytes <= max_bytes:
        return left.crossJoin(F.broadcast(right))
    rows, columns = (max(1, math.ceil(n / max_bytes)) for n in (size(left), right_bytes))
    block = lambda df, blocks: F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(blocks)).cast("int")
    all_of = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    one = left.select("*", block(left, rows).alias("_row"), all_of(columns).alias("_column"))
    two = right.select("*", all_of(rows).alias("_other_row"), block(right, columns).alias("_other_column"))
    met = one.join(two.hint("merge"), (F.col("_row") == F.col("_other_row")) & (F.col("_column") == F.col("_other_column")))
    return met.drop("_row", "_column", "_other_row", "_other_column")


def band_join(
    left: DataFrame,
    right: DataFrame,
    value: str,
    low: str,
    high: str,
    width: float | None = None,
    extra: Column | None = None,
) -> DataFrame:
    """Rows with ``low <= value < high``: a theta join given an equi key, for bands of any width.

    The line of values is cut into cells on levels, each level twice as wide as the one
    below. A band is listed on the level where cells are as long as it is, or at most twice,
    so in two cells at most; a value is listed in its one cell of each level that bands are on.
    A pair meets in exactly one cell. Bands with an infinite end are first cut to the
    range of the values. ``width`` says the finest cells: narrower bands use them too, which
    saves levels. Two aggregations run when the join is built: the range of the values,
    and the levels in use (as many as doublings between the narrowest and the widest band).
    Values and ends that are null or not a number match nothing.
    """
    numbers = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    at = F.col(value).cast("double")
    finite = left.where(numbers(value))
    ends = finite.agg(F.min(at).alias("least"), F.max(at).alias("most")).first()
    if ends["least"] is None:
        return left.limit(0).crossJoin(F.broadcast(right.limit(0)))
    # What decides the cells; the condition itself compares the columns as they are.
    near = lambda x: F.greatest(F.least(x, F.lit(_FARTHEST)), F.lit(-_FARTHEST))
    begin = near(F.greatest(F.col(low).cast("double"), F.lit(ends["least"])))
    end = near(F.least(F.col(high).cast("double"), F.lit(ends["most"])))
    bands = right.where(numbers(low) & numbers(high) & (F.col(low) < F.col(high)))
    bands = bands.where((F.col(low).cast("double") <= ends["most"]) & (F.col(high).cast("double") > ends["least"]))
    least = -1074 if width is None else math.floor(math.log2(width))
    # A band that touches one value only has no length of its own.
    level = F.when(end > begin, F.ceil(F.log2(end - begin))).otherwise(F.lit(least)).cast("int")
    # Cells are never finer than doubles of that size are apart, or numbers of cells would not be exact.
    reach = F.greatest(F.abs(begin), F.abs(end))
    spacing = F.when(reach > 0, F.ceil(F.log2(reach)) - 50).otherwise(F.lit(-1074)).cast("int")
    levelled = bands.withColumn("_level", F.greatest(level, spacing, F.lit(least)))
    levels = [r[0] for r in levelled.select("_level").distinct().collect()]

    def cell(x: Column, level: Column) -> Column:
        return F.floor(x / F.pow(F.lit(2.0), level))

    first, last = cell(begin, F.col("_level")), cell(end, F.col("_level"))
    listed = levelled.withColumn("_cell", F.explode(F.sequence(first, last)))
    placed = finite.withColumn("_of_level", F.explode(F.array(*[F.lit(n) for n in sorted(levels)]).cast("array<int>")))
    placed = placed.withColumn("_of_cell", cell(near(at), F.col("_of_level")))
    inside = (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))
    if extra is not None:
        inside = inside & extra
    same_cell = (F.col("_of_level") == F.col("_level")) & (F.col("_of_cell") == F.col("_cell"))
    return placed.join(listed, same_cell & inside, "inner").drop("_of_level", "_of_cell", "_level", "_cell")


def cogroup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_facts: Mapping[str, Column],
    right_facts: Mapping[str, Column],
    combine: Mapping[str, Column],
) -> DataFrame:
    """One row per key of either side, combined from aggregates of both groups.

    Both sides shrink to one row per key before they meet; the facts of an
    absent side are null.
    """
    keys = list(keys)
    one = left.groupBy(*keys).agg(*[c.alias(n) for n, c in left_facts.items()])
    two = right.groupBy(*keys).agg(*[c.alias(n) for n, c in right_facts.items()])
    both = one.join(two, keys, "full")
    return both.select(*keys, *[c.alias(n) for n, c in combine.items()])
