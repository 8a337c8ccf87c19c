"""Keys that hold too many rows for one task.

Hot keys are found in one pass over the key columns. A table of counters by key
hash (a count-min sketch of one row) is added up like any aggregate: combined
by task, then by counter, so nothing of the size of the keys is shuffled. A
counter never says less than a key has, so a table without a large counter has
no hot key and the operator uses its plain form: its plan is the plain plan.
Only keys behind large counters are counted exactly.

``Heat`` says what counts as hot; ``HotKeys`` is the list found, which several
operators over the same rows may share. The pass runs when the operator is
built, as does the writing of the list if there is one. Tables that the optimizer
expects to be no larger than a hot key's rows are not searched: whatever they hold, a
task can hold it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.operators.layout import expected_bytes
from finflow.session import saved

# Counters of the sketch: many more than there can be hot keys.
CELLS = 1 << 20
# Hot keys up to which their list is broadcast; with the default share there are never more.
MOST_BROADCAST = 100_000
# Pieces that the rows of hot keys are cut into at most.
MOST_RANGES = 2048
# Bytes of a short row, as files hold it.
LEAST_ROW_BYTES = 16


@dataclass(frozen=True)
class Heat:
    """A key is hot above ``hot_rows`` rows *and* ``hot_share`` of all rows.

    The share bounds the number of hot keys, whatever the table holds. Rows of hot
    keys are cut into pieces of about ``range_rows`` in their order, more where there are very many rows
    (see ``in_ranges``).
    """

    hot_rows: int = 1_000_000
    hot_share: float = 1 / MOST_BROADCAST
    range_rows: int = 250_000

    def find(self, df: DataFrame, keys: Sequence[str], sure: bool = False) -> HotKeys:
        """The hot keys of ``df``; ``sure`` where the result depends on them and not the plan alone."""
        keys = tuple(keys)
        if not sure and expected_bytes(df) <= self.hot_rows * LEAST_ROW_BYTES:
            return HotKeys(keys, self)
        cell = F.pmod(F.xxhash64(*keys), F.lit(CELLS))
        cells = saved(df.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_rows")), "cells")
        found = cells.agg(
            F.sum("_rows").alias("total"), F.max("_rows").alias("most"), F.count_if(F.col("_rows") > self.hot_rows).alias("large")
        ).first()
        least = max(self.hot_rows, (found["total"] or 0) * self.hot_share)
        if (found["most"] or 0) <= least:
            return HotKeys(keys, self)
        candidates = df.select(*keys)
        # With the default limits there are few large cells; where nearly all are, they would tell nothing.
        if min(found["large"], found["total"] / max(least, 1)) <= MOST_BROADCAST:
            marked = cells.where(F.col("_rows") > least).select("_cell")
            candidates = candidates.join(F.broadcast(marked), cell == F.col("_cell"), "left_semi")
        counts = candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > least)
        table = saved(counts, "hot-keys")
        size = table.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
        return HotKeys(keys, self, table, size["keys"], size["rows"]) if size["keys"] else HotKeys(keys, self)


@dataclass(frozen=True)
class HotKeys:
    """Hot keys of a table (``table``: the key columns and ``_rows``; None if there are none)."""

    keys: tuple[str, ...]
    heat: Heat
    table: DataFrame | None = None
    count: int = 0
    rows: int = 0

    def find(self, df: DataFrame, keys: Sequence[str], sure: bool = False) -> HotKeys:
        """This list, found before; operators call it like ``Heat.find``."""
        if tuple(keys) != self.keys:
            raise ValueError(f"hot keys are of {self.keys}, not {tuple(keys)}")
        return self

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``(cold, hot)`` rows of ``df``, which together are ``df``; ask only if there is a list."""
        marks, match = aside(self.table.select(*self.keys), self.keys)
        # Unasked, the optimizer would broadcast millions of keys by the few bytes they take in files.
        marks = F.broadcast(marks) if self.count <= MOST_BROADCAST else marks.hint("merge")
        return df.join(marks, match, "left_anti"), df.join(marks, match, "left_semi")

    def in_ranges(self, hot: DataFrame, order: Sequence[Column], name: str = "_range") -> DataFrame:
        """Hot rows cut in ``order`` into pieces of about equal size, numbered by ``name``.

        Spark's range partitioner draws the quantiles of (key, order) and deals the
        rows; a piece is a partition, so pieces follow each other in the order, and
        rows that tie are in one. The result is written, so that every use of it
        sees the same pieces, also after an executor is lost. Pieces are
        small against a task, and many, so the windows over them are dealt evenly
        even if a key has all its rows on one day. Beyond ``MOST_RANGES`` they get larger
        instead: every one is a task that the driver plans, samples for and hears from.
        """
        pieces = min(max(1, math.ceil(self.rows / self.heat.range_rows)), MOST_RANGES)
        dealt = hot.repartitionByRange(pieces, *self.keys, *order)
        return saved(dealt.withColumn(name, F.spark_partition_id()), "ranges")


def aside(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``df`` with ``keys`` renamed, and null-safe equality with the original names.

    Lets a table join what was derived from it without ambiguous columns.
    """
    renamed = {k: f"_aside_{k}" for k in keys}
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in renamed.items()])
    return df.withColumnsRenamed(renamed), match
