"""Joins of streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.streaming.windows import micros


def enrich(stream: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join of a stream with a static table on ``key``."""
    return stream.join(table, key, "inner")


# Length of a cell of time, in lengths of the band: longer cells copy fewer rows, shorter ones spread a key further.
CELL_BANDS = 8


def stream_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    within: str,
    how: str = "inner",
    cell_bands: int = CELL_BANDS,
) -> DataFrame:
    """Pairs with equal keys where ``right_time`` is in ``[left_time, left_time + within]``.

    Both sides need a watermark; it ends the wait for a partner in outer joins.
    Column names must differ between the sides. Time is cut into cells of
    ``cell_bands * within``, and the join is on key and cell: a busy key is spread over
    tasks as time goes on. A row has one cell, but one side is copied to the neighbouring
    cell as well if its band crosses the edge, which an ``1 / cell_bands``-th of the rows do.
    The copied side is never the preserved one; in a full join both are, so its
    right-only rows come from a second join.
    """
    band = micros(left.sparkSession, within)
    # A band of no length fits in cells of any length.
    width = max(band * cell_bands, 1)
    near = F.expr(
        f"`{left_key}` = `{right_key}` and `{right_time}` >= `{left_time}`"
        f" and `{right_time}` <= `{left_time}` + interval {within}"
    )
    columns = [*left.columns, *right.columns]

    def cells(time: str, shift: int, name: str) -> tuple[str, Column]:
        at = F.unix_micros(F.col(time).cast("timestamp"))
        own, other = (F.floor(t / F.lit(width)).cast("bigint") for t in (at, at + F.lit(shift)))
        if shift == 0:
            return name, own
        return name, F.explode_outer(F.when(own == other, F.array(own)).otherwise(F.array(own, other)))

    def one_sided(kind: str) -> DataFrame:
        keeps_right = kind == "right"
        one = left.withColumn(*cells(left_time, band if keeps_right else 0, "_cell"))
        two = right.withColumn(*cells(right_time, 0 if keeps_right else -band, "_other_cell"))
        match = near & (F.col("_cell") == F.col("_other_cell"))
        return one.join(two, match, {"inner": "inner", "left": "leftOuter", "right": "rightOuter"}[kind])

    if how == "full":
        right_only = one_sided("right").where(F.col(left_key).isNull())
        return one_sided("left").select(*columns).unionByName(right_only.select(*columns))
    return one_sided(how).select(*columns)
