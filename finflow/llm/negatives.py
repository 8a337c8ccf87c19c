"""Hard negatives by slots of the score axis.

The positives of an anchor, best first, set falling upper limits for its negatives. The
limits cut the scores into disjoint slots: slot ``i`` lies above limit ``i + 1`` and up to
limit ``i``, so a negative belongs to one slot and may serve the windows of positives 1 to
``i``. Each task scores its rows against the anchors in matrix blocks and keeps the best k
of each slot; a ranked shuffle keeps the best k of those. The first k of window ``j`` are
then the first k of its suffix of slots ``j, j + 1, ...``, read in falling order. All windows
of an anchor, however they overlap, are answered by at most k rows per slot and task.

Anchors are the stated query set. They are taken in blocks of bounded size, each of
which meets all rows in two passes: positives, then negatives. Within a block the driver
holds its anchors and their few positives.

Edge cases: rows with a null label, or a vector that is null, empty or holds null or
non-finite entries, take no part. Vectors of different lengths do not meet. Repeated rows
are rows of their own: a copy of the anchor can be its positive, a copied negative is
returned twice. A null id comes after all others among ties and is no anchor unless the
caller's condition says so. Scores are exact and cut at the range of a long. An anchor
without positives, or a window without negatives, gives no row; an empty table gives none.
Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finflow.llm.vectors import matrices, scaled
from finflow.session import work_folder

MOST_ANCHORS = 8_192  # in a block
MOST_BYTES = 16 << 20  # of the vectors of a block
_PAIRS = 1 << 20  # scores worked on at a time

_LEAST, _MOST = -(2**63) + 1, 2**63 - 1
_RANKED = "anchor int, slot int, score long, id long"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Block:
    """Anchors of one block; ``groups`` holds, by length, their numbers and integer vectors."""

    ids: list[int | None]
    labels: np.ndarray
    groups: dict[int, tuple[np.ndarray, np.ndarray]]


def _blocks(rows: DataFrame, anchors: Column, scale: int) -> Iterator[Block]:
    """The anchors, streamed to the driver and cut into blocks."""
    held, size = [], 0
    for row in rows.where(anchors).select("id", "label", "vector").toLocalIterator():
        held.append(row)
        size += 8 * len(row["vector"] or ())
        if len(held) == MOST_ANCHORS or size >= MOST_BYTES:
            yield _block(held, scale)
            held, size = [], 0
    if held:
        yield _block(held, scale)


def _block(held: list, scale: int) -> Block:
    vectors = pa.array([r["vector"] for r in held], pa.list_(pa.float64()))
    groups = {x.shape[1]: (at, scaled(x, scale)) for at, x in matrices(vectors)}
    return Block([r["id"] for r in held], np.array([r["label"] for r in held], np.int64), groups)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of integer matrices, cut at the range of a long."""
    reach = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if reach < 2**53:  # doubles hold every partial sum
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if reach < 2**63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, _LEAST, _MOST).astype(np.int64)


@dataclass
class Best:
    """The best k rows of each anchor and slot seen so far: higher scores first, then smaller ids, null last."""

    k: int
    columns: tuple[np.ndarray, ...] = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool, np.int64))

    def add(self, anchor, slot, score, missing, ids) -> None:
        found = [np.concatenate(pair) for pair in zip(self.columns, (anchor, slot, score, missing, ids))]
        anchor, slot, score, missing, ids = found
        order = np.lexsort((ids, missing, -score, slot, anchor))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(anchor[order]) != 0) | (np.diff(slot[order]) != 0)
        place = np.arange(len(order))
        rank = place - np.maximum.accumulate(np.where(first, place, 0))
        self.columns = tuple(c[order[rank < self.k]] for c in found)

    def batch(self) -> pa.RecordBatch:
        anchor, slot, score, missing, ids = self.columns
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(score), pa.array(ids, mask=missing)],
            ["anchor", "slot", "score", "id"],
        )


def _scores(batches: Iterator[pa.RecordBatch], block: Block, scale: int):
    """``(anchor numbers, labels, ids, id is null, scores)`` of every block of pairs."""
    for batch in batches:
        ids = batch.column(0)
        missing = np.asarray(ids.is_null())
        ids, labels = np.asarray(ids.fill_null(0)), np.asarray(batch.column(1))
        for at, matrix in matrices(batch.column(2)):
            if matrix.shape[1] not in block.groups:
                continue
            numbers, vectors = block.groups[matrix.shape[1]]
            x = scaled(matrix, scale)
            step = max(1, _PAIRS // len(numbers))
            for begin in range(0, len(at), step):
                part = at[begin : begin + step]
                yield numbers, labels[part], ids[part], missing[part], inner_products(vectors, x[begin : begin + step])


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _positives(rows: DataFrame, block: Block, k: int, scale: int) -> list[list[tuple[int, int | None]]]:
    """``(score, id)`` of the first k other rows of each anchor's label, best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k + 1)  # the anchor itself may be among them
        for numbers, labels, ids, missing, scores in _scores(batches, block, scale):
            a, r = np.nonzero(block.labels[numbers][:, None] == labels)
            best.add(numbers[a], np.zeros(len(a), np.int64), scores[a, r], missing[r], ids[r])
        yield best.batch()

    found = [[] for _ in block.ids]
    for row in _first(rows.mapInArrow(run, _RANKED), k + 1, "anchor").orderBy("anchor", "rank").collect():
        found[row["anchor"]].append((row["score"], row["id"]))
    for numbers, vectors in block.groups.values():
        for number, vector in zip(numbers, vectors):
            itself = (int(inner_products(vector[None], vector[None])[0, 0]), block.ids[number])
            if itself in found[number]:
                found[number].remove(itself)
    return [f[:k] for f in found]


def _negatives(rows: DataFrame, block: Block, upper: np.ndarray, lower: np.ndarray, k: int, scale: int) -> DataFrame:
    """The first k rows of another label in each anchor's slots: ``anchor, slot, score, id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        for numbers, labels, ids, missing, scores in _scores(batches, block, scale):
            slot = np.zeros(scores.shape, np.int8)
            wanted = np.zeros(scores.shape, bool)
            for i in range(upper.shape[1]):  # limits fall, so the last one that holds names the slot
                below = scores <= upper[numbers, i][:, None]
                slot += below
                # No window that reaches slot i + 1 goes below the lower limit of its positive.
                wanted = np.where(below, scores >= lower[numbers, i][:, None], wanted)
            a, r = np.nonzero(wanted & (block.labels[numbers][:, None] != labels))
            best.add(numbers[a], slot[a, r].astype(np.int64), scores[a, r], missing[r], ids[r])
        yield best.batch()

    return _first(rows.mapInArrow(run, _RANKED), k, "anchor", "slot").drop("rank")


def _mined(rows: DataFrame, block: Block, positives: int, negatives: int, floor: int, ceiling: int, scale: int) -> DataFrame:
    spark = rows.sparkSession
    best = _positives(rows, block, positives, scale)
    # floor * p <= 100 * n <= ceiling * p for integers n, without a division. Absent positives get empty windows.
    upper = np.full((len(best), positives), _LEAST - 1, np.int64)
    lower = np.full((len(best), positives), _MOST, np.int64)
    windows = []
    for number, found in enumerate(best):
        for i, (score, id_) in enumerate(found):
            upper[number, i] = max(_LEAST, min(_MOST, ceiling * score // 100))
            lower[number, i] = max(_LEAST, min(_MOST, -(-floor * score // 100)))
            windows.append((number, i + 1, block.ids[number], id_, score, int(lower[number, i])))
    slots = _negatives(rows, block, upper, lower, negatives, scale)
    reached = slots.select("anchor", F.explode(F.sequence(F.lit(1), "slot")).alias("window"), "score", "id")
    table = spark.createDataFrame(
        windows, "anchor int, window int, anchor_id long, positive_id long, positive_score long, lower long"
    )
    inside = reached.join(F.broadcast(table), ["anchor", "window"]).where("score >= lower")
    return _first(inside, negatives, "anchor", "window").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def mine(
    rows: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    label: str = "label",
    column: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    floor: int = 80,
    ceiling: int = 100,
    scale: int = 256,
) -> DataFrame:
    """Per anchor and positive, the first rows of another label that score ``floor`` to ``ceiling`` percent of it.

    ``anchors`` is a condition on ``rows``. The windows' limits must fall with the
    positives, so ``floor`` and ``ceiling`` are not negative.
    """
    if floor < 0 or ceiling < 0:
        raise ValueError("floor and ceiling must not be negative")
    taking = rows.where(F.col(label).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(column).cast("array<double>").alias("vector"), anchors.alias("anchor"),
    )
    own, spark = taking.drop("anchor"), rows.sparkSession
    path, none = work_folder(spark, "negatives"), spark.createDataFrame([], _RESULT)
    none.write.parquet(path)
    for block in _blocks(taking, F.col("anchor"), scale):
        _mined(own, block, positives, negatives, floor, ceiling, scale).write.mode("append").parquet(path)
    return spark.read.schema(_RESULT).parquet(path)
