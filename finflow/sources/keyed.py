"""A table with a primary key, kept as a base and a log of batches.

Every batch owns the folder ``batch_id=N`` and overwrites only that, so writing
a batch again after a failure changes nothing. Once there are ``MOST_BATCHES``
of them they are folded into a new base, ``base=N``, that holds the newest row of each
key; the file ``_current`` says which base counts, and is replaced in one step
when the base is complete. What the base before it needed stays until the next
one, for readers that began earlier, so the number of folders is bounded.
Within a stream the table belongs to that stream (see ``files.claim``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.sources.files import claim, current_stream, delete, folder_names, read_text, write_text

MOST_BATCHES = 16

_BATCH = "_batch_id"


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The row of each key that is last in ``order`` (nulls first); combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order)).alias("_row"))
    return newest.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def _current(spark: SparkSession, path: str) -> int | None:
    """The batch up to which the base holds everything."""
    held = read_text(spark, f"{path}/_current")
    return None if held is None else int(held)


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in folder_names(spark, path) if n.startswith(f"{kind}="))


def _log(spark: SparkSession, path: str, base: int | None, last: int | None = None) -> DataFrame:
    """Rows of the base and of the batches after it (up to ``last``), each with its batch."""
    batches = [b for b in _numbers(spark, path, "batch_id") if (base is None or b > base) and (last is None or b <= last)]
    parts = [f"{path}/base={base}"] if base is not None else []
    parts += [f"{path}/batch_id={b}" for b in batches]
    if not parts:
        raise ValueError(f"no table at {path}")
    return spark.read.parquet(*parts)


def _fold(spark: SparkSession, path: str, keys: Sequence[str], base: int | None, last: int) -> None:
    log = _log(spark, path, base, last)
    newest_per_key(log, keys, F.col(_BATCH)).write.mode("overwrite").parquet(f"{path}/base={last}")
    write_text(spark, f"{path}/_current", str(last))
    if base is not None:
        gone = [f"batch_id={b}" for b in _numbers(spark, path, "batch_id") if b <= base]
        gone += [f"base={b}" for b in _numbers(spark, path, "base") if b < base]
        for name in gone:
            delete(spark, f"{path}/{name}")


def upsert_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    keys: Sequence[str],
    files: int | None = None,
    order: Column | None = None,
    most_batches: int = MOST_BATCHES,
) -> None:
    """Write one batch with each key once: the last write in ``order`` wins.

    Rows of a batch have no order of their own; without ``order``, or where it
    ties, the greatest row is kept, so that a repeated batch writes the same. Batches come in
    order of their ids; one that the base holds already was written to its end before, and is passed over.
    """
    spark = batch.sparkSession
    claim(spark, path, current_stream(spark))
    base = _current(spark, path)
    if base is not None and batch_id <= base:
        return
    rest = [c for c in batch.columns if c not in keys]
    whole = F.struct(*rest) if rest else None
    last = whole if order is None else F.struct(order, whole)
    rows = newest_per_key(batch, keys, last) if rest else batch.distinct()
    if files is not None:
        rows = rows.coalesce(files)
    rows.withColumn(_BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    held = [b for b in _numbers(spark, path, "batch_id") if base is None or b > base]
    if len(held) >= most_batches:
        _fold(spark, path, keys, base, held[-1])


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The table as its last writers left it."""
    log = _log(spark, path, _current(spark, path))
    return newest_per_key(log, keys, F.col(_BATCH)).drop(_BATCH)
