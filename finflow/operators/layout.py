"""Partition-level operators, sampling and splitting."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from finflow.session import cut_lineage


def glom(df: DataFrame, column: str, out: str = "items") -> DataFrame:
    """The values of ``column`` as arrays: one row per Arrow batch of a partition.

    Batches are bounded by ``spark.sql.execution.arrow.maxRecordsPerBatch``, so
    a large partition becomes several arrays instead of one that cannot be held.
    Columns: ``partition_id``, ``chunk``, ``out``. No shuffle.
    """
    kind = df.schema[column].dataType.simpleString()
    schema = f"partition_id int, chunk int, {out} array<{kind}>"
    source = df.select(F.spark_partition_id().alias("partition_id"), F.col(column))
    target = to_arrow_schema(StructType.fromDDL(schema))

    def pack(batches):
        for chunk, batch in enumerate(batches):
            values = batch.column(1)
            offsets = pa.array([0, len(values)], pa.int32())
            items = pa.ListArray.from_arrays(offsets, values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(0, 1),
                    pa.array([chunk], pa.int32()),
                    items.cast(target.field(2).type),
                ],
                names=["partition_id", "chunk", out],
            )

    return source.mapInArrow(pack, schema)


def expected_bytes(df: DataFrame) -> int:
    """Size the optimizer expects ``df`` to have; costs no job, and knows nothing of what filters leave."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions_for(df: DataFrame, partition_bytes: int = 128 << 20) -> int:
    """Partitions of about ``partition_bytes`` that ``df`` makes, by its expected size."""
    return max(1, math.ceil(expected_bytes(df) / partition_bytes))


def _unit_interval(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) that depends on the row's key alone."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def stable_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    """About ``fraction`` of the rows, the same ones on every run and every cluster.

    ``DataFrame.sample`` depends on partitioning; a task that is run again after
    an executor is lost could choose other rows.
    """
    return df.where(_unit_interval(keys, seed) < F.lit(fraction))


def stable_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 0, out: str = "part"
) -> DataFrame:
    """Add ``out``: the index of the random part each row belongs to.

    Parts are disjoint and cover ``df`` by construction; filter on ``out`` to
    get one.
    """
    total = float(sum(weights))
    if total <= 0 or min(weights) < 0:
        raise ValueError("weights must be positive")
    draw = _unit_interval(keys, seed)
    part = F.lit(len(weights) - 1)
    bound = total
    for index in range(len(weights) - 2, -1, -1):
        bound -= weights[index + 1]
        part = F.when(draw < F.lit(bound / total), F.lit(index)).otherwise(part)
    return df.withColumn(out, part)


def _tagged(df: DataFrame) -> DataFrame:
    """``df`` as it is laid out now: ``_seq`` counts on inside each partition, ``_part`` is the partition.

    The layout is saved first, so that every use sees the same one.
    """
    return cut_lineage(df.withColumn("_seq", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_seq", 33))


def positioned(df: DataFrame, out: str = "position") -> DataFrame:
    """Number rows from 1 in the order ``df`` has, partition after partition."""
    tagged = _tagged(df)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_seq")
    numbered = tagged.withColumn("_own", F.row_number().over(inside)).join(sizes, "_part")
    return numbered.withColumn(out, F.col("_before") + F.col("_own")).drop("_part", "_seq", "_own", "_before")


def in_order(df: DataFrame, order: Sequence[str], out: str = "in_order") -> DataFrame:
    """Mark each row that is not smaller in ``order`` than the row before it in its partition."""
    inside = Window.partitionBy("_part").orderBy("_seq")
    before = F.lag(F.struct(*order)).over(inside)
    marked = _tagged(df).withColumn(out, F.coalesce(before <= F.struct(*order), F.lit(True)))
    return marked.drop("_part", "_seq")
