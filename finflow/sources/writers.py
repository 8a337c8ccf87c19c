"""Batch sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, files: int | None = None) -> str:
    """Overwrite ``path``; ``files`` lowers the partition count first. Returns ``path``."""
    if files is not None:
        df = df.coalesce(files)
    df.write.mode("overwrite").parquet(path)
    return path


def write_table(
    df: DataFrame,
    path: str | None,
    kind: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    **options: str,
) -> None:
    """Save to an external table; ``kind`` names the connector, ``options`` address the table."""
    writer = df.write.format(kind).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer.save(path)
    else:
        writer.save()


def to_json_rows(df: DataFrame, out: str = "value") -> DataFrame:
    """Each row as a JSON string; null fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias(out))


def for_each_partition(df: DataFrame, handle: Callable[[Iterable[Row]], None]) -> None:
    """Run ``handle`` on the rows of every partition, on the executors.

    A partition may be handled again after a failure, so ``handle`` must
    tolerate repeats.
    """
    df.foreachPartition(handle)


def for_each_row(df: DataFrame, handle: Callable[[Row], None]) -> None:
    """Run ``handle`` on every row, on the executors."""
    df.foreach(handle)
