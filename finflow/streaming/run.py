"""Starting, awaiting and stopping streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from finflow.sources.files import claim, current_stream


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a query: a batch ``every`` interval, or else on what is there now.

    Starting again with the same ``checkpoint`` continues where the last run
    stopped.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def finish(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for ``query`` and stop it; False if it was still running after ``timeout`` seconds.

    A failure of the query is raised.
    """
    try:
        if timeout is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(timeout))
    finally:
        query.stop()


def run_available(
    writer: DataStreamWriter, checkpoint: str, timeout: float | None = None
) -> StreamingQuery:
    """Process everything available, in as many batches as the source asks for."""
    query = start(writer, checkpoint)
    if not finish(query, timeout):
        raise TimeoutError(f"stream still running after {timeout} seconds")
    return query


def to_files(
    stream: DataFrame, path: str, kind: str = "parquet", partition_by: tuple[str, ...] = ()
) -> DataStreamWriter:
    """Writer that appends each finished row to files once."""
    writer = stream.writeStream.format(kind).outputMode("append").option("path", path)
    return writer.partitionBy(*partition_by) if partition_by else writer


def to_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append"
) -> DataStreamWriter:
    """Writer that hands each micro-batch to ``handle(batch, batch_id)``.

    A batch may be empty, and may come again with the same id after a failure.
    """
    return stream.writeStream.outputMode(mode).foreachBatch(handle)


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Handler that writes each batch to its own folder; a repeated batch replaces itself.

    The folder belongs to the stream that first wrote to it; another, or the same one
    after its checkpoint was lost, is refused.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        claim(batch.sparkSession, path, current_stream(batch.sparkSession))
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle
