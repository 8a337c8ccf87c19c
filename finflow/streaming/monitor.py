"""What running queries report about themselves."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from finflow.sources.files import write_text

PROGRESS = (
    "query_id string, run_id string, name string, batch_id bigint, started string,"
    " input_rows bigint, input_rows_per_second double, processed_rows_per_second double,"
    " duration_ms bigint, state_rows bigint, watermark string, sink string"
)


def _row(progress) -> tuple:
    return (
        str(progress.id),
        str(progress.runId),
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        float(progress.inputRowsPerSecond),
        float(progress.processedRowsPerSecond),
        progress.durationMs.get("triggerExecution"),
        sum(op.numRowsTotal for op in progress.stateOperators),
        (progress.eventTime or {}).get("watermark"),
        progress.sink.description,
    )


def describe(query: StreamingQuery) -> dict[str, object]:
    """Identity, status, failure and last progress of ``query``."""
    failure = query.exception()
    last = query.lastProgress
    return {
        "id": str(query.id),
        "run_id": str(query.runId),
        "name": query.name,
        "is_active": query.isActive,
        "status": query.status,
        "exception": str(failure) if failure else None,
        "last_batch": last.batchId if last else None,
    }


class ProgressFiles(StreamingQueryListener):
    """Listener that keeps the progress of every batch of all queries of a session below ``path``.

    Spark itself keeps a query's last hundred. A file holds ``rows_per_file`` batches of a
    run, in lines of JSON, and is written anew with each of them: what a query
    reported is on disk before its next batch reports, whatever becomes of the driver.
    Register it with ``spark.streams.addListener`` before queries start.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = 100):
        self.spark, self.path, self.rows_per_file = spark, path, rows_per_file
        self.names = [c.split()[0] for c in PROGRESS.split(", ")]
        self.open: dict[str, tuple[int, list[str]]] = {}
        self.ended: dict[str, str | None] = {}
        self._lock = threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        with self._lock:
            number, lines = self.open.get(run, (0, []))
            if len(lines) == self.rows_per_file:
                number, lines = number + 1, []
            lines.append(json.dumps(dict(zip(self.names, _row(event.progress)))))
            self.open[run] = number, lines
            write_text(self.spark, f"{self.path}/{run}-{number}.json", "\n".join(lines) + "\n")

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._lock:
            self.open.pop(str(event.runId), None)
            self.ended[str(event.runId)] = event.exception
            self._lock.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all that a finished ``query`` reported has arrived; reports follow a query at some distance."""
        until = time.monotonic() + seconds
        with self._lock:
            while str(query.runId) not in self.ended:
                if not self._lock.wait(max(0.0, until - time.monotonic())) and time.monotonic() >= until:
                    return False
        return True

    def table(self) -> DataFrame:
        """All batches reported so far."""
        return self.spark.read.schema(PROGRESS).json(self.path)
