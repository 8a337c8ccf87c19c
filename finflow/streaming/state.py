"""Running state per account.

``state_intervals`` says the state of every known account in every window, active
or not, as runs of equal state over a state table, in native expressions. For
state that is touched only by accounts with news see ``tracked``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from finflow.schemas import ACCOUNT_STATE
from finflow.streaming.windows import window_aggregate

KEY = "account_number"

_STORED = StructType(list(ACCOUNT_STATE.fields)).add("version", LongType())


def window_totals(transactions: DataFrame, time: str, length: str) -> DataFrame:
    """Spending and number of transactions per account and window; table or stream."""
    return window_aggregate(
        transactions, time, length, [KEY],
        {"spent": F.sum("amount"), "n": F.count("amount")},
    )


def last_window_end(
    transactions: DataFrame, time: str, length: str, before: Column | None = None
) -> Column:
    """End of the newest window with transactions (and an end up to ``before``), as a scalar.

    Found from the times alone, without grouping.
    """
    ends = transactions.select(F.window(time, length)["end"].alias("end"))
    if before is not None:
        ends = ends.where(F.col("end") <= before)
    return ends.agg(F.max("end")).scalar()


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ACCOUNT_STATE)


def state_intervals(
    state: DataFrame,
    totals: DataFrame,
    length: str,
    upto: Column,
    timeout: str | None = None,
    first: Column | None = None,
) -> DataFrame:
    """State of every known account up to the window that ends at ``upto``, as runs of equal state.

    A run is one row: the state columns, and the ends of its first and last window
    (``first_end``, ``last_end``). An account's state changes only in windows with
    transactions; between them one run says the totals of all idle windows, whose
    average is 0. So there are at most two rows for a row of the input, however many
    windows lie between, and one sort of them by account finds all.

    ``state`` holds one row per account as of an earlier window (``ACCOUNT_STATE``),
    ``totals`` the window totals since then. With ``timeout`` an account idle for
    longer than that is forgotten, and starts anew if it returns. A state row without
    ``window_end`` (an initial state) is first visited in the window that ends at
    ``first``, or else only at ``upto``.
    """
    micros = lambda time: F.unix_micros(time.cast("timestamp"))
    span = lambda text: micros(F.lit("1970-01-01 00:00:00").cast("timestamp") + F.expr(f"interval {text}"))
    step, end = span(length), micros(upto)
    # What is known of an account comes before its news; both as microseconds.
    since = F.coalesce(F.col("window_end"), upto - F.expr(f"interval {length}") if first is None else first - F.expr(f"interval {length}"))
    known = state.select(
        KEY,
        F.lit(0).alias("_kind"),
        micros(since).alias("_at"),
        F.coalesce("total_spending", F.lit(0.0)).alias("_base"),
        F.coalesce("num_tx", F.lit(0)).cast("bigint").alias("_base_n"),
        micros(F.col("last_seen")).alias("_seen"),
        F.lit(None).cast("double").alias("_spent"),
        F.lit(0).cast("bigint").alias("_n"),
    )
    news = totals.where(F.col("window_end") <= upto).select(
        KEY,
        F.lit(1).alias("_kind"),
        micros(F.col("window_end")).alias("_at"),
        F.lit(None).cast("double").alias("_base"),
        F.lit(None).cast("bigint").alias("_base_n"),
        micros(F.col("window_end")).alias("_seen"),
        F.coalesce("spent", F.lit(0.0)).alias("_spent"),
        F.col("n").cast("bigint").alias("_n"),
    )
    in_order = Window.partitionBy(KEY).orderBy("_kind", "_at")
    marks = known.unionByName(news).select(
        "*",
        F.coalesce(F.lead("_at").over(in_order) - step, end).alias("_until"),
        F.lag("_seen").over(in_order).alias("_before"),
        F.first("_base").over(in_order).alias("_from"),
        F.first("_base_n").over(in_order).alias("_from_n"),
    )
    life = F.lit(0)
    if timeout is not None:
        patience = span(timeout)
        returns = (F.col("_kind") == 1) & (F.col("_at") - step - patience > F.col("_before"))
        marks = marks.withColumn("_returns", F.when(returns, 1).otherwise(0))
        marks = marks.withColumn("_until", F.least("_until", F.col("_seen") + patience))
        life = F.sum("_returns").over(in_order)
    marks = marks.withColumn("_life", life)
    lived = (
        Window.partitionBy(KEY, "_life").orderBy("_kind", "_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = F.col("_life") == 0
    marks = marks.select(
        KEY, "_kind", "_at", "_until", "_seen", "_spent", "_n",
        (F.coalesce(F.sum("_spent").over(lived), F.lit(0.0)) + F.when(carried, F.coalesce("_from", F.lit(0.0))).otherwise(0.0))
        .alias("total_spending"),
        (F.sum("_n").over(lived) + F.when(carried, F.coalesce("_from_n", F.lit(0))).otherwise(0)).alias("num_tx"),
    )
    # A window with transactions, then the idle ones up to the next.
    run = lambda begin, until, average: F.struct(begin.alias("begin"), until.alias("until"), average.alias("window_avg"))
    idle = run(F.col("_at") + step, F.col("_until"), F.lit(0.0))
    average = F.when(F.col("_n") > 0, F.col("_spent") / F.col("_n")).otherwise(F.lit(0.0))
    active = run(F.col("_at"), F.col("_at"), average)
    runs = marks.select("*", F.explode(F.when(F.col("_kind") == 1, F.array(active, idle)).otherwise(F.array(idle))).alias("_run"))
    windows = F.floor((F.col("_run.until") - F.col("_run.begin")) / step)
    return runs.where(F.col("_run.begin") <= F.col("_run.until")).select(
        KEY, "total_spending", "num_tx", "_run.window_avg",
        F.timestamp_micros("_run.begin").alias("first_end"),
        F.timestamp_micros(F.col("_run.begin") + windows * step).alias("last_end"),
        F.timestamp_micros("_seen").alias("last_seen"),
    )


def list_windows(intervals: DataFrame, length: str) -> DataFrame:
    """Each run of ``state_intervals`` as one row per window, with ``window_end``."""
    ends = F.explode(F.sequence("first_end", "last_end", F.expr(f"interval {length}")))
    return intervals.select("*", ends.alias("window_end")).select(*ACCOUNT_STATE.names)


def advance_state(
    state: DataFrame,
    totals: DataFrame,
    length: str,
    upto: Column,
    timeout: str | None = None,
    first: Column | None = None,
) -> DataFrame:
    """State of every known account after each window up to the one ending at ``upto``.

    The runs of ``state_intervals``, listed. Whoever asks for a few windows or accounts
    only should filter the runs first.
    """
    return list_windows(state_intervals(state, totals, length, upto, timeout, first), length)


class StateTable:
    """Versions of the account state in a few folders that are overwritten in turn.

    A version is named by the micro-batch that wrote it. Batch ``n`` reads the
    newest version before ``n`` and writes the next folder, so running it again
    gives the same and storage stays bounded.
    """

    def __init__(
        self, spark: SparkSession, path: str, initial: DataFrame | None = None,
        folders: int = 3, partitions: int | None = None,
    ):
        self.spark, self.path, self.folders, self.partitions = spark, path, folders, partitions
        if not self._exists():
            self._write(empty_state(spark) if initial is None else initial, -1, 0)

    def _exists(self) -> bool:
        try:
            self.spark.read.parquet(self.path)
            return True
        except AnalysisException:
            return False

    def _write(self, state: DataFrame, version: int, folder: int) -> None:
        names = ACCOUNT_STATE.names
        state = state.select(*names, F.lit(version).cast("bigint").alias("version"))
        if self.partitions:
            state = state.repartition(self.partitions, KEY)
        state.write.mode("overwrite").parquet(f"{self.path}/folder={folder}")

    def locate(self, before: int | None = None) -> tuple[int, int]:
        """Folder and version of the newest state, or of the newest from a batch before ``before``.

        A version after ``before`` means that the stream lost its checkpoint and
        counts batches from zero again; going on would count transactions twice.
        """
        versions = self.spark.read.parquet(self.path).select("folder", "version")
        place = F.struct("version", "folder")
        if before is not None:
            place = F.when(F.col("version") < before, place)
        newest, latest = versions.agg(F.max(place), F.max("version")).first()
        if before is not None and latest is not None and latest > before:
            raise ValueError(f"state at {self.path} is from batch {latest}, after batch {before}")
        return (newest["folder"], newest["version"]) if newest else (0, -1)

    def read(self, located: tuple[int, int] | None = None) -> DataFrame:
        """The newest state, or the one found by ``locate``."""
        folder, version = located or self.locate()
        state = self.spark.read.schema(_STORED).parquet(f"{self.path}/folder={folder}")
        return state.where(F.col("version") == version).select(*ACCOUNT_STATE.names)

    def write(self, state: DataFrame, version: int, after: tuple[int, int]) -> None:
        """Write ``version`` to the folder that follows the one of ``after``."""
        self._write(state, version, (after[0] + 1) % self.folders)


def keep_state(
    table: StateTable,
    length: str,
    timeout: str | None = None,
    output: str | None = None,
    evaluate=None,
):
    """Handler for a stream of closed ``window_totals``: advances ``table`` batch by batch.

    The state after each new window goes to ``output``, one folder per batch;
    ``evaluate`` may choose among the runs (``state_intervals``) before their windows
    are listed.
    """

    def handle(totals: DataFrame, batch_id: int) -> None:
        totals = totals.persist()
        try:
            first, last = totals.agg(
                F.min("window_end").cast("string"), F.max("window_end").cast("string")
            ).first()
            if last is None:
                return
            begin, end = F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")
            known = table.locate(before=batch_id)
            runs = state_intervals(table.read(known), totals, length, end, timeout, begin).persist()
            try:
                last_runs = runs.where((F.col("first_end") <= end) & (end <= F.col("last_end")))
                table.write(last_runs.withColumn("window_end", end), batch_id, known)
                if output is not None:
                    chosen = evaluate(runs) if evaluate else runs
                    listed = list_windows(chosen, length)
                    listed.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
            finally:
                runs.unpersist()
        finally:
            totals.unpersist()

    return handle
