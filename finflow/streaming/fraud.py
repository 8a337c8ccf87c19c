"""The fraud pipeline: lines to transactions to account state to red flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.operators.transactions import (
    RED_FLAG_MARGIN, is_red_flag, parse_lines, safe_average, valid,
)
from finflow.streaming.run import run_available, to_batches
from finflow.streaming.state import (
    KEY, StateTable, keep_state, last_window_end, list_windows, state_intervals, window_totals,
)
from finflow.streaming.windows import with_event_time


def red_flags(states: DataFrame, history: DataFrame, margin: float = RED_FLAG_MARGIN) -> DataFrame:
    """Runs of state whose average, overall or of the window, is far above the account's history.

    ``history`` holds ``account_number`` and ``average_transaction``; accounts
    without history are not judged.
    """
    judged = states.join(history.select(KEY, "average_transaction"), KEY, "inner")
    average = safe_average("total_spending", "num_tx")
    return judged.where(
        is_red_flag(average, F.col("window_avg"), F.col("average_transaction"), margin)
    )


def closed_totals(lines: DataFrame, length: str, delay: str) -> DataFrame:
    """Window totals of the valid transactions in a stream of lines."""
    transactions = valid(parse_lines(lines)).withColumn("ts", F.col("date").cast("timestamp"))
    return window_totals(with_event_time(transactions, "ts", delay), "ts", length)


def run_fraud_stream(
    lines: DataFrame,
    history: DataFrame,
    table: StateTable,
    output: str,
    checkpoint: str,
    length: str = "30 days",
    delay: str = "10 seconds",
    margin: float = RED_FLAG_MARGIN,
) -> None:
    """Process the lines available now; flags go to ``output``, one folder per batch.

    The history is kept for the run, partitioned by account, so that batches do
    not shuffle it again.
    """
    kept = history.select(KEY, "average_transaction").repartition(KEY).persist()
    try:
        handle = keep_state(
            table, length, output=output, evaluate=lambda rows: red_flags(rows, kept, margin)
        )
        run_available(to_batches(closed_totals(lines, length, delay), handle), checkpoint)
    finally:
        kept.unpersist()


def fraud_on_table(
    transactions: DataFrame, history: DataFrame, state: DataFrame, length: str, time: str = "ts",
    margin: float = RED_FLAG_MARGIN,
) -> DataFrame:
    """The same flags for a table of transactions, every window taken as closed.

    Flags are tested by run of equal state; only the flagged runs are listed window by window.
    """
    totals = window_totals(transactions, time, length)
    upto = last_window_end(transactions, time, length)
    flagged = red_flags(state_intervals(state, totals, length, upto), history, margin)
    return list_windows(flagged, length)
