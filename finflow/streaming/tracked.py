"""Running state of the accounts that have news, on Spark's own state store.

``track_active`` runs a Python function over groups of accounts in each batch: for state that
built-in aggregates cannot say, such as totals that start from a seed and end
when an account has been idle for too long. Where totals are enough,
``active_totals`` is a native streaming aggregate. ``state_snapshot`` reads what
the store holds from the checkpoint, without the stream running.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from finflow.streaming.state import KEY
from finflow.streaming.windows import micros

# Spark itself joins the state function's output to empty frames, once per account.
warnings.filterwarnings("ignore", message="The behavior of DataFrame concatenation with empty", category=FutureWarning)

_PARTIAL = f"{KEY} string, window_start timestamp, spent double, n bigint, first timestamp, last timestamp, seed boolean, at timestamp"
_TRACKED = f"{KEY} string, total_spending double, num_tx bigint, window_avg double, last_seen timestamp, expired boolean"
_NAMES = [KEY, "total_spending", "num_tx", "window_avg", "last_seen", "expired"]
# An account's state: times in microseconds; ``seen`` is the last transaction.
_FIELDS = {"total": "double", "n": "bigint", "window_start": "bigint", "window_sum": "double", "window_n": "bigint", "seen": "bigint"}
# A group holds its accounts' states side by side.
_STATE = ", ".join(["account array<string>", *(f"{name} array<{kind}>" for name, kind in _FIELDS.items())])
_NEVER = -(2**62)
_NEW = (0.0, 0, _NEVER, 0.0, 0, _NEVER)
# Groups that accounts are dealt to by hash.
GROUPS = 1024


def active_totals(stream: DataFrame, time: str, length: str) -> DataFrame:
    """Spending and number of transactions per account and window, for update mode.

    With a watermark on ``time`` the store drops windows that are closed.
    """
    window = F.window(time, length)["start"].alias("window_start")
    return stream.groupBy(KEY, window).agg(F.sum("amount").alias("spent"), F.count("amount").alias("n"))


def _sum_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Totals per account and window of each Arrow batch, ahead of the shuffle."""
    for rows in batches:
        sums = rows.groupby([KEY, "window_start"], as_index=False, dropna=False).agg(
            spent=("amount", "sum"), n=("amount", "count"), first=("_time", "min"), last=("_time", "max")
        )
        yield sums.assign(seed=False, at=sums["last"])


def _micros(times: pd.Series) -> list[int]:
    return times.to_numpy().astype("datetime64[us]").astype("int64").tolist()


def _rows(states: dict, expired: set) -> pd.DataFrame:
    """States as the stream shows them."""
    totals, counts, _, sums, window_counts, seen = zip(*states.values())
    averages = [s / n if n else 0.0 for s, n in zip(sums, window_counts)]
    times = pd.to_datetime(pd.Series(seen, dtype="int64"), unit="us")
    ended = [account in expired for account in states]
    columns = (pd.Series(list(states), dtype=object), totals, counts, averages, times, ended)
    return pd.DataFrame(dict(zip(_NAMES, columns)))


def _added(state: tuple, news: Iterator[tuple], patience: int | None) -> tuple:
    """``state`` after ``news``: (window start, spent, n, first and last time) in order of windows."""
    total, n, start, window_sum, window_n, seen = state
    for window, spent, count, first, last in news:
        if patience is not None and seen != _NEVER and first - seen > patience:
            total, n, start, window_sum, window_n, seen = _NEW
        total, n, seen = total + spent, n + count, max(seen, last)
        if window > start:
            start, window_sum, window_n = window, 0.0, 0
        if window == start:
            window_sum, window_n = window_sum + spent, window_n + count
    return total, n, start, window_sum, window_n, seen


def _tracker(patience: int | None) -> Callable:
    def track(key: tuple, partials: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = dict(zip((stored := state.get)[0], zip(*stored[1:]))) if state.exists else {}
        seeds, news = {}, {}
        for rows in partials:
            accounts = rows[KEY].astype(object).where(rows[KEY].notna(), None).tolist()
            times = zip(_micros(rows["first"]), _micros(rows["last"]))
            values = zip(rows["seed"].tolist(), _micros(rows["window_start"]), rows["spent"].tolist(), rows["n"].tolist(), times)
            for account, (seed, window, spent, n, (first, last)) in zip(accounts, values):
                windows = news.setdefault(account, {})
                if seed:
                    seeds.setdefault(account, []).append((spent, n, last))
                elif window in windows:
                    old = windows[window]
                    windows[window] = (old[0] + spent, old[1] + n, min(old[2], first), max(old[3], last))
                else:
                    windows[window] = (spent, n, first, last)
        told, expired = {}, set()
        if patience is not None:
            now = state.getCurrentWatermarkMs()
            for account in [a for a, s in held.items() if a not in news and (s[-1] + patience) // 1000 < now]:
                told[account] = held.pop(account)
                expired.add(account)
        for account, windows in news.items():
            before = held.get(account, _NEW)
            if account in seeds and before == _NEW:
                spent, n, last = max(seeds[account])
                before = (spent, n, _NEVER, 0.0, 0, last)
            told[account] = held[account] = _added(before, ((w, *windows[w]) for w in sorted(windows)), patience)
        if held:
            state.update((list(held), *map(list, zip(*held.values()))))
            if patience is not None:
                due = (min(s[-1] for s in held.values()) + patience) // 1000
                state.setTimeoutTimestamp(max(due, now + 1))
        elif state.exists:
            state.remove()
        if told:
            yield _rows(told, expired)

    return track


def track_active(
    stream: DataFrame,
    time: str,
    length: str,
    patience: str | None = None,
    seeds: DataFrame | None = None,
    delay: str = "10 seconds",
    groups: int = GROUPS,
) -> DataFrame:
    """Updated state of the accounts with news, one row per account and micro-batch.

    Spark calls a Python state function once per key and batch, at milliseconds a call whatever
    it does. The key is therefore one of ``groups`` hashes of the account, and a call goes through all
    news of its group; a group with news has its accounts' states rewritten. More groups
    mean more calls and less to rewrite; the number stays as the checkpoint's first run had it.

    ``window_avg`` is the average of the newest window the account was active in.
    Transactions are summed per Arrow batch and window before the shuffle, so a busy
    account sends a few rows to its task rather than all of its transactions.

    With ``patience`` (at least ``length``) an account idle for longer is forgotten: once
    the watermark, ``delay`` behind the newest transaction, has passed that time, a last
    row says ``expired``; if it returns it starts from nothing, in whatever batch.
    Transactions must then arrive in order of time up to ``delay``.

    ``seeds`` is a stream (``account_number, total_spending, num_tx, last_seen``) whose
    rows all come in its first batch: the state accounts start from. A seed for an account that
    has state already is ignored; of several for one account the largest counts.
    """
    spark = stream.sparkSession
    limit = None if patience is None else micros(spark, patience)
    if limit is not None and limit < micros(spark, length):
        raise ValueError(f"patience {patience} is shorter than a window of {length}")
    windowed = stream.select(
        KEY, F.window(time, length)["start"].alias("window_start"), "amount", F.col(time).alias("_time")
    )
    partial = windowed.mapInPandas(_sum_batches, _PARTIAL)
    if seeds is not None:
        partial = partial.unionByName(
            seeds.select(
                KEY, F.lit("1970-01-01").cast("timestamp").alias("window_start"), F.col("total_spending").cast("double").alias("spent"),
                F.col("num_tx").cast("bigint").alias("n"), F.col("last_seen").alias("first"), F.col("last_seen").alias("last"),
                F.lit(True).alias("seed"), F.lit(None).cast("timestamp").alias("at"),
            )
        )
    if limit is not None:
        # The newest time of a partial sum is what makes it late, and what moves the watermark. Seeds do neither.
        partial = partial.withWatermark("at", delay)
    timeout = GroupStateTimeout.NoTimeout if limit is None else GroupStateTimeout.EventTimeTimeout
    grouped = partial.withColumn("_group", F.pmod(F.xxhash64(KEY), F.lit(groups))).groupBy("_group")
    return grouped.applyInPandasWithState(_tracker(limit), _TRACKED, _STATE, "update", timeout)


def state_snapshot(spark: SparkSession, checkpoint: str) -> DataFrame:
    """State of all accounts of a ``track_active`` stream as its last batch left it, read from the state store."""
    group = spark.read.format("statestore").load(checkpoint).select("value.groupState.*")
    held = group.select(F.inline(F.arrays_zip("account", *_FIELDS)))
    average = F.when(F.col("window_n") > 0, F.col("window_sum") / F.col("window_n")).otherwise(F.lit(0.0))
    return held.select(
        F.col("account").alias(KEY), F.col("total").alias("total_spending"), F.col("n").alias("num_tx"),
        average.alias("window_avg"), F.timestamp_micros("seen").alias("last_seen"),
    )
