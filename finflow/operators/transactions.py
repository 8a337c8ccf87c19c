"""Bank transactions: line parsing, account aggregates and fraud marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.functions.dates import lenient_us_date, strict_us_date
from finflow.operators.aggregates import profile

# A spending average this far above history, or a single amount
# above this, is suspicious.
RED_FLAG_MARGIN = 2000.0
FRAUD_AMOUNT = 4000.0

# Reasons a line is set aside, in the order they are checked.
FIELD_COUNT = "field_count"
BAD_ID = "bad_id"
BAD_DATE = "bad_date"
BAD_AMOUNT = "bad_amount"


def parse_lines(lines: DataFrame, line: str = "value", strict: bool = False) -> DataFrame:
    """Split lines ``id,MM/dd/yyyy,account,amount,description`` into typed columns.

    Adds ``line`` and ``error``; ``error`` is null exactly for good lines. Works
    on tables and streams, in built-in expressions only. Empty fields at the end
    do not count as fields, so a line needs a description. ``strict`` refuses
    dates off the calendar, which are otherwise carried over (13/45 is February
    14 of the next year).
    """
    kept = [c for c in lines.columns if c != line]
    to_date = strict_us_date if strict else lenient_us_date
    # Step by step, so that each part is computed once and then read by name.
    fields = lines.select(
        *kept, F.col(line).alias("line"), F.split(F.rtrim(line, F.lit(",")), ",", -1).alias("_fields")
    )
    parts = fields.select(
        *kept,
        "line",
        F.coalesce(F.size("_fields"), F.lit(0)).alias("_count"),
        *[F.get("_fields", F.lit(i)).alias(f"_part{i}") for i in range(5)],
    )
    typed = parts.select(
        *kept,
        "line",
        "_count",
        F.when(F.col("_part0").rlike("^[+-]?[0-9]+$"), F.col("_part0").try_cast("bigint")).alias("_id"),
        F.col("_part2").alias("_account"),
        to_date(F.col("_part1")).alias("_date"),
        F.when(~_misspelled(F.col("_part3")), F.col("_part3").try_cast("double")).alias("_amount"),
        F.col("_part4").alias("_description"),
    )
    error = (
        F.when(F.col("_count") != 5, FIELD_COUNT)
        .when(F.col("_id").isNull(), BAD_ID)
        .when(F.col("_date").isNull(), BAD_DATE)
        .when(F.col("_amount").isNull(), BAD_AMOUNT)
    )
    good = F.col("error").isNull()
    return typed.withColumn("error", error).select(
        *kept,
        "line",
        "error",
        F.when(good, F.col("_id")).alias("id"),
        F.when(good, F.col("_account")).alias("account_number"),
        F.when(good, F.col("_date")).alias("date"),
        F.when(good, F.col("_amount")).alias("amount"),
        F.when(good, F.col("_description")).alias("description"),
    )


def _misspelled(amount: Column) -> Column:
    """Casts take ``nan`` and ``inf`` in any spelling; an amount may only say ``NaN`` or ``Infinity``.

    Only what ends like one of these words is looked at closely.
    """
    text = F.trim(amount)
    word = F.lower(F.substring(text, -1, 1)).isin("n", "f", "y")
    return word & text.rlike("(?i)^[+-]?(nan|inf|infinity)$") & ~text.rlike("^[+-]?(NaN|Infinity)$")


def valid(parsed: DataFrame) -> DataFrame:
    """The transactions of a parsed table or stream."""
    return parsed.where(F.col("error").isNull()).drop("line", "error")


def malformed(parsed: DataFrame) -> DataFrame:
    """The lines set aside, with the reason."""
    return parsed.where(F.col("error").isNotNull()).select("line", "error")


def account_profile(transactions: DataFrame) -> DataFrame:
    """Average, sum, count and maximum of the amounts of each account."""
    return profile(transactions, ["account_number"], "amount")


def safe_average(total: str | Column, count: str | Column) -> Column:
    """``total / count``, or 0 where there is nothing to average."""
    total = F.col(total) if isinstance(total, str) else total
    count = F.col(count) if isinstance(count, str) else count
    return F.when(count > 0, total / count).otherwise(F.lit(0.0))


def is_red_flag(
    average: Column, window_average: Column, historic: Column, margin: float = RED_FLAG_MARGIN
) -> Column:
    """Whether the account, or its last window, spends ``margin`` more than its history."""
    exceeds = lambda value: (value > F.lit(margin)) & ~F.isnan(value)  # noqa: E731  NaN sorts above all numbers
    return exceeds(average - historic) | exceeds(window_average - historic)


def mark_possible_fraud(
    transactions: DataFrame, amount: str = "amount", above: float = FRAUD_AMOUNT
) -> DataFrame:
    """Add ``is_possible_fraud`` to each transaction."""
    return transactions.withColumn("is_possible_fraud", (F.col(amount) > F.lit(above)) & ~F.isnan(amount))


def merge_state(previous: DataFrame, new: DataFrame, key: str = "account_number") -> DataFrame:
    """Running state after ``new`` window totals: totals and counts add up, the
    window average is replaced, and becomes 0 for an account without news.

    Both sides hold one row per ``key`` with ``total_spending`` and ``num_tx``.
    """
    old = previous.select(
        key, F.col("total_spending").alias("_old_total"), F.col("num_tx").alias("_old_n")
    )
    fresh = new.select(
        key, F.col("total_spending").alias("_new_total"), F.col("num_tx").alias("_new_n")
    )
    zero = F.lit(0)
    return old.join(fresh, key, "full").select(
        key,
        (F.coalesce("_old_total", zero) + F.coalesce("_new_total", zero)).alias("total_spending"),
        (F.coalesce("_old_n", zero) + F.coalesce("_new_n", zero)).alias("num_tx"),
        F.when(F.col("_new_n") > 0, F.col("_new_total") / F.col("_new_n"))
        .otherwise(F.lit(0.0))
        .alias("window_avg"),
    )
