"""Explicit schemas of the records used across the package."""

from __future__ import annotations

from pyspark.sql import types as T

ACCOUNT = T.StructType(
    [
        T.StructField("number", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
    ]
)

TRANSACTION = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("account", ACCOUNT),
        T.StructField("date", T.DateType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("description", T.StringType()),
    ]
)

SIMPLE_TRANSACTION = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("account_number", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("description", T.StringType()),
    ]
)

# What the averaging step reads of a transaction.
TRANSACTION_FOR_AVERAGE = T.StructType(
    [
        T.StructField("account_number", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)

MALFORMED_LINE = T.StructType(
    [T.StructField("line", T.StringType()), T.StructField("error", T.StringType())]
)

# Running state of one account; ``window_end`` names the last window it has seen.
ACCOUNT_STATE = T.StructType(
    [
        T.StructField("account_number", T.StringType()),
        T.StructField("total_spending", T.DoubleType()),
        T.StructField("num_tx", T.LongType()),
        T.StructField("window_avg", T.DoubleType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("last_seen", T.TimestampType()),
    ]
)

EVALUATED_TRANSACTION = T.StructType(
    [
        T.StructField("tx", SIMPLE_TRANSACTION),
        T.StructField("is_possible_fraud", T.BooleanType()),
    ]
)

PERSON = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
    ]
)

ROLE = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("role", T.StringType())])

STATUS = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("customer", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

CORRUPT_COLUMN = "_corrupt_record"

# Name of the table of historic averages, for writer and reader alike.
ACCOUNT_AGGREGATES = "account_aggregates"
