"""Capitalize each space-separated word: as a UDF for SQL, and in built-in expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the name the function has in SQL text.
UDF_NAME = "capitalizeWords"


def _capitalize(text: str | None) -> str | None:
    if text is None:
        return None
    return " ".join(word[:1].upper() + word[1:] for word in text.rstrip(" ").split(" "))


@F.pandas_udf(StringType())
def capitalize_words_udf(text: pd.Series) -> pd.Series:
    """Column UDF, one Arrow batch at a time."""
    return text.map(_capitalize)


def register_capitalize_words(spark: SparkSession) -> None:
    """Make the UDF callable from SQL text."""
    spark.udf.register(UDF_NAME, capitalize_words_udf)


def capitalize_words(text: Column) -> Column:
    """Same result without leaving the JVM; trailing spaces go, other letters stay."""
    word = F.split(F.rtrim(text), " ")
    return F.array_join(
        F.transform(word, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))),
        " ",
    )
