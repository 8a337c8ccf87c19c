"""Null handling, corrupt rows and column probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finflow.schemas import CORRUPT_COLUMN


def has_column(df: DataFrame, name: str) -> bool:
    """Whether ``name`` resolves on ``df``: a column, or a dotted path into structs.

    A dotted path may pass through arrays of structs, as column access does.
    Names compare without case, like Spark's default resolution.
    """

    def step(kind: T.DataType, part: str) -> T.DataType | None:
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.MapType):
            return kind.valueType
        if isinstance(kind, T.StructType):
            found = [f.dataType for f in kind if f.name.lower() == part.lower()]
            return found[0] if len(found) == 1 else None
        return None

    kind: T.DataType | None = df.schema
    for part in name.split("."):
        kind = step(kind, part.strip("`"))
        if kind is None:
            return False
    return True


def corrupted(df: DataFrame) -> DataFrame | None:
    """The raw text of the corrupt rows, or None if ``df`` has no such column.

    Spark refuses to scan a raw file for the corrupt column alone, and a row counts as
    corrupt by the columns that are asked for. So the condition looks at all of them,
    in a way that holds for every row; nothing is kept.
    """
    if not has_column(df, CORRUPT_COLUMN):
        return None
    others = [F.col(f"`{c}`") for c in df.columns if c.lower() != CORRUPT_COLUMN.lower()]
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    if others:
        bad = bad & (F.coalesce(F.length(F.to_json(F.struct(*others))), F.lit(0)) >= 0)
    return df.where(bad).select(CORRUPT_COLUMN)


def drop_if_all_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where every (listed) column is null; nested paths are allowed."""
    return df.na.drop("all", subset=list(columns) if columns else None)


def nonzero_or_unknown(df: DataFrame, amount: str = "amount", description: str = "description") -> DataFrame:
    """Rows with a non-zero amount, or described as Unknown.

    A null amount makes the first test unknown, so such a row needs the second.
    """
    return df.where((F.col(amount) != 0) | (F.col(description) == "Unknown"))


def clean_finances(
    df: DataFrame,
    identity: Sequence[str] = ("id", "account.number", "amount", "description", "date"),
) -> DataFrame:
    """Drop empty rows, name missing descriptions, keep rows that matter."""
    return (
        df.transform(drop_if_all_null, identity)
        .na.fill("Unknown", ["description"])
        .transform(nonzero_or_unknown)
    )
