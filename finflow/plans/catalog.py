"""All registered queries, and the flagship."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

from finflow.plans.registry import ORACLES, QUERIES

for _name in (
    "tables", "projection", "joins", "aggregates", "windows", "rows", "text", "numbers", "dates",
    "transactions", "streams", "accounts",
):
    importlib.import_module(f"finflow.plans.{_name}")

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES", "flagship"]

FLAGSHIP = "stm_25_fraud_on_table"


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """The fraud check over whole tables."""
    return QUERIES[FLAGSHIP](spark, folder)
