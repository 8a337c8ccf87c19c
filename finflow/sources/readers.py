"""Batch sources."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from finflow.schemas import CORRUPT_COLUMN

# What to do with rows that do not parse.
JSON_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    mode: str = "PERMISSIVE",
    schema: T.StructType | str | None = None,
    whole_file: bool = False,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """JSON rows, one per line, or documents spanning lines with ``whole_file``.

    Without ``schema`` it is inferred, from a ``sampling_ratio`` share of the
    rows if given; at scale a schema saves that pass. In PERMISSIVE mode a bad
    row is kept and its text is in ``_corrupt_record``.
    """
    if mode not in JSON_MODES:
        raise ValueError(f"mode {mode!r} is none of {JSON_MODES}")
    reader = spark.read.option("mode", mode).option("multiLine", whole_file)
    if sampling_ratio is not None:
        if not 0 < sampling_ratio <= 1:
            raise ValueError("sampling_ratio must be in (0, 1]")
        reader = reader.option("samplingRatio", sampling_ratio)
    if schema is not None:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        if mode == "PERMISSIVE" and CORRUPT_COLUMN not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.schema(schema)
    return reader.json(path if isinstance(path, str) else list(path))


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet scan; filters and column choice reach the files."""
    return spark.read.parquet(*paths)


def query_file(spark: SparkSession, path: str, columns: str = "*", kind: str = "parquet") -> DataFrame:
    """SQL directly on a file, without a table."""
    escaped = path.replace("`", "``")
    return spark.sql(f"select {columns} from {kind}.`{escaped}`")


def query_view(df: DataFrame, name: str, sql: str) -> DataFrame:
    """Register ``df`` as the temporary view ``name`` and run ``sql``."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(sql)


def local_table(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table from literals."""
    return spark.createDataFrame(list(rows), schema)


def read_table(
    spark: SparkSession, path: str | None, columns: Sequence[str], kind: str = "parquet", **options: str
) -> DataFrame:
    """Chosen columns of an external table; ``kind`` names the connector."""
    reader = spark.read.format(kind).options(**options)
    return (reader.load(path) if path else reader.load()).select(*columns)
