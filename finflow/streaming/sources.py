"""Stream sources. The format is a parameter; files are the default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(
    spark: SparkSession,
    kind: str,
    path: str | None = None,
    schema: T.StructType | str | None = None,
    arrival_time: str | None = None,
    **options: object,
) -> DataFrame:
    """A stream of format ``kind``; ``arrival_time`` names an added column with the time of reading."""
    reader = spark.readStream.format(kind).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    stream = reader.load(path) if path else reader.load()
    if arrival_time:
        stream = stream.withColumn(arrival_time, F.current_timestamp())
    return stream


def stream_table(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream, whether ``path`` is a folder of files or one file."""
    table = spark.read.parquet(path)
    options: dict[str, object] = {}
    if files_per_trigger:
        options["maxFilesPerTrigger"] = files_per_trigger
    folder, _, name = path.rstrip("/").rpartition("/")
    files = table.inputFiles()
    if len(files) == 1 and files[0].endswith("/" + name):
        # A file source watches folders, so watch the parent for this one name.
        path, options["pathGlobFilter"] = folder, name
    return read_stream(spark, "parquet", path, table.schema, **options)


def stream_lines(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Text files as a stream of lines in the column ``value``."""
    options = {"maxFilesPerTrigger": files_per_trigger} if files_per_trigger else {}
    return read_stream(spark, "text", path, **options)


def stream_queue(spark: SparkSession, servers: str, topics: str, **options: object) -> DataFrame:
    """Messages of a queue as (key, value, timestamp); needs the Kafka connector on the class path.

    Offsets are read from the brokers directly and kept in the checkpoint.
    """
    messages = read_stream(
        spark, "kafka", **{"kafka.bootstrap.servers": servers, "subscribe": topics, **options}
    )
    return messages.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "timestamp"
    )


def replay(df: DataFrame, path: str, batches: int, order: str | None = None) -> int:
    """Write ``df`` to be streamed in ``batches`` micro-batches; returns the files of each.

    There are as many files as the session shuffles partitions, rounded up to
    fill the batches, so a batch is read by many tasks. With ``order``, a time column, the
    batches follow each other in time, each about as large as the others; rows
    without a time are in the first.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files_per_batch = -(-tasks // batches)
    if order is None:
        df.repartition(batches * files_per_batch).write.mode("append").parquet(path)
        return files_per_batch
    at = F.unix_micros(F.col(order).cast("timestamp")).cast("double")
    cuts = df.select(at.alias("at")).approxQuantile("at", [i / batches for i in range(1, batches)], 0.01)
    bounds = [None, *sorted(set(cuts)), None]
    for low, high in zip(bounds, bounds[1:]):
        inside = F.lit(True) if low is None else at >= low
        if high is not None:
            inside = inside & (at < high)
        part = df.where(inside | at.isNull() if low is None else inside)
        part.repartition(files_per_batch).write.mode("append").parquet(path)
    return files_per_batch
