"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.session import work_folder


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read again.

    The rows are fixed from here on: a lost executor re-reads them, and a second
    use sees the same rows in the same order without computing them again.
    """
    path = work_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    relieve(df.sparkSession)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


# Bytes of an Arrow batch. A task holds several copies of one, in the JVM and in Python.
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to ``BATCH_BYTES`` where the session allows more; a longer row is a batch of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


# Rows up to which a table of keys is broadcast; more are joined by shuffle.
MOST_BROADCAST = 500_000


def small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def dropped(df: DataFrame) -> None:
    """Delete the files of a table from :func:`stored` that no plan needs any more."""
    path = getattr(df, "_stored_at", None)
    if path:
        drop_folder(df.sparkSession, path)


def relieve(spark: SparkSession) -> None:
    """Collect the driver's garbage once half of its heap is taken.

    Plans of finished jobs are most of it; left alone, the heap grows to its limit
    before the collector acts, and the process with it.
    """
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if 2 * (runtime.totalMemory() - runtime.freeMemory()) > runtime.maxMemory():
        release(spark)


def release(spark: SparkSession) -> None:
    """Let the cleaner delete shuffle files that only finished, stored tables needed.

    It acts on collected objects, and an idle driver collects its garbage every
    half hour only.
    """
    for _ in range(2):  # objects of Python first, then those of the JVM that they held
        gc.collect()
        spark._jvm.System.gc()


def drop_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
