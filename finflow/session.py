"""Session setup and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_SHUFFLE_PARTITIONS = "200"

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Folder made up for a local application without a setting, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app_name: str = "finflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Settings every query relies on, applied to a session somebody else built.

    Windows and dates are defined in UTC. Stateful streams keep the partition
    count of their first run and AQE cannot coalesce them, so a *local* session
    that still has the cluster default gets one partition per core. A cluster's
    own setting is never touched. State of streams goes to disk (Spark's RocksDB store) unless the
    session names a store: the default keeps it all on the heap, where it also cannot grow.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if _STATE_STORE not in spark.conf.getAll:
        spark.conf.set(_STATE_STORE, _ROCKS)
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == _DEFAULT_SHUFFLE_PARTITIONS:
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Every executor must see it, so a machine-local folder is made up only for a
    local session where the setting is absent (as in tests).
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="finflow-")
    return _LOCAL_FOLDERS[application]


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; the first writer creates it."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: every use sees the same rows."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` saved to the shared folder, so a lost executor costs a re-read and not a recompute."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(work_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=eager)
