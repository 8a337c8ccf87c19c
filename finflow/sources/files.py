"""Small files beside tables, on whatever file system the path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None if there is none."""
    files, target = _on(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: readers see the old content or the new, never a part."""
    files, target = _on(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = files.create(fresh, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(fresh, target):  # some file systems do not rename onto a file
        files.delete(target, False)
        if not files.rename(fresh, target):
            raise OSError(f"cannot write {path}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    files, target = _on(spark, path)
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    files, target = _on(spark, path)
    files.delete(target, True)


def claim(spark: SparkSession, path: str, owner: str | None) -> None:
    """Make the stream ``owner`` the only one to write below ``path``; None asks for nothing.

    A stream that lost its checkpoint has a new id and counts its batches from 0 again:
    going on would overwrite the batches of the old one, so it is refused.
    """
    if owner is None:
        return
    marker = f"{path}/_owner"
    held = read_text(spark, marker)
    if held is None:
        write_text(spark, marker, owner)
    elif held != owner:
        raise ValueError(f"{path} belongs to stream {held}, not {owner}: was its checkpoint lost?")


def current_stream(spark: SparkSession) -> str | None:
    """Id of the stream whose micro-batch is being handled; it stays the same as long as its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")
