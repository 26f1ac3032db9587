"""Small files and folders on the storage that all executors share, used from the driver."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in `folder`, none if it does not exist."""
    fs, target = _open(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that does not exist yet, so that readers see all of it or nothing.

    It is written under another name first and then renamed. False if there is a file already.
    """
    fs, target = _open(spark, path)
    if fs.exists(target):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    return bool(fs.rename(draft, target))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    fs, target = _open(spark, path)
    fs.delete(target, True)
