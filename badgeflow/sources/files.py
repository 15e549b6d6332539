"""Folders, through the file system that Spark reads and writes them with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern of folder names, in order. Folders are listed level by level, not below."""
    at, files = _at(spark, pattern)
    return sorted(str(status.getPath()) for status in files.globStatus(at) or [])


def remove(spark: SparkSession, pattern: str) -> None:
    for path in matching(spark, pattern):
        at, files = _at(spark, path)
        files.delete(at, True)


def make(spark: SparkSession, folder: str) -> None:
    """A folder that exists before anything is written to it, on object stores too: it holds a hidden empty file."""
    at, files = _at(spark, f"{folder}/_created")
    if not files.exists(at.getParent()):
        files.create(at).close()


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.exists(at)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """A folder under a new name; folders above it are made."""
    at, files = _at(spark, path)
    target, _ = _at(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(at, target):
        raise OSError(f"cannot rename {path} to {to}")
