"""Folders and marker files on the storage the session's paths point to, through its own file system client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    system, found = _file_system(spark, path)
    return system.exists(found)


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what lies directly in a folder; none where there is no such folder."""
    system, found = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(found)) if system.exists(found) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, and the folders above it."""
    system, found = _file_system(spark, path)
    system.create(found, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file with all it holds; a path that is gone already is fine."""
    system, found = _file_system(spark, path)
    system.delete(found, True)
