"""Folders of whatever store Spark is set up to reach."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system and path object."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing if it is not there."""
    files, folder = _at(spark, path)
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder))


def put_empty(spark: SparkSession, path: str) -> None:
    """A file without content. Its name says it all, so no reader can see half of it."""
    files, file = _at(spark, path)
    files.create(file, False).close()


def delete(spark: SparkSession, path: str) -> None:
    files, folder = _at(spark, path)
    files.delete(folder, True)


def hours_since_change(spark: SparkSession, path: str) -> float:
    files, folder = _at(spark, path)
    return (time.time() - files.getFileStatus(folder).getModificationTime() / 1000) / 3600
