"""Times of files, asked of the file system that holds them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _status(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(place) if system.exists(place) else None


def changed_at(spark: SparkSession, path: str) -> int:
    """Milliseconds of the last change; an error if there is no such file."""
    found = _status(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    return found.getModificationTime()


def completed_at(spark: SparkSession, path: str) -> int | None:
    """When a written table was completed; None if it is not there or its write did not end."""
    found = _status(spark, f"{path}/_SUCCESS")
    return found.getModificationTime() if found is not None else None


def exists(spark: SparkSession, path: str) -> bool:
    return _status(spark, path) is not None


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written folder; nothing happens if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
