"""Files of the storage that a path belongs to, through the client that Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession

PACKED = {"compression": "zstd"}  # of whole tables, which take most of what is written


def file_system(spark: SparkSession, path: str):
    """(client, path constructor)"""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def exists(spark: SparkSession, path: str) -> bool:
    fs, make = file_system(spark, path)
    return fs.exists(make(path))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, make = file_system(spark, path)
    return fs.getContentSummary(make(path)).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, make = file_system(spark, path)
    fs.delete(make(path), True)


def create(spark: SparkSession, path: str) -> bool:
    """An empty file; False if there is one already."""
    fs, make = file_system(spark, path)
    if fs.exists(make(path)):
        return False
    try:
        fs.create(make(path), False).close()
    except Exception:
        if fs.exists(make(path)):
            return False
        raise
    return True


def folders(spark: SparkSession, path: str) -> list[str]:
    fs, make = file_system(spark, path)
    if not fs.exists(make(path)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(make(path)) if s.isDirectory())
