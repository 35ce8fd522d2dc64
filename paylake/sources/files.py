"""The few file-system calls that the table folders need, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


#: The codec of stored text and tables: about half the bytes of the default for the JSON of the raw log.
CODEC = "zstd"

#: Compressed bytes that a writer of a file of records, and a reader of it, hold at once.
ROW_GROUP = 32 * 1024 * 1024
ROW_GROUP_SETTING = "parquet.block.size"


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the folders directly below ``path``; empty if there is none."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files of a folder; 0 if there is none."""
    fs, target = _path(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)
