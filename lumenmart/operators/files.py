"""Folders in whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a job that wrote the folder came to its end."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def drop(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    if fs.exists(p):
        fs.delete(p, True)
