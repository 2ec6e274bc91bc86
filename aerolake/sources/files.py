"""Folders of any file system that Spark reaches, by their path or URI."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    files, path = _folder(spark, path)
    return files.exists(path)


def remove(spark: SparkSession, path: str) -> None:
    files, path = _folder(spark, path)
    files.delete(path, True)
