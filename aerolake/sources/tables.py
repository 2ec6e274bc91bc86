"""Scans: parquet, headed CSV, folders of files, tables that may not exist."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one when nothing is there yet.

    Any other failure (permissions, a broken file) is raised: taking it for
    "no table yet" would let the next write wipe out history.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, recursive: bool = False,
             mode: str = "FAILFAST") -> DataFrame:
    """Headed CSV, matched to ``schema`` by column *name*.

    Spark applies a given schema by position, so the header is read first (one
    line), the typed schema is put into file order, and every further file's
    header is checked against it.  Columns outside ``schema`` are skipped by
    the scan.
    """
    options = {"header": True, "recursiveFileLookup": recursive}
    header = spark.read.options(**options).csv(path).columns
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise ValueError(f"Columns missing from {path}: {missing}")
    in_file_order = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType())
                                  for c in header])
    scan = (spark.read.options(**options).option("enforceSchema", False).option("mode", mode)
            .schema(in_file_order).csv(path))
    return scan.select(*schema.names)


def file_label(level: str = "file_path") -> Column:
    """The file a row came from, or (``folder_path``) the folder holding it, by its full path.

    ``file`` and ``folder`` give the bare names, which may repeat across folders.
    """
    if level == "file_path":
        return F.col("_metadata.file_path")
    if level == "folder_path":
        return F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    if level == "file":
        return F.col("_metadata.file_name")
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)


def read_csv_files(spark: SparkSession, path: str, schema: T.StructType, label: str = "source_file",
                   level: str = "file_path") -> DataFrame:
    """All CSV files below ``path`` as one scan, each row tagged with its file."""
    return read_csv(spark, path, schema, recursive=True).select(file_label(level).alias(label), "*")


def row_key(salt_cols: tuple[str, ...] = ("_metadata.file_path", "_metadata.row_index")) -> Column:
    """Key of a row in a parquet scan, stable however often the scan is run."""
    return F.xxhash64(*salt_cols)
