"""Landed-file inventory and storage footprint.

Both use the ``binaryFile`` source with the ``content`` column pruned, so
only file metadata is listed (distributed listing, no bytes read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, path: str, glob: str = "*",
                   recursive: bool = True) -> DataFrame:
    """``(path, file_name, length, modified)`` of every file under ``path``.

    Missing input raises (Spark's ``PATH_NOT_FOUND``) before anything runs."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(path)
    return df.select(
        F.col("path"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )


def footprint(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Total ``files`` and ``bytes`` under ``path`` (and MiB, 2 decimals)."""
    inv = file_inventory(spark, path, glob)
    return inv.agg(F.count(F.lit(1)).alias("files"), F.sum("length").cast("long").alias("bytes")) \
        .withColumn("mib", F.round(F.col("bytes") / F.lit(1024 * 1024), 2))
