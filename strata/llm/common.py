"""Shared helpers: reading, tables written to the shared folder, file systems."""

from __future__ import annotations

import re
import tempfile
import zipfile
import zlib
from pathlib import Path

import numpy as np
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

import strata
from strata.session import shared_dir

# Rows per Arrow batch handed to Python tasks: texts and sets can be long, so
# batches are kept short and task memory bounded.
ARROW_ROWS = 256
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """This package on the Python path of all tasks."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(strata.__file__).parent
        held = tempfile.mkdtemp(prefix="strata-code-")
        with zipfile.ZipFile(f"{held}/strata-code.zip", "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(f"{held}/strata-code.zip")
        _SHIPPED.add(sc.applicationId)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Short Arrow batches, and this package on the Python path of all tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    ship(spark)


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared checkpoint folder, removed when
    the driver's JVM ends."""
    return shared_dir(spark, name)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage and survives lost executors."""
    path = workspace(spark, name) + "/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared-folder URI (usable in tasks)."""
    m = re.match(r"^file:/*(/.*)$", uri)
    if m:
        return pafs.LocalFileSystem(), m[1]
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def crc_u32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
