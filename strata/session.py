"""Session settings and the shared working folder.

All timestamps are interpreted in UTC (business date = UTC date), ANSI mode
stays on so bad casts raise instead of turning into NULL, and adaptive query
execution re-plans joins and shuffle sizes at runtime (broadcast of sides that
turn out small, coalescing of tiny partitions, splitting of skewed ones).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's required settings."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Settings that can be changed on an existing session (SQL confs only)."""
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.adaptive.coalescePartitions.enabled"):
        spark.conf.set(key, BASE_CONF[key])


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session. Where it is unset a private folder is used in
    local mode only; on a cluster executors could not see it, so that raises.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A sub-folder of the shared checkpoint folder for written tables,
    removed when the driver's JVM ends."""
    root = checkpoint_root(spark)
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    path = root.rstrip("/") + "/strata/" + leaf
    fs, hpath = hadoop_path(spark, path)
    fs.mkdirs(hpath)
    fs.deleteOnExit(hpath)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a folder wherever Spark can reach it."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_path(spark, path)
    return fs.exists(hpath)
