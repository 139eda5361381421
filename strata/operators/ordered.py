"""Running values over the rows of a key in their order, for keys of any size.

Rows are range-partitioned on (keys, order), so a key with a huge history
spans several partitions. A window per (partition, key) gives the running
value within each piece, and a small table with one row per piece of the keys
that stand at a partition's edge (at most two keys per partition) carries the
value from piece to piece. No task ever holds a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_root


def by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` with the column ``_pid``, its partition by (keys, order). The
    rows are checkpointed to the shared folder: every use sees the same
    partitions. Keys and order columns must not be NULL."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_root(df.sparkSession)
    return (df.repartitionByRange(n, *keys, *order).withColumn("_pid", F.spark_partition_id())
            .checkpoint(eager=True))


def running(pieces: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, how: str, out: str,
            before: bool = False) -> DataFrame:
    """Rows of ``by_range`` with ``out``: the ``sum`` of ``value``, or its
    ``last`` value that is not NULL, over the rows of the same key up to this
    one (``before``: this one left out); ``_pid`` is dropped."""
    fold = {"sum": F.sum, "last": lambda c: F.last(c, ignorenulls=True)}[how]
    w = (Window.partitionBy("_pid", *keys).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, -1 if before else 0))
    rows = pieces.withColumn("__v", value)
    key = F.struct(*keys)
    ends = (pieces.groupBy("_pid").agg(F.array_distinct(F.array(F.min(key), F.max(key))).alias("_k"))
            .select("_pid", F.explode("_k").alias("_k")).select("_pid", "_k.*"))
    whole = (F.sum("__v") if how == "sum"
             else F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order))))
    edge = (rows.select("_pid", *keys, *[c for c in order if c not in keys], "__v")
            .join(ends, ["_pid", *keys]).groupBy("_pid", *keys).agg(whole.alias("__whole")))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = (edge.withColumn("__carry", fold("__whole").over(earlier)).filter(F.col("__carry").isNotNull())
             .select("_pid", *keys, "__carry"))
    joined = rows.withColumn("__run", fold("__v").over(w)).join(carry, ["_pid", *keys], "left")
    total = (F.coalesce("__run", F.lit(0)) + F.coalesce("__carry", F.lit(0)) if how == "sum"
             else F.coalesce("__run", "__carry"))
    return joined.withColumn(out, total).drop("_pid", "__v", "__run", "__carry")
