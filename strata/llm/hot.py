"""Joins and numbering that no single key can hold up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored

# A key is hot if it holds at least this share (one part in SHARE) of the rows: there are at most SHARE hot keys.
SHARE = 1024


def join_hot(big: DataFrame, small: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """Inner join of ``big`` with ``small`` (one row per key; column ``rows``:
    rows of ``big`` with that key, ``total`` of them in all). The at most
    ``SHARE`` keys that hold a large share are joined by broadcast, so the
    shuffled join has no large group. ``rows`` is left out of the result."""
    hot = F.col(rows) * SHARE >= total
    few = F.broadcast(small.filter(hot).drop(rows))
    many = small.filter(~hot).drop(rows)
    rest = big.join(F.broadcast(small.filter(hot).select(key)), key, "left_anti")
    return big.join(few, key).unionByName(rest.join(many, key))


def numbered(spark: SparkSession, df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with ``out``: 1, 2, 3... in the given order, by a range
    partitioned sort; only the number of rows of each partition is collected."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stored(spark, ranged.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33)
    first, offsets = 1, []
    for x in held.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect():
        offsets.append((x.p, first))
        first += x.n
    # One row per partition of the sort.
    starts = spark.createDataFrame(offsets, "__part bigint, __first bigint")
    local = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (held.join(F.broadcast(starts), part == F.col("__part"))
            .withColumn(out, F.col("__first") + local).drop("__at", "__part", "__first"))
