"""Connected components by minimum labels with pointer jumping.

Every round is a few joins and aggregations; labels are checkpointed to the
shared folder, so no round is recomputed and nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): smallest node reachable by ``edges``; nodes without an
    edge do not occur. Self-loops, repeated and reversed edges are harmless,
    rows with a null end are left out; no edges give an empty table."""
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND x <> y")
    e = stored(spark, e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "cc-edges")
    labels = stored(spark, e.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("comp")),
                    "cc-labels")
    while True:
        near = (e.join(labels, e.y == labels.node).groupBy("x").agg(F.min("comp").alias("near")))
        step = (labels.join(near, labels.node == near.x)
                .select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp")))
        jump = labels.select(F.col("node").alias("up"), F.col("comp").alias("upper"))
        new = stored(spark, step.join(jump, step.comp == jump.up)
                     .select("node", "was", F.least("comp", "upper").alias("comp")), "cc-labels")
        changed = new.filter("comp <> was").limit(1).count()
        labels = new.select("node", "comp")
        if not changed:
            return labels
