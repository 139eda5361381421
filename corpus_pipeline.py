"""Corpus pipeline: five stages over ``documents``, each written as Parquet and
reread as the next one's input.

1. ``toxicity``: score every document with a classifier fitted on ``labels``;
   documents at ``TOXIC`` or above go.
2. ``line_dedup``: take boilerplate lines out of the texts; every document
   stays, ``n_chars`` follows the text.
3. ``near_duplicates``: group documents whose five-word shingle sets are at
   least 0.8 similar; the one with the smallest id of each group stays.
4. ``decontamination``: documents that hold a passage of a benchmark item go.
5. ``packing``: pack what is left into sequences; returns the pieces.

Nulls: a null text counts as empty and is never toxic by its words, similar
to anything or contaminated; a row without an id is kept by stages 1 to 4.
Rows are told apart by id and text: of rows that repeat both, the stage
near_duplicates keeps one. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, linededup, packing, toxicity
from strata.llm.common import stored, table
from strata.llm.partenum import jaccard_groups

TOXIC = 0.5

# The first stage is a fitted classifier, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the rows of ``labels`` whose documents are still there."""
    model = toxicity.train(spark, docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(spark, docs, model, out="__toxic")
    return scored.filter(F.col("__toxic") < TOXIC).drop("__toxic")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = linededup.remove_boilerplate(spark, docs, removed="__removed")
    n = F.when(F.col("__removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A row's key orders by id, then by text: rows that repeat an id with another text are documents of their own.
    key = (F.col("doc_id").cast("decimal(38,0)") * F.lit(1 << 48).cast("decimal(15,0)")).cast("decimal(38,0)")
    tail = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 16)
    keyed = docs.withColumn("__key", (key + tail).cast("decimal(38,0)"))
    groups = jaccard_groups(spark, keyed, id_col="__key", words=5, num=80, den=100)
    # Keys that stand for another document of their group, and keys of repeated rows: the only rows to look at again.
    per_key = groups.filter("id IS NOT NULL").groupBy(F.col("id").alias("__key")).agg(
        F.min(F.col("component") == F.col("id")).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    seen = stored(spark, per_key.filter(~F.col("__first") | (F.col("__rows") > 1)), "pipeline-repeats")
    kept = keyed.join(seen.select("__key"), "__key", "left_anti").select(docs.columns)
    # One row of those that repeat, by an aggregation that keeps a single row per key from the first task on.
    repeated = (keyed.join(seen.filter("__first").select("__key"), "__key")
                .groupBy("__key").agg(F.min(F.struct(*docs.columns)).alias("r")).select("r.*"))
    return kept.unionByName(repeated) if seen.filter("__first").limit(1).count() else kept


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    flagged = decontaminate.flag_documents(spark, docs, table(spark, sf_dir, "benchmark"), out="__passages")
    return flagged.filter("__passages = 0").drop("__passages")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, end_id=0).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
