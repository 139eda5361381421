"""The registered queries opN_<name>: each applies its operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import (decontaminate, htmlgraph, linededup, nndescent, ownership, packing, records, resample, sharding,
                        toxicity, warc, whitening)
from strata.llm.common import table
from strata.llm.partenum import jaccard_groups
from strata.llm.registry import ORACLE, QUERIES, register  # noqa: F401
from strata.llm.sql import JACCARD_SQL, RESAMPLE_SQL, SECRETS_SQL, WARC_SQL


@register("op1_packing")
def op1_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(spark, docs, end_id=0)
    return pieces.select(F.col("doc").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         "offset", "tier", "step_group")


@register("op2_records")
def op2_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest, root = records.write_records(spark, docs, end_id=2)
    back = records.read_records(spark, manifest, root)
    return back.select(F.col("key").cast("bigint").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@register("op3_ngram_jaccard", JACCARD_SQL)
def op3_ngram_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = jaccard_groups(spark, docs, words=3, num=90, den=100, n2=3)
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@register("op4_warc", WARC_SQL)
def op4_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    manifest, root = warc.write_archives(spark, pages)
    back = warc.records(warc.read_chunks(spark, manifest, root, with_data=False))
    return back.select(F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


@register("op5_line_dedup")
def op5_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    clean = linededup.remove_boilerplate(spark, docs)
    return clean.select("doc_id", F.size(F.split("text", "\n")).cast("bigint").alias("kept_lines"), "removed_lines",
                        F.length("text").cast("bigint").alias("kept_chars"), F.md5("text").alias("kept_md5"))


@register("op6_secret_ownership", SECRETS_SQL)
def op6_secret_ownership(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = ownership.scan(spark, docs, repo=F.concat_ws("/", "source", "lang"))
    base = F.filter("spans", lambda s: s["rank"] < len(ownership.KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select(F.col("id").alias("doc_id"), *[count(k) for k, *_ in ownership.KINDS],
                        F.sha2(ownership.joined(base), 256).alias("base_sha256"),
                        ownership.joined(F.col("spans")).alias("spans"), "live", "copied")


@register("op7_html_text")
def op7_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    done = htmlgraph.extract_pages(spark, pages)
    return done.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@register("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    model = toxicity.train(spark, docs, labels)
    scored = toxicity.score(spark, docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op9_nn_descent")
def op9_nn_descent(spark, sf_dir):
    found = nndescent.nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, top=5)
    return found.withColumnRenamed("id", "vec_id").select("query_id", "rank", "vec_id", "score")


@register("op10_decontamination")
def op10_decontamination(spark, sf_dir):
    found = decontaminate.find_passages(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@register("op11_resampling", RESAMPLE_SQL)
def op11_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark").select("text")
    return resample.resample(spark, docs, target).select("doc_id", "n_features", "weight", "score", "rank")


@register("op12_sharding")
def op12_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = sharding.read_shards(spark, sharding.write_shards(spark, docs), docs)
    return back.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                       F.lit("bytes").alias("law"), "shard", F.col("number").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


@register("op13_whitening")
def op13_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(spark, vectors)
    white = whitening.whiten(spark, vectors, model).drop("embedding")
    return whitening.components(white, model)
