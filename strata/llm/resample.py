"""Importance resampling towards a target distribution, with segment
deduplication.

Features are runs of 1 to ``n`` consecutive words, hashed into ``buckets``
buckets. Line feeds separate words, so they cut every text into lines whose
runs stand for themselves: the runs of each *distinct* line are hashed once and
count as often as the line occurs; runs that cross a line feed (``n`` > 1)
are added separately, from the at most ``n - 1`` words on either side. The
gain of a bucket compares its share in the target with that in the corpus,
both smoothed by one; a document's weight is the mean gain of its features,
and documents are drawn without replacement by adding Gumbel noise, derived
from the id, to the weight.

The same table of distinct lines serves the counts and the weights: a text's
gain is the sum of its lines' gains, joined by line digest, so no text is
cut into words twice. Lines and texts are known by 128-bit digests; lines
that a large share of all texts hold are joined by broadcast (``hot``).

Null and empty texts have no features and weight 0. Repeated rows are drawn
independently but with the same noise, so both or neither, but for the last
place. A null id counts as an empty one and sorts last. Empty tables draw
nothing; without target texts all gains follow from the smoothing. Extra
columns stay with ``resample``'s rows; its own columns must be new names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.hot import join_hot, numbered

BUCKETS = 10_000
NGRAM = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# A word is a run of these characters after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OWN = ("n_features", "weight", "score", "rank")


def _digest(c: Column | str) -> Column:
    return F.unhex(F.md5(c))


def _lines(text: Column) -> Column:
    return F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), "\n")


def _words(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(WORD), F.lit(0))


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature) % buckets).cast("int")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once: a lambda would otherwise
    repeat it for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _starts(items: Column, k: int) -> Column:
    """Positions from 0 of the runs of ``k`` items."""
    return F.when(F.size(items) >= k, F.sequence(F.lit(0), F.size(items) - k)).otherwise(F.array().cast("array<int>"))


def _runs(words: Column, n: int, buckets: int) -> Column:
    """Buckets of all runs of 1 to ``n`` words."""
    if n == 1:
        return F.transform(words, lambda w: _bucket(w, buckets))

    def runs(w, k):
        return F.transform(_starts(w, k), lambda i: _bucket(
            F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)]), buckets))
    return _let(words, lambda w: F.concat(*[runs(w, k) for k in range(1, n + 1)]))


def _crossing(lines: Column, n: int, buckets: int) -> Column:
    """Buckets of the runs of 2 to ``n`` words that cross a line feed. Only
    the outer ``n - 1`` words of a line can take part."""
    def edge(line, i):
        outer = _let(_words(line), lambda w: F.when(F.size(w) <= 2 * (n - 1), w).otherwise(
            F.concat(F.slice(w, 1, n - 1), F.slice(w, -(n - 1), n - 1))))
        return F.transform(outer, lambda w: F.struct(w.alias("w"), i.alias("i")))

    def runs(items, k):
        across = F.filter(_starts(items, k), lambda s: F.get(items, s)["i"] != F.get(items, s + (k - 1))["i"])
        return F.transform(across, lambda s: _bucket(
            F.concat_ws(" ", *[F.get(items, s + j)["w"] for j in range(k)]), buckets))
    return _let(F.flatten(F.transform(lines, edge)), lambda items: F.concat(*[runs(items, k) for k in range(2, n + 1)]))


def line_features(spark: SparkSession, texts: DataFrame, text: Column, n: int = NGRAM,
                  buckets: int = BUCKETS) -> DataFrame:
    """One stored row per distinct line: line (digest), occurrences, words,
    features (buckets of its runs)."""
    flat = texts.select(F.explode(_lines(text)).alias("l")).groupBy("l").agg(F.count(F.lit(1)).alias("occurrences"))
    cut = flat.select(_digest("l").alias("line"), "occurrences", _words(F.col("l")).alias("w"))
    return stored(spark, cut.select("line", "occurrences", F.size("w").cast("bigint").alias("words"),
                                    _runs(F.col("w"), n, buckets).alias("features")), "resample-lines")


def bucket_counts(texts: DataFrame, text: Column, lines: DataFrame, n: int = NGRAM,
                  buckets: int = BUCKETS) -> DataFrame:
    """(bucket, count) over whole texts: every distinct line's features times
    its occurrences, and the runs that cross line feeds."""
    counts = lines.select(F.explode("features").alias("bucket"), F.col("occurrences").alias("c"))
    if n > 1:
        counts = counts.unionByName(texts.select(
            F.explode(_crossing(_lines(text), n, buckets)).alias("bucket"), F.lit(1).cast("bigint").alias("c")))
    return counts.groupBy("bucket").agg(F.sum("c").alias("count"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket; ``buckets`` numbers come to the driver."""
    own = {x.bucket: x["count"] for x in source.collect()}
    aim = {x.bucket: x["count"] for x in target.collect()}
    s_all, t_all = float(sum(own.values())), float(sum(aim.values()))
    ratio = [(aim.get(b, 0) + 1) * (s_all + buckets) / ((own.get(b, 0) + 1) * (t_all + buckets)) for b in range(buckets)]
    return [math.floor(1000 * math.log(r)) for r in ratio]


def weigh(spark: SparkSession, docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          target_text: str = "text", n: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """One stored row per row of ``docs``: its other columns, words,
    n_features, weight."""
    if taken := {"words", *OWN} & set(docs.columns):
        raise ValueError(f"columns {sorted(taken)} exist")
    text = F.col(text_col)
    lines = line_features(spark, docs, text, n, buckets)
    aim = line_features(spark, target, F.col(target_text), n, buckets)
    table = gains(bucket_counts(docs, text, lines, n, buckets),
                  bucket_counts(target, F.col(target_text), aim, n, buckets), buckets)
    # A constant of ``buckets`` numbers, folded once per task.
    gain = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")

    def total(features: Column) -> Column:
        return F.aggregate(features, F.lit(0).cast("bigint"), lambda a, b: a + F.get(gain, b))

    valued = lines.select("line", "occurrences", "words", F.size("features").cast("bigint").alias("features"),
                          total(F.col("features")).alias("gain"))
    key = _digest(F.coalesce(text, F.lit("")))
    # Lines of each text, copies of a text together: sums over them are divided by their number.
    held = stored(spark, docs.select(key.alias("text"), F.posexplode(_lines(text)).alias("i", "l"))
                  .select("text", _digest("l").alias("line"), "i")
                  .groupBy("text", "line").agg(F.count(F.lit(1)).alias("times"),
                                               F.count_if(F.col("i") == 0).alias("copies")), "resample-text-lines")
    size = held.agg(F.sum("times").alias("n")).first().n or 0
    per = (join_hot(held, valued, "line", "occurrences", size).groupBy("text")
           .agg(F.sum("copies").alias("copies"), F.sum(F.col("times") * F.col("words")).alias("w"),
                F.sum(F.col("times") * F.col("features")).alias("f"), F.sum(F.col("times") * F.col("gain")).alias("g")))
    once = lambda c: F.expr(f"{c} div copies")
    per = per.select("text", "copies", once("w").alias("words"), once("f").alias("n_features"), once("g").alias("gain"))
    if n > 1:
        cross = _crossing(_lines(text), n, buckets)
        more = docs.select(key.alias("text"), cross.alias("x")).groupBy("text").agg(
            F.max(F.size("x")).cast("bigint").alias("x"), F.max(total(F.col("x"))).alias("xg"))
        per = per.join(more, "text").select("text", "copies", "words", (F.col("n_features") + F.col("x")).alias(
            "n_features"), (F.col("gain") + F.col("xg")).alias("gain"))
    per = stored(spark, per.select(
        F.col("text").alias("__text"), F.col("copies").alias("__copies"), "words", "n_features",
        F.when(F.col("n_features") == 0, F.lit(0).cast("bigint"))
        .otherwise(F.expr("(gain - pmod(gain, n_features)) div n_features")).alias("weight")), "resample-weights")
    rows = docs.withColumn("__text", key).drop(text_col)
    n_rows = per.agg(F.sum("__copies").alias("n")).first().n or 0
    return stored(spark, join_hot(rows, per, "__text", "__copies", n_rows).drop("__text"), "resample-weighed")


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", n: int = NGRAM, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
             percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` (its columns but the text) with words, n_features,
    weight, score and rank; rank is null for rows not drawn."""
    weighed = weigh(spark, docs, target, id_col, text_col, target_text, n, buckets)
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))),
                                      256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("score", F.col("weight") + gumbel)
    fit = F.col("words") >= least_words
    places = scored.filter(fit).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last(id_col), F.asc("__row")]
    # Stored rows are numbered as read, so that rows with one score and id can be dealt out.
    ranked = numbered(spark, scored.filter(fit).withColumn("__row", F.monotonically_increasing_id()), order, "rank")
    ranked = ranked.drop("__row").withColumn("rank", F.when(F.col("rank") <= places, F.col("rank")))
    return ranked.unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("bigint")))
