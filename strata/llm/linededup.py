"""Line dedup by distinct-site spread, in DataFrame functions only.

A line is boilerplate if it stands on half of the table's distinct sites (from
2 to ``most_sites``) and in ``min_texts`` or more classes of near copies.
Texts are of one class if linked by an equal band of minhashes of their word
shingles, so a document copied to many sites, exactly or nearly, is one class
wherever it stands and keeps its lines, while a notice pasted into unrelated
pages goes, wherever in a page it stands. The links are approximate: short
texts that mostly consist of one notice may count as one class.

Spread is counted by HyperLogLog sketches per line hash: sketches of salted
parts are built first, then merged by aggregation, so a line on a third of
all rows is never one task's input. Only lines with enough occurrences can
spread that far, so only they get sketches. Lines whose estimates come near a
threshold get exact distinct counts. Line hashes are computed once and stored;
lines and rows are told apart by 128 bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.components import components

MIN_SITES = 15
LG_K = 12
# Estimates within this share of a threshold are counted exactly: six standard errors at LG_K = 12.
NEAR = 0.1
SALT = 16
# Classes of near copies that must hold a line; the sites it must reach are half of the table's, from 2 to MIN_SITES.
MIN_TEXTS = 10
# Shingles of WORDS words; the LOWEST hashes stand for a text; equal BANDS of ROWS minhashes link texts: nearly always
# where nine tenths of the shingles are shared, seldom where a third is (1 - (1 - share ** ROWS) ** BANDS).
WORDS, LOWEST, BANDS, ROWS = 3, 64, 8, 4


def _digest(*cols):
    """128 bits of the columns."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols).alias("b"))


def _lines(spark: SparkSession, flat: DataFrame) -> DataFrame:
    """(key, doc, site, pos, h): a row for every line that is not blank, from
    the stored hashes of all texts."""
    hashes = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"),
                         lambda x: F.when(F.length(F.trim(x)) > 0, _digest(x)))
    rows = stored(spark, flat.select("key", "doc", "site", hashes.alias("hs")), "lines-hashes")
    return rows.select("key", "doc", "site", F.posexplode("hs").alias("pos", "h")).filter("h IS NOT NULL")


def _often(spark: SparkSession, lines: DataFrame, least: int) -> DataFrame:
    """Rows of the lines that occur at least so often."""
    often = stored(spark, lines.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
                   .select("h"), "lines-often")
    return lines.join(often, "h", "left_semi")


def _passing(spark: SparkSession, cand: DataFrame, counted: tuple, passes, name: str) -> DataFrame:
    """(h): lines whose distinct counts of the ``counted`` columns pass, by sketches first, exactly near a threshold."""
    parts = cand.groupBy("h", F.pmod("doc", F.lit(SALT)).alias("salt")).agg(
        *[F.hll_sketch_agg(c, LG_K).alias(c) for c in counted])
    merged = parts.groupBy("h").agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in counted])
    merged = stored(spark, merged, "lines-spread")
    sure = merged.filter(passes(1 + NEAR, 1 - NEAR)).select("h")
    near = merged.filter(passes(1 - NEAR, 1 + NEAR) & ~passes(1 + NEAR, 1 - NEAR)).select("h")
    exact = (cand.join(near, "h", "left_semi").groupBy("h")
             .agg(*[F.count_distinct(c).alias(c) for c in counted]).filter(passes(1, 1)).select("h"))
    return stored(spark, sure.unionByName(exact), name)


def _bands(flat: DataFrame) -> DataFrame:
    """(doc, band): hashes of the bands of minhashes of each text."""
    words = flat.select("doc", F.split(F.trim(F.lower("text")), r"\s+").alias("w"))
    grams = F.transform("w", lambda x, i: F.xxhash64(x, *[F.get("w", i + k) for k in range(1, WORDS)]))
    low = words.select("doc", F.slice(F.sort_array(F.array_distinct(grams)), 1, LOWEST).alias("low"))
    least = lambda b, r: F.array_min(F.transform("low", lambda h: F.xxhash64(h, b, F.lit(r))))
    bands = F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.xxhash64(b, *[least(b, r) for r in range(ROWS)]))
    return low.select("doc", F.explode(bands).alias("band"))


def spread_boilerplate(spark: SparkSession, flat: DataFrame, lines: DataFrame, most_sites: int = MIN_SITES,
                       min_texts: int = MIN_TEXTS) -> DataFrame:
    """(h): hashes of the lines that stand on half of the table's sites (from
    2 to ``most_sites``) and in ``min_texts`` classes of near copies."""
    sites = flat.filter("site IS NOT NULL").select("site").distinct().count()
    min_sites = min(most_sites, max(2, -(-sites // 2)))
    cand = _often(spark, lines, max(min_sites, min_texts)).select("h", "doc", "site")
    at_least = lambda texts: lambda up, _: (F.col("site") >= min_sites * up) & (F.col(texts) >= min_texts * up)
    wide = _passing(spark, cand, ("site", "doc"), at_least("doc"), "lines-wide")
    cand = stored(spark, cand.join(wide, "h", "left_semi").distinct(), "lines-held")
    # Only texts that hold such a line are shingled, each once: copies become one text before the shuffle.
    holders = stored(spark, cand.select("doc").distinct(), "lines-holders")
    texts = flat.groupBy("doc").agg(F.min("text").alias("text"))
    bands = stored(spark, _bands(texts.join(holders, "doc")).distinct(), "lines-bands")
    shared = bands.groupBy("band").agg(F.min("doc").alias("a"), F.max("doc").alias("z")).filter("a < z").select("band")
    classes = components(spark, bands.join(shared, "band", "left_semi"), "doc", "band")
    cand = (cand.join(classes, cand.doc == classes.node, "left")
            .select("h", "doc", "site", F.coalesce("comp", "doc").alias("class")))
    return _passing(spark, cand, ("site", "class"), at_least("class"), "lines-boilerplate")


def remove_boilerplate(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       site_col: str = "source", most_sites: int = MIN_SITES, min_texts: int = MIN_TEXTS,
                       removed: str = "removed_lines") -> DataFrame:
    """``docs`` with boilerplate lines taken out of its text and a count of
    them in the new column ``removed``.

    Every row stays; a text all of whose lines go becomes empty. Blank lines
    are never boilerplate. Null texts stay null, a null site counts for no
    site, null ids and repeated rows are treated like any other (what is
    removed depends on the line alone); an empty table stays empty; other
    columns, whatever their names, are passed through.
    """
    if removed in docs.columns:
        raise ValueError(f"column {removed} exists")
    text = F.col(text_col)
    flat = docs.select(_digest(F.col(id_col), text).alias("key"), F.xxhash64(text).alias("doc"),
                       F.col(site_col).cast("string").alias("site"), text.alias("text"))
    lines = _lines(spark, flat)
    bad = spread_boilerplate(spark, flat, lines, most_sites, min_texts)
    drop = lines.select("key", "pos", "h").join(bad, "h", "left_semi")
    # Rows with one key have one text: their positions coincide.
    per_doc = drop.groupBy("key").agg(F.collect_set("pos").alias("gone"))
    names = [f"c{i}" for i in range(len(docs.columns))]     # own names while joined: inputs may clash with them
    own = docs.toDF(*names).withColumn("key", _digest(names[docs.columns.index(id_col)],
                                                         names[docs.columns.index(text_col)]))
    body = F.col(names[docs.columns.index(text_col)])
    kept = F.array_join(F.filter(F.split(body, "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    joined = own.join(per_doc, "key", "left")
    out = [F.when(F.col("gone").isNull(), F.col(c)).otherwise(kept) if c == names[docs.columns.index(text_col)] else F.col(c)
           for c in names]
    return joined.select(*[o.alias(c) for o, c in zip(out, docs.columns)],
                         F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias(removed))
