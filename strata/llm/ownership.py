"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Every text is scanned for credential candidates of several kinds (spans in
code points). The hash of each candidate's value is counted over the whole
corpus: distinct repositories and distinct owners, pre-aggregated per
(value, owner, repository) before the counts, so a value on a third of all
rows is no task's whole input. A value's core is the value without
punctuation at its ends; values of one core count as one. A core of many
owners, or of many repositories of few owners, is a widely copied example; one
of few owners and repositories that looks random (enough different characters,
a letter and a digit) is a live credential. Bare occurrences of live cores,
without the assignment or prefix that gave them away elsewhere, are then found
in all texts (as whole tokens, punctuation at the ends aside) and added as
spans of kind ``live``.

Positions: a match with the text before it is extracted as one string, so
running sums of lengths give the spans; they are summed by a window over a
text's matches only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

# Kind, pattern, group that holds the value, least characters of that group.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# A bare token that may repeat a value: a whole run of these characters with a digit, of at least MIN_DISTINCT. The same
# runs as RE2 has them (no look-around; runs that are too short are left out afterwards).
RUN = "A-Za-z0-9+/_.=-"
BARE = "(?<![" + RUN + "])(?=[" + RUN + "]{8})[A-Za-z+/_.=-]*+[0-9][" + RUN + "]*+"
BARE_RE2 = "[A-Za-z+/_.=-]*[0-9][" + RUN + "]*"
ENDS = "+/_.=-"         # punctuation left out of a core
MAX_OWNERS = 2          # a live value belongs to at most so many owners
MAX_REPOS = 3           # and to at most so many repositories
MIN_DISTINCT = 8        # and has at least so many different characters (so no live core is shorter)


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Array of (gap, whole, value): characters before the match since the
    last one, characters including the match, and the value."""
    flags, body = ("(?i)", pattern[4:]) if pattern.startswith("(?i)") else ("", pattern)
    # \\G: a search goes on where the last match ended, so the rest of a text is searched once.
    lazy = F.lit(f"{flags}\\G([\\s\\S]*?)({body})")
    part = lambda g: F.regexp_extract_all(text, lazy, F.lit(g))
    zipped = F.arrays_zip(part(1).alias("g"), part(0).alias("w"), part(group + 2).alias("v"))
    found = F.transform(zipped, lambda m: F.struct(F.length(m["g"]).alias("gap"), F.length(m["w"]).alias("whole"),
                                                   m["v"].alias("value")))
    return F.when(text.rlike(pattern), found)       # most texts need one search per kind


def _spans(rows: DataFrame, kind: str, col: str) -> DataFrame:
    """(rid, kind, start, stop, value) of one kind's matches."""
    flat = rows.select("rid", "owner", "repo", F.posexplode(col).alias("pos", "m"))
    upto = Window.partitionBy("rid").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum("m.whole").over(upto)
    return flat.select("rid", "owner", "repo", F.lit(kind).alias("kind"),
                       (stop - F.col("m.whole") + F.col("m.gap")).alias("start"), stop.alias("stop"),
                       F.col("m.value").alias("value"))


def scan(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         owner: Column | str = "source", repo: Column | str = "source", max_owners: int = MAX_OWNERS,
         max_repos: int = MAX_REPOS) -> DataFrame:
    """(id, spans, live, copied): one row per row of ``docs``.

    ``spans``: array of (start, rank, kind, stop) in order, ``rank`` being the
    kind's place in ``KINDS`` (``live`` comes last); ``live`` and ``copied``:
    numbers of base spans whose value is owner-specific, or not. Null and
    empty texts have no spans; null ids and repeated rows get their own rows;
    a null owner or repository counts as one unnamed; an empty table gives an
    empty result; further columns are ignored.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(col(owner).cast("string"), F.lit("")).alias("owner"),
                      F.coalesce(col(repo).cast("string"), F.lit("")).alias("repo"),
                      *[_matches(text, p, g).alias(k) for k, p, g, _ in KINDS], _matches(text, BARE, 0).alias("bare"))
    # Row numbers are fixed by writing the table once.
    rows = stored(spark, src.withColumn("rid", F.monotonically_increasing_id()), "secret-rows")
    base = None
    for rank, (kind, _, _, least) in enumerate(KINDS):
        one = _spans(rows, kind, kind).filter(F.length("value") >= least).withColumn("rank", F.lit(rank))
        base = one if base is None else base.unionByName(one)
    core = F.btrim("value", F.lit(ENDS))
    keyed = lambda df: df.withColumn("core", core).withColumn("h", F.sha2("core", 256))
    base = stored(spark, keyed(base), "secret-spans")
    owned = base.groupBy("h", "owner", "repo").agg(F.first("core").alias("core"))
    by_owner = owned.groupBy("h", "owner").agg(F.count(F.lit(1)).alias("repos"), F.first("core").alias("core"))
    values = stored(spark, by_owner.groupBy("h").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.first("core").alias("core"))
        .withColumn("is_live", (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
                    & (F.size(F.array_distinct(F.split("core", ""))) >= MIN_DISTINCT)
                    & F.col("core").rlike("[0-9]") & F.col("core").rlike("[A-Za-z]")), "secret-values")

    led = F.length("value") - F.length(F.ltrim("value", F.lit(ENDS)))
    bare = (keyed(_spans(rows, "live", "bare"))
            .withColumn("start", F.col("start") + led).withColumn("stop", F.col("start") + F.length("core"))
            .join(values.filter("is_live").select("h"), "h", "left_semi"))
    mine = base.select("rid", F.col("start").alias("s"), F.col("stop").alias("e"))
    extra = (bare.join(mine, (bare["rid"] == mine["rid"]) & (F.col("s") < F.col("stop")) & (F.col("e") > F.col("start")),
                       "left_anti")
             .select("rid", "start", F.lit(len(KINDS)).alias("rank"), "kind", "stop", F.lit(None).cast("boolean")
                     .alias("is_live")))
    judged = base.join(values.select("h", "is_live"), "h").select("rid", "start", "rank", "kind", "stop", "is_live")
    per_row = judged.unionByName(extra).groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "stop"))).alias("spans"),
        F.count_if(F.col("is_live")).alias("live"), F.count_if(~F.col("is_live")).alias("copied"))
    none = F.array().cast(per_row.schema["spans"].dataType)
    return rows.select("rid", "id").join(per_row, "rid", "left").select(
        "id", F.coalesce("spans", none).alias("spans"), F.coalesce("live", F.lit(0)).alias("live"),
        F.coalesce("copied", F.lit(0)).alias("copied"))


def joined(spans: Column) -> Column:
    """kind:start:stop of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
