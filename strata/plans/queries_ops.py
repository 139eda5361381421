"""Registered queries: document quality profile and accepted split,
publication and its log, snapshot tables, table comparison, format round
trips and the landed-file inventory."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import classify_prefix
from strata.operators import aggregates as agg
from strata.operators.compare import compare, labelled_diff, labelled_diff_by_part, read_snapshot, snapshot
from strata.operators.publish import Publisher
from strata.plans import feeds as fd
from strata.plans import oracle as o
from strata.plans.queries import events_layers, register
from strata.plans.queries_elt import case_layers
from strata.session import shared_dir
from strata.sources.tables import assert_roundtrip, load_slices, write_partitioned

# --- document quality profile (page-view validation rules) ------------------------------

def doc_rules():
    text, n, lang = F.col("text"), F.col("n_chars"), F.col("lang")
    return [
        ("blank_text", text.isNull() | (F.trim(text) == "")),
        ("bad_n_chars", n.isNull() | (n < 0)),
        ("bad_lang", lang.isNull() | (lang != fd.DOC_LANG)),
    ]


DOC_RULES_SQL = [
    ("blank_text", "text IS NULL OR trim(text) = ''"),
    ("bad_n_chars", "n_chars IS NULL OR n_chars < 0"),
    ("bad_lang", f"lang IS NULL OR lang <> {o.q(fd.DOC_LANG)}"),
]


@register("quality_profile", "SELECT count(*) AS rows, "
          + ", ".join(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in DOC_RULES_SQL)
          + f", {o.half_up('count(*) FILTER (WHERE ' + DOC_RULES_SQL[0][1] + ')', 'count(*)', 0, 6)} "
            "AS blank_text_share FROM documents")
def q_quality_profile(spark, sf_dir):
    docs = fd.read_table(spark, sf_dir, "documents").select("text", "n_chars", "lang")
    return agg.quality_profile(docs, doc_rules(), share_of="blank_text")


@register("accepted_split", "SELECT CASE "
          + " ".join(f"WHEN {c} THEN {o.q(n)}" for n, c in DOC_RULES_SQL)
          + " ELSE 'accepted' END AS outcome, count(*) AS rows FROM documents GROUP BY 1")
def q_accepted_split(spark, sf_dir):
    docs = fd.read_table(spark, sf_dir, "documents").select("text", "n_chars", "lang")
    return agg.split_summary(agg.tag_rejects(docs, doc_rules()))


@register("accepted_rows", "SELECT doc_id, lang, n_chars FROM documents WHERE NOT ("
          + " OR ".join(f"coalesce({c}, TRUE)" for _n, c in DOC_RULES_SQL) + ")")
def q_accepted_rows(spark, sf_dir):
    docs = fd.read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", "lang")
    accepted, _rejected, _summary = agg.split_accepted(docs, doc_rules())
    return accepted.select("doc_id", "lang", "n_chars")


# --- publication --------------------------------------------------------------------------

PUB_WINDOW = ("2024-01-10", "2024-01-20")
MART_COLS = sorted(["event_date", "class_key", "magnitude_class", "source_system", "net", "network_name",
                    "events", "avg_magnitude", "max_magnitude", "avg_depth_km"])


def _published(spark, sf_dir):
    """Publish the baseline mart for the whole window, then the mart of the
    late-correction run for a sub-window; returns the publisher."""
    pub = Publisher(spark, shared_dir(spark, "published-mart"))
    bounds = fd.event_bounds(fd.read_table(spark, sf_dir, "events"))
    pub.publish(events_layers(spark, sf_dir).mart, *bounds, run_id="run-baseline")
    pub.publish(case_layers(spark, sf_dir, "late").mart, *PUB_WINDOW, run_id="run-late")
    return pub


def _mart_sql(case):
    return f"(WITH {o.case_ctes(case)[5:]} SELECT * FROM mart)"


PUBLISHED_SQL = f"""SELECT * FROM {_mart_sql('baseline')} a
WHERE NOT ({o.window_pred('event_date', *PUB_WINDOW)})
UNION ALL
SELECT * FROM {_mart_sql('late')} b WHERE {o.window_pred('event_date', *PUB_WINDOW)}"""


def checksum_sql(table: str, cols) -> str:
    text = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'N')" for c in cols)
    return (f"SELECT count(*) AS rows, CAST(count(*) AS VARCHAR) || ':' || "
            f"CAST(coalesce(sum(('0x' || substr(md5({text}), 1, 15))::BIGINT), 0) AS VARCHAR) AS checksum "
            f"FROM {table}")


@register("publish_window", PUBLISHED_SQL)
def q_publish_window(spark, sf_dir):
    return _published(spark, sf_dir).live()


@register("publication_log", f"""
SELECT 'run-baseline' AS run_id, {o.FIRST_DAY} AS start_date, {o.END_DAY} AS end_date,
       rows AS rows_published, checksum, 1 AS version
FROM ({checksum_sql(f"(SELECT * FROM {_mart_sql('baseline')}) x", MART_COLS)}) c1
UNION ALL
SELECT 'run-late', DATE {o.q(PUB_WINDOW[0])}, DATE {o.q(PUB_WINDOW[1])}, rows, checksum, 2
FROM ({checksum_sql(f"(SELECT * FROM ({PUBLISHED_SQL}) p WHERE {o.window_pred('event_date', *PUB_WINDOW)}) y", MART_COLS)}) c2""")
def q_publication_log(spark, sf_dir):
    return _published(spark, sf_dir).log().drop("published_at", "schema_json")


@register("publication_last", f"""
SELECT 'run-late' AS run_id, DATE {o.q(PUB_WINDOW[0])} AS start_date, DATE {o.q(PUB_WINDOW[1])} AS end_date,
       rows AS rows_published, checksum, 2 AS version
FROM ({checksum_sql(f"(SELECT * FROM {_mart_sql('late')} p WHERE {o.window_pred('event_date', *PUB_WINDOW)}) y", MART_COLS)}) c""")
def q_publication_last(spark, sf_dir):
    return _published(spark, sf_dir).last_publication("run-late").drop("published_at", "schema_json")


# --- a table replaced by its first slice, further slices appended --------------------------

SPLIT_DAY = "2024-01-16"


@register("sliced_load", """SELECT CAST(ts AS DATE) AS event_date, count(*) AS rows FROM events GROUP BY 1""")
def q_sliced_load(spark, sf_dir):
    """Versions loaded as two disjoint slices; the load itself fails unless
    the final table holds as many rows as were accepted."""
    versions = events_layers(spark, sf_dir).versions
    split = F.col("event_date") < F.lit(SPLIT_DAY).cast("date")
    table = load_slices(versions, shared_dir(spark, "sliced-events") + "/t", "event_date", [split, ~split])
    return table.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


# --- comparing two runs ---------------------------------------------------------------------

def _two_runs(spark, sf_dir):
    """Marts of the baseline and the late-correction run, each computed once
    and checkpointed to the shared checkpoint folder (both are scanned by
    several comparisons)."""
    from strata.session import checkpoint_root
    checkpoint_root(spark)
    return (events_layers(spark, sf_dir).mart.checkpoint(),
            case_layers(spark, sf_dir, "late").mart.checkpoint())


def _set_count(a, b, op):
    cols = ", ".join(MART_COLS)
    return f"(SELECT count(*) FROM (SELECT {cols} FROM {a} x {op} SELECT {cols} FROM {b} y) z)"


@register("compare_tables", f"""
SELECT *, (only_in_a = 0 AND only_in_b = 0 AND rows_a = rows_b AND checksum_a = checksum_b) AS identical FROM (
SELECT {_set_count(_mart_sql('baseline'), _mart_sql('late'), 'EXCEPT')} AS only_in_a,
       {_set_count(_mart_sql('late'), _mart_sql('baseline'), 'EXCEPT')} AS only_in_b,
       ca.rows AS rows_a, ca.checksum AS checksum_a, cb.rows AS rows_b, cb.checksum AS checksum_b
FROM ({checksum_sql(_mart_sql('baseline') + ' m1', MART_COLS)}) ca,
     ({checksum_sql(_mart_sql('late') + ' m2', MART_COLS)}) cb) v""")
def q_compare_tables(spark, sf_dir):
    a, b = _two_runs(spark, sf_dir)
    return compare(a, b)


@register("labelled_diff", f"""
SELECT 'baseline' AS src, * FROM (SELECT {', '.join(MART_COLS)} FROM {_mart_sql('baseline')} a
  EXCEPT ALL SELECT {', '.join(MART_COLS)} FROM {_mart_sql('late')} b) x
UNION ALL
SELECT 'late' AS src, * FROM (SELECT {', '.join(MART_COLS)} FROM {_mart_sql('late')} a
  EXCEPT ALL SELECT {', '.join(MART_COLS)} FROM {_mart_sql('baseline')} b) y""")
def q_labelled_diff(spark, sf_dir):
    a, b = _two_runs(spark, sf_dir)
    return labelled_diff(a, b, "baseline", "late")


@register("published_diff", f"""
SELECT 'before' AS src, * FROM (SELECT {', '.join(MART_COLS)} FROM {_mart_sql('baseline')} a
  EXCEPT ALL SELECT {', '.join(MART_COLS)} FROM ({PUBLISHED_SQL}) b) x
UNION ALL
SELECT 'after' AS src, * FROM (SELECT {', '.join(MART_COLS)} FROM ({PUBLISHED_SQL}) a
  EXCEPT ALL SELECT {', '.join(MART_COLS)} FROM {_mart_sql('baseline')} b) y""")
def q_published_diff(spark, sf_dir):
    """What the second publication changed: day by day digests first, then the
    rows of the changed days."""
    pub = _published(spark, sf_dir)
    root = shared_dir(spark, "before") + "/t"
    write_partitioned(events_layers(spark, sf_dir).mart, root, "event_date")
    return labelled_diff_by_part(spark.read.parquet(root), pub.live(), "event_date", "before", "after")


@register("qa_copy", f"SELECT * FROM {_mart_sql('baseline')} m")
def q_qa_copy(spark, sf_dir):
    """The mart through a named QA copy."""
    root = shared_dir(spark, "qa")
    snapshot(events_layers(spark, sf_dir).mart, root, "mart", "baseline")
    return read_snapshot(spark, root, "mart", "baseline")


@register("day_field_counts", """SELECT event_type, count(*) AS rows FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY 1""")
def q_day_field_counts(spark, sf_dir):
    """Events per type on the last day."""
    versions = events_layers(spark, sf_dir).versions
    last = F.date_sub(F.lit(fd.event_bounds(fd.read_table(spark, sf_dir, "events"))[1]).cast("date"), 1)
    return agg.field_counts(versions, last, "event_type")


# --- format round trips ----------------------------------------------------------------------

PAGE_SCHEMA = T.StructType([
    T.StructField("page_title", T.StringType()),
    T.StructField("namespace", T.StringType()),
    T.StructField("count_views", T.IntegerType()),
])


def classified_pages(spark, sf_dir):
    """Page rows with their namespace, as the staged table carries it."""
    rows = fd.page_rows(fd.read_table(spark, sf_dir, "lineitem"), fd.read_table(spark, sf_dir, "part"))
    return rows.select("page_title", classify_prefix("page_title", fd.WORD_PATTERN, fd.KNOWN_WORDS,
                                                     fd.DEFAULT_CLASS).alias("namespace"), "count_views")


def _namespace_totals(df):
    """The compared query: pages and views per namespace, by views (at most
    one group per known word plus the default class)."""
    return agg.class_totals(df, "namespace", "count_views")


@register("format_compare", f"""
SELECT {o.namespace_expr('page_title')} AS namespace, count(*) AS pages,
       CAST(sum(count_views) AS BIGINT) AS total_views
FROM ({o.PAGE_ROWS}) r GROUP BY 1""")
def q_format_compare(spark, sf_dir):
    """Page rows through a staging CSV and a Parquet copy; the namespace
    totals must agree between the two (one trial here, three in bench)."""
    from strata.plans.measure import compare_formats
    result, _t, _s = compare_formats(spark, classified_pages(spark, sf_dir), PAGE_SCHEMA, _namespace_totals,
                                     shared_dir(spark, "formats"), trials=1)
    return result


@register("partitioned_roundtrip", """
SELECT CAST(ts AS DATE) AS event_date, count(*) AS rows FROM events GROUP BY 1""")
def q_partitioned_roundtrip(spark, sf_dir):
    versions = events_layers(spark, sf_dir).versions
    path = shared_dir(spark, "versions-by-date")
    write_partitioned(versions, path, "event_date")
    back = spark.read.parquet(path)
    assert_roundtrip(versions, back)
    return back.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))
