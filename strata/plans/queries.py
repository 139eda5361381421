"""Registered queries over the driver tables, each paired with its oracle SQL.

Every query reads whole tables (no id subsets, no row caps); limits appear
only where the limit is the feature (top-N reports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import aggregates as agg
from strata.operators.joins import join_audit, lookup_join
from strata.plans import feeds as fd
from strata.plans import oracle as o
from strata.plans.quakes import Layers, build_layers, checkpoint_dims

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


# --- shared builders -----------------------------------------------------------

def events_layers(spark: SparkSession, sf_dir: str, start: str | None = None,
                  end: str | None = None) -> Layers:
    """Layers of ``[start, end)``, or of all days of ``events``."""
    events = fd.read_table(spark, sf_dir, "events")
    if start is None:
        start, end = fd.event_bounds(events)
    typed = fd.events_typed(events)
    history = fd.user_history(events)
    return build_layers(spark, typed, history, start, end, classes=fd.VALUE_CLASSES,
                        fact_types=fd.FACT_TYPES, keep=checkpoint_dims)


def page_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-view rows pre-aggregated to one row per part key (partial
    aggregation over the large line table), then classified by the part name.

    ``pages`` and ``views`` per part; grouping by the namespace afterwards
    gives the same totals as classifying every line."""
    from strata.functions import classify_prefix
    li = fd.read_table(spark, sf_dir, "lineitem")
    part = fd.read_table(spark, sf_dir, "part")
    per_part = (li.groupBy("l_partkey")
                .agg(F.count(F.lit(1)).alias("pages"),
                     F.sum(F.col("l_quantity").cast("int")).alias("views")))
    names = part.select("p_partkey", "p_name")
    j = per_part.join(names, per_part["l_partkey"] == names["p_partkey"], "left")
    return j.select(classify_prefix("p_name", fd.WORD_PATTERN, fd.KNOWN_WORDS, fd.DEFAULT_CLASS)
                    .alias("namespace"), "pages", "views")


def word_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fd.WORD_GROUPS, "namespace string, content_group string")


# --- flagship: daily mart ----------------------------------------------------------

@register("daily_mart", o.elt_ctes() + "SELECT * FROM mart")
def q_daily_mart(spark, sf_dir):
    return events_layers(spark, sf_dir).mart


# --- page-view track --------------------------------------------------------------------

@register("class_totals", f"""
SELECT {o.namespace_expr('page_title')} AS namespace, count(*) AS pages,
       CAST(sum(count_views) AS BIGINT) AS total_views
FROM ({o.PAGE_ROWS}) r GROUP BY 1""")
def q_class_totals(spark, sf_dir):
    ns = page_namespaces(spark, sf_dir)
    # at most one group per known word plus the default: sorted in one partition
    return (ns.groupBy("namespace")
            .agg(F.sum("pages").cast("long").alias("pages"), F.sum("views").cast("long").alias("total_views"))
            .coalesce(1).sortWithinPartitions(F.desc("total_views"), "namespace"))


@register("lookup_agg", f"""
SELECT coalesce(g.content_group, {o.q(fd.UNMATCHED_GROUP)}) AS content_group, count(*) AS pages,
       CAST(sum(r.count_views) AS BIGINT) AS total_views
FROM (SELECT {o.namespace_expr('page_title')} AS namespace, count_views FROM ({o.PAGE_ROWS}) x) r
LEFT JOIN ({o.lookup_values()}) g ON r.namespace = g.namespace
GROUP BY 1""")
def q_lookup_agg(spark, sf_dir):
    ns = page_namespaces(spark, sf_dir)
    per_ns = ns.groupBy("namespace").agg(F.sum("pages").alias("pages"), F.sum("views").alias("views"))
    j = lookup_join(per_ns, word_lookup(spark), "namespace", "content_group", fd.UNMATCHED_GROUP)
    # at most one group per lookup value plus the default: sorted in one partition
    return (j.groupBy("content_group")
            .agg(F.sum("pages").cast("long").alias("pages"), F.sum("views").cast("long").alias("total_views"))
            .coalesce(1).sortWithinPartitions(F.desc("total_views"), "content_group"))


@register("join_audit", f"""
SELECT (SELECT count(*) FROM lineitem) AS before_join, count(*) AS after_join,
       count(*) FILTER (WHERE g.namespace IS NULL) AS unmatched
FROM (SELECT {o.namespace_expr('page_title')} AS namespace FROM ({o.PAGE_ROWS}) x) r
LEFT JOIN ({o.lookup_values()}) g ON r.namespace = g.namespace""")
def q_join_audit(spark, sf_dir):
    ns = page_namespaces(spark, sf_dir)
    per_ns = ns.groupBy("namespace").agg(F.sum("pages").alias("rows"))
    return join_audit(per_ns, word_lookup(spark), "namespace", weight="rows")


@register("top_views", f"""
SELECT page_title, {o.namespace_expr('page_title')} AS namespace, count_views, l_orderkey, l_linenumber
FROM (SELECT p.p_name AS page_title, CAST(l.l_quantity AS INTEGER) AS count_views, l.l_orderkey,
             l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
      FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey) r
ORDER BY count_views DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
LIMIT 10""")
def q_top_views(spark, sf_dir):
    from strata.functions import classify_prefix
    li = fd.read_table(spark, sf_dir, "lineitem")
    part = fd.read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("page_title"))
    rows = li.select(F.col("l_quantity").cast("int").alias("count_views"), "l_orderkey", "l_linenumber",
                     "l_partkey", "l_suppkey", "l_extendedprice")
    order = [F.desc("count_views"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey"),
             F.asc("l_suppkey"), F.asc("l_extendedprice")]
    # Top-N first (per-task top-N + merge), then the 10 rows meet the part table.
    top = agg.top_n(rows, 10, order)
    j = top.join(part, top["l_partkey"] == part["p_partkey"], "left")
    return (j.select("page_title",
                     classify_prefix("page_title", fd.WORD_PATTERN, fd.KNOWN_WORDS, fd.DEFAULT_CLASS).alias("namespace"),
                     "count_views", "l_orderkey", "l_linenumber", *[c for c in ["l_partkey", "l_suppkey", "l_extendedprice"]])
            .orderBy(*order).select("page_title", "namespace", "count_views", "l_orderkey", "l_linenumber"))
