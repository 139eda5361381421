"""Page-view lakehouse plan: hourly dumps -> staging CSV -> typed, classified
and validated table -> partitioned Parquet -> table loaded in disjoint
slices -> namespace totals, top pages and a lookup join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import classify_prefix
from strata.operators import aggregates as agg
from strata.operators.joins import join_audit, lookup_join
from strata.sources.pageviews import STAGING_SCHEMA, read_pageviews
from strata.sources.tables import (RoundTripMismatch, assert_roundtrip, load_slices, read_typed_csv,
                                   write_partitioned, write_staging_csv)

# The namespace prefixes treated as real namespaces, the prefix
# pattern, the default class, the accepted domain, and the content
# group of unmatched rows.
KNOWN_NAMESPACES = (
    "Media", "Special", "Talk", "User", "User_talk", "Wikipedia", "Wikipedia_talk",
    "File", "File_talk", "MediaWiki", "MediaWiki_talk", "Template", "Template_talk",
    "Help", "Help_talk", "Category", "Category_talk", "Portal", "Portal_talk",
    "Draft", "Draft_talk", "Module", "Module_talk", "Book", "TimedText", "TimedText_talk",
)
NAMESPACE_PATTERN = r"^([A-Za-z_]+):"
ARTICLE = "(article)"
DOMAIN = "en"
UNMATCHED = "Не сопоставлен"


def with_namespace(df: DataFrame, title: str = "page_title") -> DataFrame:
    return df.withColumn("namespace", classify_prefix(title, NAMESPACE_PATTERN, KNOWN_NAMESPACES, ARTICLE))


def page_rules(hours: Sequence[int] | None = None, domain: str = DOMAIN) -> list[tuple[str, Column]]:
    """Validation rules as null-safe failure conditions, in priority order;
    ``hours``: accepted hours of the day, all by default."""
    hours = range(24) if hours is None else hours
    title, views = F.col("page_title"), F.col("count_views")
    return [
        ("null_page_title", title.isNull() | (F.trim(title) == "")),
        ("bad_count_views", views.isNull() | (views < 0)),
        ("bad_domain", F.col("domain_code").isNull() | (F.col("domain_code") != domain)),
        ("bad_time", F.col("event_date").isNull() | F.col("event_hour").isNull()
         | ~F.col("event_hour").isin(list(hours))),
    ]


def stage_dumps(spark: SparkSession, dump_path: str, staging_csv: str, domain: str = DOMAIN,
                strict_utf8: str = "fail") -> None:
    """Dumps -> staging CSV (header, RFC 4180 quoting)."""
    rows = read_pageviews(spark, dump_path, domain=domain, strict_utf8=strict_utf8)
    write_staging_csv(rows.select(*STAGING_SCHEMA.fieldNames()), staging_csv)


def typed_pages(spark: SparkSession, staging_csv: str) -> DataFrame:
    return with_namespace(read_typed_csv(spark, staging_csv, STAGING_SCHEMA))


def validate(df: DataFrame, rules=None):
    """``(accepted rows, profile)``: profile and outcome counts come from one
    pass; the accepted rows are lazy."""
    rules = rules or page_rules()
    profile = agg.profile_and_split(df, rules, share_of="null_page_title")
    if profile["rows"] == 0:
        raise ValueError("staging input is empty")
    return agg.tag_rejects(df, rules).filter("reject_reason IS NULL").drop("reject_reason"), profile


def load_partitioned(spark: SparkSession, accepted: DataFrame, path: str, expected: int) -> DataFrame:
    """Accepted rows written once; read back they must be ``expected`` rows of
    the same columns."""
    write_partitioned(accepted, path, "event_hour")
    back = spark.read.parquet(path)
    assert_roundtrip(accepted, back, count=False)
    if (n := back.count()) != expected:
        raise RoundTripMismatch(f"{n} rows written, {expected} accepted")
    return back


def load_hours(pages: DataFrame, table: str) -> DataFrame:
    """Replace the table by the first hour and append each further hour (at
    most 24), then check its rows against ``pages``."""
    hours = sorted(r[0] for r in pages.select("event_hour").distinct().collect())
    return load_slices(pages, table, "event_hour", [F.col("event_hour") == h for h in hours])


def namespace_totals(df: DataFrame) -> DataFrame:
    return agg.class_totals(df, "namespace", "count_views")


def top_pages(df: DataFrame, n: int = 10) -> DataFrame:
    order = [F.desc("count_views"), F.asc("page_title"), F.asc("event_hour")]
    return agg.top_n(df.select("page_title", "namespace", "count_views", "event_hour"), n, order)


def content_groups(df: DataFrame, lookup: DataFrame, default: str = UNMATCHED) -> DataFrame:
    j = lookup_join(df, lookup, "namespace", "content_group", default)
    return agg.class_totals(j, "content_group", "count_views")


def lookup_audit(df: DataFrame, lookup: DataFrame) -> DataFrame:
    per_ns = df.groupBy("namespace").agg(F.count(F.lit(1)).alias("rows"))
    return join_audit(per_ns, lookup, "namespace", weight="rows")
