"""Page-view track: dump decoding, CSV round trip, classification,
validation balance, partitioned Parquet, snapshot slices, lookup join."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import pageviews as pv
from strata.sources.pageviews import InvalidUtf8, kept_per_file, read_pageviews
from strata.sources.tables import RoundTripMismatch, load_slices

LINES = [
    "en Main_Page 5 0",
    "en Special:Search 7 0",
    "en ISO:Foo 2 0",
    "en ISO_3166-2:US 4 0",
    'en "Boys_are_stupid,_throw_rocks_at_them!"_controversy 1 0',
    "de Berlin 9 0",
    "en Bad 3",
    "en D 1 0 ",
]


def write_dump(folder, name, lines, raw=None):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wb") as f:
        f.write(raw if raw is not None else ("\n".join(lines) + "\n").encode("utf-8"))


@pytest.fixture()
def dumps(workdir):
    d = os.path.join(workdir, "dumps")
    write_dump(d, "pageviews-20150501-010000.gz", LINES)
    write_dump(d, "pageviews-20150501-020000.gz", ["en Talk:Foo 3 0", "en Main_Page 2 0"])
    return d


def test_decode_filters_and_file_metadata(spark, dumps):
    rows = read_pageviews(spark, dumps + "/pageviews-20150501-010000.gz")
    got = sorted((r["page_title"], r["count_views"], str(r["event_date"]), r["event_hour"]) for r in rows.collect())
    assert len(got) == 5
    assert ("Main_Page", "5", "2015-05-01", 1) in got
    per_file = {r["file_name"]: r["rows"] for r in kept_per_file(read_pageviews(spark, dumps)).collect()}
    assert per_file == {"pageviews-20150501-010000.gz": 5, "pageviews-20150501-020000.gz": 2, None: 7}


def test_invalid_utf8_fails_or_is_quarantined(spark, workdir):
    d = os.path.join(workdir, "bad")
    write_dump(d, "pageviews-20150501-010000.gz", [], raw=b"en ok 1 0\nen \xff\xfe 1 0\n")
    with pytest.raises(Exception, match=InvalidUtf8.__name__):
        read_pageviews(spark, d).collect()
    assert read_pageviews(spark, d, strict_utf8="drop").count() == 1


def test_staging_csv_round_trip_and_totals(spark, dumps, workdir):
    csv = os.path.join(workdir, "staging")
    pv.stage_dumps(spark, dumps + "/pageviews-20150501-010000.gz", csv)
    typed = pv.typed_pages(spark, csv)
    titles = {r["page_title"] for r in typed.collect()}
    assert '"Boys_are_stupid,_throw_rocks_at_them!"_controversy' in titles
    totals = [(r["namespace"], r["pages"], r["total_views"]) for r in pv.namespace_totals(typed).collect()]
    assert totals == [("(article)", 4, 12), ("Special", 1, 7)]
    lookup = spark.createDataFrame([("(article)", "Main")], "namespace string, content_group string")
    groups = {r["content_group"]: (r["pages"], r["total_views"]) for r in pv.content_groups(typed, lookup).collect()}
    assert groups == {"Main": (4, 12), pv.UNMATCHED: (1, 7)}
    audit = pv.lookup_audit(typed, lookup).first()
    assert (audit["before_join"], audit["after_join"], audit["unmatched"]) == (5, 5, 1)


def test_duplicate_lookup_key_is_detected(spark, dumps, workdir):
    csv = os.path.join(workdir, "staging")
    pv.stage_dumps(spark, dumps + "/pageviews-20150501-010000.gz", csv)
    typed = pv.typed_pages(spark, csv)
    lookup = spark.createDataFrame([("(article)", "Main"), ("(article)", "Again")], "namespace string, content_group string")
    audit = pv.lookup_audit(typed, lookup).first()
    assert audit["after_join"] == 9 and audit["before_join"] == 5


def test_validation_first_reason_and_balance(spark):
    import datetime as dt
    d = dt.date(2015, 5, 1)
    rows = [
        ("en", "Ok", 1, 0, d, 1),
        ("en", " ", 1, 0, d, 1),        # blank title
        ("en", "A", None, 0, d, 1),     # NULL count
        ("en", "B", -1, 0, d, 2),       # negative count
        ("de", "C", 1, 0, d, 1),        # domain
        (None, "D", 1, 0, d, 1),        # NULL domain
        ("en", "E", 1, 0, d, 3),        # hour 3
        ("en", "F", 1, 0, d, None),     # NULL hour
        ("de", None, -5, 0, None, 7),   # several faults: first one wins
    ]
    df = pv.with_namespace(spark.createDataFrame(rows, pv.STAGING_SCHEMA))
    accepted, profile = pv.validate(df, pv.page_rules((1, 2)))
    split = profile["outcomes"]
    assert split == {"accepted": 1, "null_page_title": 2, "bad_count_views": 2, "bad_domain": 2, "bad_time": 2}
    assert sum(split.values()) == profile["rows"] == 9
    assert accepted.count() == 1
    assert profile["null_page_title"] == 2 and profile["bad_domain"] == 3


def test_partitioned_parquet_and_slices(spark, dumps, workdir):
    csv = os.path.join(workdir, "staging")
    pv.stage_dumps(spark, dumps, csv)
    accepted, profile = pv.validate(pv.typed_pages(spark, csv))
    pq = os.path.join(workdir, "parquet")
    back = pv.load_partitioned(spark, accepted, pq, profile["outcomes"]["accepted"])
    assert back.count() == 7
    with pytest.raises(RoundTripMismatch):
        pv.load_partitioned(spark, accepted, os.path.join(workdir, "other"), 8)
    table = pv.load_hours(back, os.path.join(workdir, "table"))
    assert sorted(map(tuple, table.groupBy("event_hour").count().collect())) == [(1, 5), (2, 2)]
    with pytest.raises(RoundTripMismatch):          # slices that leave rows out
        load_slices(back, os.path.join(workdir, "part"), "event_hour", [F.col("event_hour") == 1])
    top = pv.top_pages(table, 2).collect()
    assert [(r["page_title"], r["count_views"]) for r in top] == [("Special:Search", 7), ("Main_Page", 5)]
