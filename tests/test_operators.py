"""Unit tests of the operators on small literal inputs."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import half_up_ratio, surrogate_key
from strata.operators import aggregates as agg
from strata.operators import quality as dq
from strata.operators.compare import compare, labelled_diff, table_diff
from strata.operators.dims import calendar
from strata.operators.joins import band_join, find_overlaps, join_audit, one_row, orphans, reconcile
from strata.operators.publish import Publisher, SchemaDrift, publish_window, reprocess_window
from strata.operators.staging import latest_version


def test_half_up_ratio_is_exact(spark):
    df = spark.createDataFrame(
        [(Decimal("112.935000"), 3), (Decimal("-112.935000"), 3), (Decimal("7.003498"), 7), (None, 2), (Decimal("1"), 0)],
        "s decimal(28,6), n long")
    got = [r[0] for r in df.select(half_up_ratio("s", "n", 6, 2)).collect()]
    assert got[:2] == [Decimal("37.65"), Decimal("-37.65")]
    assert [r[0] for r in df.select(half_up_ratio("s", "n", 6, 3)).collect()][2] == Decimal("1.000")
    assert got[3] is None and got[4] is None


def test_half_up_ratio_of_plain_values_is_long_arithmetic(spark):
    """Decimal division only beyond 64 bits, and the same result on both sides of the bound."""
    most = 4 * 10 ** 18 // (2 * 1000 * 10 ** 6)
    rows = [(Decimal(x), n) for x in (most - 1, most, most + 1, -most, -most - 1, 7) for n in (1, 2, 3, 10 ** 13)]
    df = spark.createDataFrame(rows, "s decimal(38,6), n long").select("s", "n", half_up_ratio("s", "n", 6, 3).alias("q"))
    assert "AS BIGINT" in df.select("q")._jdf.queryExecution().analyzed().toString().upper()
    for s, n, q in df.collect():
        assert q == (s / n).quantize(Decimal("0.001"), rounding="ROUND_HALF_UP")


def test_surrogate_key_md5_and_null(spark):
    df = spark.createDataFrame([("usgs", "us1"), ("usgs", None)], "a string, b string")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert keys[0] == hashlib.md5(b"usgs|us1").hexdigest() and keys[1] is None


def test_latest_version_nulls_first_and_ties(spark):
    rows = [("k", None, 0, 1), ("k", dt.datetime(2025, 1, 2), 1, 5), ("j", dt.datetime(2025, 1, 1), 0, 1),
            ("j", dt.datetime(2025, 1, 1), 0, 2), ("j", dt.datetime(2025, 1, 1), 1, 1)]
    df = spark.createDataFrame(rows, "key string, upd timestamp, slice int, rn int")
    out = {r["key"]: (r["slice"], r["rn"], r["upd"]) for r in latest_version(df, ["key"], ["upd", "slice", "rn"]).collect()}
    assert out["k"] == (0, 1, None)
    assert out["j"][:2] == (1, 1)


def test_latest_version_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = latest_version(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_band_join_case_and_overlap(spark):
    df = spark.createDataFrame([(Decimal("1.5"),), (Decimal("2.0"),), (Decimal("20"),)], "m decimal(18,6)")
    bands = [(1, -10, 2), (2, 2, 4)]
    assert [r["class_key"] for r in band_join(df, "m", bands).orderBy("m").collect()] == [1, 2, None]
    over = [(1, 0, 3), (2, 1, 4)]
    assert band_join(df, "m", over).filter(F.col("m") == 2).count() == 2


def test_find_overlaps_and_identical_keys(spark):
    ts = lambda d: dt.datetime(2025, 3, d)
    rows = [("s", "us", "a", ts(1), ts(10)), ("s", "us", "b", ts(5), ts(20)), ("s", "us", "c", ts(20), ts(25)),
            ("s", "ak", "x", ts(1), ts(2)), ("s", "ak", "x", ts(1), ts(2))]
    dim = spark.createDataFrame(rows, "src string, net string, key string, valid_from timestamp, valid_to timestamp")
    pairs = [(r["net"], r["version_a"], r["version_b"]) for r in find_overlaps(dim, ["src", "net"], "key").collect()]
    assert pairs == [("us", "a", "b")]


def test_checksum_is_order_insensitive_and_multiset_sensitive(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "i int, s string")
    c = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (2, "y")], "i int, s string")
    ca, cb, cc = (agg.table_checksum(x).first()["checksum"] for x in (a, b, c))
    assert ca == cb and ca != cc
    empty = spark.createDataFrame([], "i int, s string")
    assert agg.table_checksum(empty).first()["checksum"] == "0:0"


def test_compare_and_diffs(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string")
    d = table_diff(a, b).first()
    assert (d["only_in_a"], d["only_in_b"]) == (0, 0)       # set semantics hide multiplicity
    assert table_diff(a, b, multiset=True).first()["only_in_a"] == 1
    v = compare(a, b).first()
    assert not v["identical"] and v["rows_a"] == 3
    assert compare(b, b).first()["identical"]
    lab = [(r["src"], r["i"]) for r in labelled_diff(a, b).collect()]
    assert lab == [("a", 1)]


def test_one_row_and_join_audit(spark):
    x = spark.createDataFrame([(1,)], "a int")
    y = spark.createDataFrame([("z",)], "b string")
    assert one_row(x, y).first().asDict() == {"a": 1, "b": "z"}
    left = spark.createDataFrame([("p",), ("q",), ("q",)], "k string")
    right = spark.createDataFrame([("q", 1)], "k string, v int")
    r = join_audit(left, right, "k").first()
    assert (r["before_join"], r["after_join"], r["unmatched"]) == (3, 3, 1)


def test_quality_tests_semantics(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None), (None, "z"), (None, "z"), ("c", "bad")],
                               "k string, v string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    t = {"t": df, "p": parent}
    tests = [dq.not_null("t", "k"), dq.unique("t", "k"), dq.accepted_values("t", "v", ["x", "y", "z"]),
             dq.relationships("t", "k", "p", "k")]
    res = {r["test_name"]: (r["failures"], r["status"]) for r in dq.summary(tests, t).collect()}
    assert res["not_null_t_k"] == (2, "fail")
    assert res["unique_t_k"] == (1, "fail")                 # one row per duplicated key
    assert res["accepted_values_t_v"] == (1, "fail")        # NULL passes
    assert res["relationships_t_k__p"] == (1, "fail")       # NULL child passes, 'c' fails
    with pytest.raises(dq.GateFailed):
        dq.gate(dq.summary(tests, t))
    assert orphans(df, "k", parent, "k").count() == 1


def test_reconcile_is_null_safe(spark):
    a = spark.createDataFrame([(1, 5), (2, 3)], "d int, fa long")
    b = spark.createDataFrame([(1, 5), (3, 1)], "d int, fb long")
    assert sorted(r["d"] for r in reconcile(a, b, "d", "fa", "fb").collect()) == [2, 3]


def test_calendar_sunday(spark):
    rows = calendar(spark, "2024-01-06", "2024-01-08").collect()
    assert [(r["iso_weekday"], r["weekday_name"]) for r in rows] == [(6, "Sat"), (7, "Sun")]


def test_share_and_top_n(spark):
    mart = spark.createDataFrame([("d", "us", 2), ("d", "ak", 1), ("e", "us", 3)], "event_date string, net string, events long")
    share = {(r["event_date"], r["net"]): r["share_pct"] for r in agg.share_of_total(mart).collect()}
    assert share[("d", "us")] == Decimal("66.7") and share[("e", "us")] == Decimal("100.0")
    top = agg.top_n_per_group(mart, "event_date", [F.desc("events"), F.asc("net")], 1).collect()
    assert sorted((r["event_date"], r["net"]) for r in top) == [("d", "us"), ("e", "us")]


def test_publish_window_and_schema_drift(spark, workdir):
    d = lambda x: dt.date(2025, 3, x)
    cand1 = spark.createDataFrame([(d(3), 1), (d(4), 2), (d(5), 3)], "event_date date, v int")
    cand2 = spark.createDataFrame([(d(5), 30)], "event_date date, v int")
    pub = Publisher(spark, workdir + "/pub")
    pub.publish(cand1, "2025-03-03", "2025-03-06", "r1")
    log = pub.publish(cand2, "2025-03-04", "2025-03-06", "r2")
    assert log["rows_published"] == 1 and log["version"] == 2
    assert sorted((r["event_date"], r["v"]) for r in pub.live().collect()) == [(d(3), 1), (d(5), 30)]
    assert pub.last_publication("r1").first()["version"] == 1
    with pytest.raises(SchemaDrift):
        pub.publish(spark.createDataFrame([(d(5), "x")], "event_date date, v string"), "2025-03-05", "2025-03-06", "r3")
    assert pub.live_version() == 2
    assert publish_window(cand2, cand1, "2025-03-05", "2025-03-06").count() == 3
    assert reprocess_window("2025-03-05", 3) == (d(2), d(6))


def test_key_counts(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("a", "2")], "src string, id string")
    r = agg.key_counts(df, "id", "src").first()
    assert (r["rows"], r["distinct_ids"], r["distinct_keys"], r["shared_ids"]) == (4, 2, 3, 1)


def test_file_inventory_and_footprint(spark, workdir):
    import os
    from strata.sources.files import file_inventory, footprint
    for i, size in enumerate((10, 20)):
        with open(os.path.join(workdir, f"f{i}.bin"), "wb") as f:
            f.write(b"x" * size)
    inv = {r["file_name"]: r["length"] for r in file_inventory(spark, workdir).collect()}
    assert inv == {"f0.bin": 10, "f1.bin": 20}
    fp = footprint(spark, workdir).first()
    assert (fp["files"], fp["bytes"]) == (2, 30)


def test_version_chain_splits_hot_key(spark):
    from strata.operators.staging import version_chain
    rows = [("hot", i, i * 10) for i in range(600)] + [("a", 2, 5), ("a", 1, 7), ("b", 1, 1)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    out = version_chain(df, ["k"], ["t"], "t", partitions=6).collect()
    got = sorted((r["k"], r["version_no"], r["t"], r["prev_t"], r["n_versions"]) for r in out)
    want = []
    for k in ("a", "hot"):
        ts = sorted(t for kk, t, _v in rows if kk == k)
        want += [(k, i + 1, t, ts[i - 1] if i else None, len(ts)) for i, t in enumerate(ts)]
    assert got == sorted(want)                     # 'b' has one version only


def test_scd2_join_day_buckets_match_plain_join(spark):
    from strata.operators.joins import scd2_join
    base = dt.datetime(2025, 3, 1)
    # a dense history: a new version every 5 hours, plus one overlapping version
    versions = [("s", "hot", f"v{i}", base + dt.timedelta(hours=5 * i), base + dt.timedelta(hours=5 * (i + 1)))
                for i in range(40)]
    versions += [("s", "hot", "long", base + dt.timedelta(days=2), dt.datetime(9999, 12, 31)),
                 ("s", "cold", "c0", dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31))]
    dim = spark.createDataFrame(versions, "d_src string, d_net string, key string, valid_from timestamp, valid_to timestamp")
    events = [("s", "hot", i, base + dt.timedelta(minutes=37 * i)) for i in range(300)]
    events += [("s", "cold", 1000, base), ("s", "none", 1001, base)]
    fact = spark.createDataFrame(events, "src string, net string, id int, ts timestamp")
    keys = [("src", "d_src"), ("net", "d_net")]
    plain = sorted(tuple(r) for r in scd2_join(fact, dim, keys, "ts").select("id", "key").collect())
    by_day = sorted(tuple(r) for r in scd2_join(fact, dim, keys, "ts", days=("2025-03-01", "2025-03-15"))
                    .select("id", "key").collect())
    assert plain == by_day and len(plain) > 302


def test_band_join_from_a_seed_table(spark):
    seed = spark.createDataFrame([(1, Decimal("-10"), Decimal("2")), (2, Decimal("2"), Decimal("4"))],
                                 "class_key int, mag_min decimal(18,6), mag_max decimal(18,6)")
    df = spark.createDataFrame([(Decimal("1.9"),), (Decimal("2"),), (Decimal("4"),)], "m decimal(18,6)")
    assert [r["class_key"] for r in band_join(df, "m", seed).orderBy("m").collect()] == [1, 2, None]


def test_latest_version_with_a_hot_key_of_copies(spark):
    # one key holds a third of all rows (identical copies plus one newer version)
    hot = [("hot", dt.datetime(2025, 1, 1), i % 3) for i in range(3000)] + [("hot", dt.datetime(2025, 1, 2), 9)]
    cold = [(f"k{i}", dt.datetime(2025, 1, 1), 0) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "key string, upd timestamp, v int").repartition(8)
    out = latest_version(df, ["key"], ["upd"])
    rows = {r["key"]: r["v"] for r in out.collect()}
    assert len(rows) == 6001 and rows["hot"] == 9


def test_publish_empty_window_first(spark, workdir):
    d = lambda x: dt.date(2025, 3, x)
    cand = spark.createDataFrame([(d(5), 1)], "event_date date, v int")
    pub = Publisher(spark, workdir + "/pub")
    assert pub.publish(cand, "2025-03-01", "2025-03-03", "empty")["rows_published"] == 0
    assert pub.publish(cand, "2025-03-01", "2025-03-06", "full")["rows_published"] == 1
    assert [(r["event_date"], r["v"]) for r in pub.live().collect()] == [(d(5), 1)]


def test_unreadable_log_raises_and_keeps_published_days(spark, workdir):
    import datetime as dt
    import os

    from strata.operators.publish import Publisher
    pub = Publisher(spark, workdir + "/p")
    assert pub.last_publication("none").count() == 0
    rows = spark.createDataFrame([(dt.date(2024, 5, d), "a") for d in (3, 4)], "event_date date, v string")
    pub.publish(rows, "2024-05-03", "2024-05-05", "r1")
    with open(os.path.join(pub.log_path, "part-bad.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        pub.publish(rows, "2024-05-09", "2024-05-10", "r2")
    os.remove(os.path.join(pub.log_path, "part-bad.parquet"))
    assert sorted(r["event_date"].day for r in pub.live().collect()) == [3, 4]


def test_failed_run_leaves_its_version_number_unused(spark, workdir):
    import datetime as dt
    import os

    from strata.operators.publish import Publisher
    pub = Publisher(spark, workdir + "/p")
    os.makedirs(workdir + "/p/data/publish_version=1")      # left behind by a run that died before its log row
    rows = spark.createDataFrame([(dt.date(2024, 5, 3), "a")], "event_date date, v string")
    assert pub.publish(rows, "2024-05-03", "2024-05-04", "r1")["version"] == 2
    assert pub.live().count() == 1


def test_version_chain_with_null_keys_and_null_order_values(spark):
    from strata.operators.staging import version_chain
    rows = [("k", i // 2, None if i % 2 else i, i) for i in range(60)] + [(None, i, i, 100 + i) for i in range(2)]
    df = spark.createDataFrame(rows, "key string, a int, b int, id int").repartition(5)
    expect = {}
    for key in ("k", None):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2] is None, r[2] or 0))
        for n, r in enumerate(mine):
            expect[r[3]] = (n + 1, len(mine), mine[n - 1][2] if n else None)
    for partitions in (1, 4, 7):
        got = version_chain(df, ["key"], ["a", "b"], "b", partitions=partitions).collect()
        assert {r["id"]: (r["version_no"], r["n_versions"], r["prev_b"]) for r in got} == expect


def test_checksum_tells_separators_and_nulls_apart(spark):
    from strata.operators.aggregates import table_checksum
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("\\N", "x"), ("N", "x"), ("", "x"), ("1:N", ""), ("N", "1:")]
    sums = {table_checksum(spark.createDataFrame([r], "a string, b string")).first()["checksum"] for r in rows}
    assert len(sums) == len(rows)


def test_share_keeps_null_partition(spark):
    from strata.operators.aggregates import share_of_total
    df = spark.createDataFrame([(None, "x", 3), ("d", "x", 1), ("d", "y", 3)], "event_date string, net string, events long")
    assert sorted((str(r[0]), r[1], float(r[3])) for r in share_of_total(df).collect()) == [
        ("None", "x", 100.0), ("d", "x", 25.0), ("d", "y", 75.0)]


def test_bands_many_overlapping_and_text_keys(spark):
    from strata.operators.joins import band_join
    values = [-1, 0, 5, 9.99, 10, 500, 999.5, 1500.25, 1501, None]
    df = spark.createDataFrame([(None if v is None else str(v),) for v in values], "s string").selectExpr(
        "CAST(s AS DECIMAL(18,6)) AS v")
    many = [(i, i, i + 1) for i in range(1501)]
    overlapping = [("low", 0, 10), ("all", -5, 2000), ("edge", 10, 500)]
    for bands in (many, overlapping, [("a", 0, 10), ("b", 10, 20)]):
        for given in (bands, spark.createDataFrame([(k, float(a), float(b)) for k, a, b in bands], "k string, lo double, hi double")
                      if isinstance(bands[0][0], str) else spark.createDataFrame(bands, "k int, lo int, hi int")):
            got = band_join(df, "v", given, "k")
            assert got.schema["k"].dataType.simpleString() == ("string" if isinstance(bands[0][0], str) else "int")
            expect = []
            for v in values:
                hit = [k for k, a, b in bands if v is not None and a <= v < b] or [None]
                expect += [(None if v is None else float(v), k) for k in hit]
            assert sorted(((None if r["v"] is None else float(r["v"]), r["k"]) for r in got.collect()), key=str) == \
                sorted(expect, key=str)


def test_scd2_by_day_equals_plain_outside_the_days_too(spark):
    from strata.operators.joins import scd2_join
    fact = spark.sql("SELECT 'a' AS k, TIMESTAMP '2024-05-01 10:00:00' AS ts UNION ALL "
                     "SELECT 'a', TIMESTAMP '2024-05-20 10:00:00' UNION ALL SELECT 'z', TIMESTAMP '2024-05-01 00:00:00' "
                     "UNION ALL SELECT 'a', NULL")
    dim = spark.sql("SELECT 'a' AS dk, 1 AS v, TIMESTAMP '2024-01-01 00:00:00' AS valid_from, "
                    "TIMESTAMP '2024-05-10 00:00:00' AS valid_to UNION ALL "
                    "SELECT 'a', 2, TIMESTAMP '2024-05-10 00:00:00', TIMESTAMP '9999-12-31 00:00:00'")
    rows = lambda df: sorted(map(str, df.select("k", "ts", "v").collect()))
    assert rows(scd2_join(fact, dim, [("k", "dk")], "ts", days=("2024-05-01", "2024-05-03"))) == \
        rows(scd2_join(fact, dim, [("k", "dk")], "ts"))
