"""Merge join, overlap sweep, histories from changes and comparison by digests,
against the plain forms."""

import datetime as dt
import random

import pytest

from strata.operators import joins
from strata.operators.aggregates import share_of_total
from strata.operators.compare import changed_parts, labelled_diff, labelled_diff_by_part
from strata.operators.dims import history_from_changes
from strata.operators.joins import find_overlaps, scd2_join, scd2_merge_join
from strata.operators.ordered import by_range, running

BASE = dt.datetime(2025, 3, 1)
at = lambda m: None if m is None else BASE + dt.timedelta(minutes=m)
rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))

DIM = "d_src string, d_net string, key string, valid_from timestamp, valid_to timestamp"
FACT = "src string, net string, id int, ts timestamp"
KEYS = [("src", "d_src"), ("net", "d_net")]


def history(r, overlap):
    dim, fact = [], []
    for k, n in (("hot", 300), ("warm", 30), ("cold", 1), (None, 3)):
        cuts = sorted(r.sample(range(2000), n + 1))
        dim += [("s", k, f"{k}{i}", at(a), at(b if r.random() < 0.8 else (a + b) // 2))
                for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    dim += [("s", "warm", "empty", at(500), at(500)), ("s", "warm", "turned", at(700), at(600)),
            ("s", "warm", "nostart", None, at(900)), (None, "warm", "nosrc", at(0), at(2000))]
    if overlap:
        dim += [("s", "warm", "long", at(400), at(1500)), ("s", "cold", "twin", *dim[330][3:])]
    nets = ["hot"] * 8 + ["warm", "cold", "none", None]
    fact = [(r.choice(["s", "s", "s", "t", None]), r.choice(nets), i, at(r.choice([None, *range(-5, 2005)])))
            for i in range(900)]
    return dim, fact + [("s", "hot", -1, d[3]) for d in dim if d[1] == "hot"]


@pytest.mark.parametrize("overlap", [False, True])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_merge_join_equals_plain_join(spark, how, overlap):
    dim, fact = history(random.Random(5), overlap)
    d, f = spark.createDataFrame(dim, DIM).repartition(3), spark.createDataFrame(fact, FACT).repartition(3)
    plain = scd2_join(f, d, KEYS, "ts", how=how)
    got = scd2_merge_join(f, d, KEYS, "ts", how=how)
    assert got.columns == plain.columns and rows(got) == rows(plain)
    if not overlap:
        assert rows(scd2_merge_join(f, d, KEYS, "ts", how=how, disjoint=True)) == rows(plain)
    else:
        assert got.count() > (0 if how == "inner" else len(fact))


def test_merge_join_empty_sides(spark):
    dim, fact = history(random.Random(6), False)
    d, f = spark.createDataFrame(dim, DIM), spark.createDataFrame(fact, FACT)
    none_d, none_f = d.limit(0), f.limit(0)
    assert scd2_merge_join(none_f, d, KEYS, "ts").count() == 0
    got = scd2_merge_join(f, none_d, KEYS, "ts")
    assert got.count() == len(fact) and got.filter("key IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        scd2_merge_join(f, d, KEYS, "ts", how="full")


def test_running_carries_over_pieces(spark):
    r = random.Random(7)
    data = [("hot" if i % 3 else f"k{i % 11}", i, r.choice([None, 1, 2, 5])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, o int, v long")
    for how, before in (("sum", False), ("sum", True), ("last", False), ("last", True)):
        pieces = by_range(df, ["k"], ["o"], 16)
        assert pieces.filter("k = 'hot'").select("_pid").distinct().count() > 3
        got = {(x.k, x.o): x.out for x in running(pieces, ["k"], ["o"], pieces.v, how, "out", before).collect()}
        for k, o, _ in data:
            seen = [v for kk, oo, v in data if kk == k and (oo < o if before else oo <= o) and v is not None]
            assert got[k, o] == (sum(seen) if how == "sum" else seen[-1] if seen else None)


@pytest.mark.parametrize("short", [0, 64])
def test_overlaps_equal_all_pairs(spark, monkeypatch, short):
    monkeypatch.setattr(joins, "SHORT_HISTORY", short)
    monkeypatch.setattr(joins, "SWEEP_RUN", 7)
    r = random.Random(8)
    dim = []
    for k, n in (("hot", 150), ("few", 6)):
        for i in range(n):
            a = r.randrange(600)
            dim.append(("s", k, f"v{i % (n - 3):03d}", at(a), at(a + r.choice([-3, 0, 1, 5, 40]))))
    dim += [("s", "hot", "all", at(-1), at(700)), ("s", None, "x", at(1), at(9)), ("s", None, "y", at(1), at(9)),
            ("s", "hot", None, at(1), at(9)), ("s", "hot", "z", at(5), None), dim[0], dim[0]]
    df = spark.createDataFrame(dim, "src string, net string, key string, valid_from timestamp, valid_to timestamp")
    want = [(a[0], a[1], a[2], b[2], a[3], a[4], b[3], b[4]) for a in dim for b in dim
            if None not in a and None not in b and a[:2] == b[:2] and a[2] < b[2] and a[3] < b[4] and b[3] < a[4]]
    got = find_overlaps(df.repartition(3), ["src", "net"], "key")
    assert rows(got) == sorted(map(str, want)) and len(want) > 200


def test_long_history_without_overlaps_makes_no_pairs(spark):
    df = spark.range(20000).selectExpr("'k' AS k", "id AS key", "id AS valid_from", "id + 1 AS valid_to")
    df = df.union(spark.sql("SELECT 'k', -1L, 500L, 503L"))
    got = find_overlaps(df, ["k"], "key")
    assert sorted((x.version_a, x.version_b) for x in got.collect()) == [(-1, 500), (-1, 501), (-1, 502)]


def test_history_from_changes(spark):
    data = [("a", at(3), 1), ("a", at(1), 2), ("b", at(2), 3), (None, at(1), 4), ("a", None, 5), ("a", at(9), 6)]
    df = spark.createDataFrame(data, "k string, ts timestamp, n int")
    got = {x.n: (x.valid_from, x.valid_to) for x in history_from_changes(df, ["k"], "ts").collect()}
    end = dt.datetime(9999, 12, 31)
    assert got == {2: (at(1), at(3)), 1: (at(3), at(9)), 6: (at(9), end), 3: (at(2), end)}


def test_diff_by_part_equals_diff_and_reads_changed_days(spark, workdir):
    r = random.Random(9)
    days = [dt.date(2025, 3, 1 + i) for i in range(10)] + [None]
    data = [(d, r.randrange(50), "x") for d in days for _ in range(60)]
    other = [x for x in data if not (x[0] == days[4] and x[1] < 10)] + [(days[4], 99, "new"), (days[4], 99, "new")]
    a, b = (spark.createDataFrame(x, "day date, v int, s string") for x in (data, other))
    assert rows(labelled_diff_by_part(a, b, "day")) == rows(labelled_diff(a, b)) != []
    for n, df in (("a", a), ("b", b)):
        df.write.partitionBy("day").parquet(f"{workdir}/{n}")
    pa, pb = (spark.read.parquet(f"{workdir}/{n}") for n in "ab")
    assert [x.day for x in changed_parts(pa, pb, "day").select("day").distinct().collect()] == [days[4]]
    got = labelled_diff_by_part(pa, pb, "day")
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [") == 2 and text.count("(day#") >= 2 and "2025-03-05" in text
    assert rows(got) == rows(labelled_diff(a, b))
    assert labelled_diff_by_part(a, a, "day").count() == 0
    nulls = b.filter("day IS NULL").limit(3)
    assert rows(labelled_diff_by_part(a, a.union(nulls), "day")) == rows(labelled_diff(a, a.union(nulls)))


def test_share_has_no_window(spark):
    df = spark.createDataFrame([("d", "x", 1), ("d", "y", 3)], "event_date string, net string, events long")
    text = share_of_total(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text


def test_incremental_build_reads_window_days(spark):
    from strata.plans.queries_elt import _reprocess_bounds, incremental_layers
    s, e = _reprocess_bounds()
    layers = incremental_layers(spark, "/root/testdata/sf0.001", s, e)
    text = layers.versions._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters: ["):].split("]")[0]
    assert "event_date" in filters
    days = {x[0].isoformat() for x in layers.versions.select("event_date").distinct().collect()}
    assert days and all(s <= d < e for d in days)
