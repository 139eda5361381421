"""Mini-goldens of the ELT track, derived by hand from three own baseline rows
(FIXTURES.md), one test per scenario."""

import datetime as dt
from decimal import Decimal

import pytest

import quake_fixtures as qf
from strata.operators.dims import MAGNITUDE_CLASSES, stage_network_history
from strata.operators.publish import Publisher
from strata.operators.staging import type_raw_events
from strata.plans.elt import run_elt
from strata.sources.raw import load_raw


def run(spark, root, cases=(), run_id="r1", wh=None, publish=True, rank_first=False, **slice_kw):
    raw_ev, raw_hist = load_raw(spark, qf.slices(root + "/data", cases, **slice_kw))
    return run_elt(spark, type_raw_events(raw_ev), stage_network_history(raw_hist), *qf.WINDOW,
                   root=wh or (root + "/wh"), run_id=run_id, classes=MAGNITUDE_CLASSES,
                   fact_types=("earthquake",), publish=publish, rank_first=rank_first)


def counts(res):
    layers = res["layers"]
    return tuple(getattr(layers, n).count() for n in ("versions", "latest", "fact"))


def mart(res):
    rows = res["layers"].mart.collect()
    return sorted((r["magnitude_class"], r["source_system"], r["network_name"], r["events"],
                   r["avg_magnitude"], r["max_magnitude"], r["avg_depth_km"]) for r in rows)


AANAME = "Alpha Array"
LIGHT = ("light", "feed", AANAME, 2, Decimal("4.350"), Decimal("4.600000"), Decimal("25.61"))
MINOR = ("minor", "feed", AANAME, 1, Decimal("3.400"), Decimal("3.400000"), Decimal("12.35"))


def test_baseline(spark, workdir):
    res = run(spark, workdir)
    assert counts(res) == (3, 3, 3)
    assert len(res["tests"]) == 32 and not res["failing"]
    assert mart(res) == [LIGHT, MINOR]          # 25.605 rounds half up to 25.61
    assert res["published"]["rows_published"] == 2
    cal = [(r["date_key"], r["iso_weekday"], r["weekday_name"]) for r in
           res["layers"].dim_date.orderBy("date_key").collect()]
    assert cal == [(dt.date(2024, 6, 10), 1, "Mon"), (dt.date(2024, 6, 11), 2, "Tue"), (dt.date(2024, 6, 12), 3, "Wed")]


def test_tests_of_written_layers_run_before_the_fact_is_built(spark, workdir):
    from strata.operators import quality as dq
    begun = []

    def look(t):
        begun.append(sorted(k for k in t if not k.startswith("_")))
        return t["latest"].filter("event_id IS NOT NULL")

    tests = [dq.singular("early", look, reads=("latest",)), dq.singular("late", lambda t: t["fact"], reads=("fact",)),
             dq.unique("latest", "event_key"), dq.not_null("latest", "event_key")]
    raw_ev, raw_hist = load_raw(spark, qf.slices(workdir + "/data", ()))
    res = run_elt(spark, type_raw_events(raw_ev), stage_network_history(raw_hist), *qf.WINDOW, root=workdir + "/wh",
                  run_id="r", classes=MAGNITUDE_CLASSES, fact_types=("earthquake",), tests=tests)
    assert begun[0] == ["dim_class", "dim_date", "dim_network", "latest", "network_history", "versions"]
    assert res["tests"] == {"early": 3, "late": 3, "unique_latest_event_key": 0, "not_null_latest_event_key": 0}
    assert list(res["tests"]) == [x.name for x in tests] and res["failing"] == ["early", "late"]


def test_dup_is_idempotent(spark, workdir):
    base = run(spark, workdir + "/a")
    res = run(spark, workdir + "/b", ["dup"])
    assert counts(res) == (6, 3, 3)
    assert not res["failing"] and mart(res) == mart(base)
    assert res["published"]["checksum"] == base["published"]["checksum"]


def test_late_correction_republishes_day(spark, workdir):
    wh = workdir + "/wh"
    run(spark, workdir + "/a", wh=wh, run_id="base")
    res = run(spark, workdir + "/b", ["late"], wh=wh, run_id="late")
    assert counts(res) == (4, 3, 3)
    assert not res["failing"]
    assert mart(res) == [("light", "feed", AANAME, 3, Decimal("4.300"), Decimal("4.600000"), Decimal("21.19"))]
    assert res["published"]["rows_published"] == 1
    live = Publisher(spark, wh + "/mart/daily").live()
    assert sorted(r["magnitude_class"] for r in live.collect()) == ["light"]  # old minor row deleted


def test_second_source(spark, workdir):
    res = run(spark, workdir, ["source_b"])
    assert counts(res) == (6, 6, 6)
    assert not res["failing"]
    sb = ("minor", "second", "Beta Bureau", 3, Decimal("3.300"), Decimal("3.500000"), Decimal("21.19"))
    assert mart(res) == sorted([LIGHT, MINOR, sb])
    ids = res["layers"].latest.select("event_id").distinct().count()
    keys = res["layers"].latest.select("event_key").distinct().count()
    assert (ids, keys) == (3, 6)


def test_corrupt_row_blocks_publication(spark, workdir):
    wh = workdir + "/wh"
    first = run(spark, workdir + "/a", wh=wh, run_id="base")
    res = run(spark, workdir + "/b", ["corrupt"], wh=wh, run_id="bad")
    assert counts(res) == (4, 4, 4)
    assert {k: v for k, v in res["tests"].items() if v} == {
        "magnitude_and_depth_in_range": 1, "not_null_fact_mag_class_key": 1, "not_null_mart_class_key": 1}
    assert res["published"] is None
    pub = Publisher(spark, wh + "/mart/daily")
    assert pub.live_version() == 1
    assert pub.log().count() == 1 and first["published"]["version"] == 1
    # failing rows are stored per test
    assert spark.read.parquet(res["audit"]["not_null_fact_mag_class_key"]).count() == 1


def test_overlap_after_window_events(spark, workdir):
    res = run(spark, workdir, ["overlap"])
    assert counts(res) == (3, 3, 3)
    assert {k: v for k, v in res["tests"].items() if v} == {"network_history_no_overlap": 1}
    assert res["published"] is None


def test_overlap_early_multiplies_fact(spark, workdir):
    res = run(spark, workdir, ["overlap_early"])
    assert counts(res) == (3, 3, 6)
    assert {k: v for k, v in res["tests"].items() if v} == {
        "network_history_no_overlap": 1, "one_network_version_per_event": 3,
        "unique_fact_event_key": 3, "fact_matches_stg_count": 1}
    names = sorted(r[2] for r in mart(res))
    assert names.count(AANAME) == 2 and names.count("Alpha Array renamed") == 2


def test_windows_compose(spark, workdir):
    """Publishing [06-10,06-11) then [06-11,06-13) equals publishing [06-10,06-13)."""
    from strata.operators.compare import compare
    raw_ev, raw_hist = load_raw(spark, qf.slices(workdir + "/data"))
    typed, hist = type_raw_events(raw_ev), stage_network_history(raw_hist)
    one = run_elt(spark, typed, hist, *qf.WINDOW, root=workdir + "/one", run_id="w",
                  classes=MAGNITUDE_CLASSES, fact_types=("earthquake",))
    two_root = workdir + "/two"
    for s, e in (("2024-06-10", "2024-06-11"), ("2024-06-11", "2024-06-13")):
        run_elt(spark, typed, hist, s, e, root=two_root, run_id=f"w{s}", classes=MAGNITUDE_CLASSES,
                fact_types=("earthquake",))
    a = Publisher(spark, workdir + "/one/mart/daily").live()
    b = Publisher(spark, two_root + "/mart/daily").live()
    assert compare(a, b).first()["identical"]
    assert one["published"]["rows_published"] == 2


EDGE_ROWS = [
    # NULL updated wins over any updated value (PostgreSQL DESC = NULLS FIRST)
    '2024-06-10T02:00:00.000Z,1,1,10,3.0,mb,,,,,aa,e_null_upd,2025-05-01T00:00:00.000Z,p,earthquake,,,,,reviewed,aa,aa',
    '2024-06-10T02:00:00.000Z,1,1,10,4.1,mb,,,,,aa,e_null_upd,,p,earthquake,,,,,reviewed,aa,aa',
    # correction moving the event out of the window
    '2024-06-11T02:00:00.000Z,1,1,10,2.5,mb,,,,,aa,e_moved,2025-05-01T00:00:00.000Z,p,earthquake,,,,,reviewed,aa,aa',
    '2024-06-20T02:00:00.000Z,1,1,10,2.5,mb,,,,,aa,e_moved,2025-06-01T00:00:00.000Z,p,earthquake,,,,,reviewed,aa,aa',
    # not an earthquake: latest yes, fact no
    '2024-06-11T03:00:00.000Z,1,1,0,1.9,ml,,,,,aa,e_mine,2025-05-01T00:00:00.000Z,p,mining explosion,,,,,reviewed,aa,aa',
    # band lower bounds are inclusive
    '2024-06-12T00:00:00.000Z,1,1,5,2,ml,,,,,aa,e_m2,2025-05-01T00:00:00.000Z,p,earthquake,,,,,reviewed,aa,aa',
    '2024-06-12T00:00:01.000Z,1,1,5,4,ml,,,,,aa,e_m4,2025-05-01T00:00:00.000Z,p,earthquake,,,,,reviewed,aa,aa',
    '2024-06-12T00:00:02.000Z,1,1,5,5,ml,,,,,aa,e_m5,2025-05-01T00:00:00.000Z,p,earthquake,,,,,,aa,aa',
]


def test_edge_rows(spark, workdir):
    res = run(spark, workdir, publish=False, baseline_events=EDGE_ROWS)
    latest = {r["event_id"]: r for r in res["layers"].latest.collect()}
    assert latest["e_null_upd"]["magnitude"] == Decimal("4.100000")       # NULL updated won
    assert latest["e_moved"]["event_date"] == dt.date(2024, 6, 11)          # old in-window version stays
    assert "e_mine" in latest
    fact = {r["event_id"]: r for r in res["layers"].fact.collect()}
    assert "e_mine" not in fact
    assert (fact["e_m2"]["mag_class_key"], fact["e_m4"]["mag_class_key"], fact["e_m5"]["mag_class_key"]) == (2, 3, 4)
    assert latest["e_m5"]["status"] is None and not res["failing"]          # NULL status passes


def test_rank_first_drops_moved_event(spark, workdir):
    res = run(spark, workdir, publish=False, rank_first=True, baseline_events=EDGE_ROWS)
    ids = {r["event_id"] for r in res["layers"].latest.collect()}
    assert "e_moved" not in ids


def test_out_of_range_and_unknown_network(spark, workdir):
    rows = [
        '2024-06-10T00:00:00.000Z,1,1,10,10.5,mw,,,,,aa,e_big,2025-05-01T00:00:00.000Z,p,earthquake,,,,,reviewed,aa,aa',
        '2024-06-10T00:00:00.000Z,1,1,10,3.0,mw,,,,,zz,e_zz,2025-05-01T00:00:00.000Z,p,earthquake,,,,,reviewed,zz,zz',
    ]
    res = run(spark, workdir, publish=False, baseline_events=rows)
    fact = {r["event_id"]: r for r in res["layers"].fact.collect()}
    assert fact["e_big"]["mag_class_key"] == 7 and fact["e_zz"]["network_key"] is None
    failing = {k: v for k, v in res["tests"].items() if v}
    assert failing["magnitude_and_depth_in_range"] == 1
    assert failing["not_null_fact_network_key"] == 1
    assert failing["not_null_mart_net"] == 1


@pytest.mark.parametrize("bad", ["not-a-number"])
def test_bad_cast_raises(spark, workdir, bad):
    rows = [f'2024-06-10T00:00:00.000Z,1,1,10,{bad},mw,,,,,aa,e_bad,2025-05-01T00:00:00.000Z,p,earthquake,,,,,reviewed,aa,aa']
    with pytest.raises(Exception):
        run(spark, workdir, publish=False, baseline_events=rows)


def test_dense_history_strategy_same_fact(spark, workdir):
    """The day-bucketed SCD2 join gives the same fact (incl. multiplied rows)."""
    from strata.plans.quakes import build_layers
    raw_ev, raw_hist = load_raw(spark, qf.slices(workdir + "/data", ["overlap_early"]))
    typed, hist = type_raw_events(raw_ev), stage_network_history(raw_hist)
    a = build_layers(spark, typed, hist, *qf.WINDOW, fact_types=("earthquake",)).fact
    b = build_layers(spark, typed, hist, *qf.WINDOW, fact_types=("earthquake",), dense_history=True).fact
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() == 6
