"""Streaming late corrections reproduce the batch late-correction golden."""

import datetime as dt
import os
from decimal import Decimal

import quake_fixtures as qf
from strata.operators.dims import MAGNITUDE_CLASSES, stage_network_history
from strata.operators.staging import type_raw_events
from strata.sources.raw import load_raw
from strata.streaming.corrections import CorrectionStream, day_runs


def test_day_runs():
    d = lambda x: dt.date(2025, 3, x)
    assert day_runs([d(5), d(3), d(4), d(9)]) == [(d(3), d(6)), (d(9), d(10))]


def test_stream_republishes_corrected_day(spark, workdir):
    raw_ev, raw_hist = load_raw(spark, qf.slices(workdir + "/data"))
    cs = CorrectionStream(spark, workdir + "/versions", workdir + "/pub",
                          stage_network_history(raw_hist), MAGNITUDE_CLASSES, ("earthquake",), "feed")
    cs.seed(type_raw_events(raw_ev))
    inbox = os.path.join(workdir, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "late.csv"), "w", encoding="utf-8") as f:
        f.write("\n".join([qf.HEADER, *qf.LATE_ROWS]) + "\n")
    q = cs.start(inbox, workdir + "/chk")
    q.awaitTermination()
    live = cs.publisher.live().collect()
    assert [(r["magnitude_class"], r["events"], r["avg_magnitude"], r["avg_depth_km"]) for r in live] == [
        ("light", 3, Decimal("4.300"), Decimal("21.19"))]


def _stream(spark, workdir, rows):
    raw_ev, raw_hist = load_raw(spark, qf.slices(workdir + "/data", baseline_events=rows))
    cs = CorrectionStream(spark, workdir + "/versions", workdir + "/pub",
                          stage_network_history(raw_hist), MAGNITUDE_CLASSES, ("earthquake",), "feed")
    cs.seed(type_raw_events(raw_ev))
    cs.publish_all("2024-06-10", "2024-06-20", run_id="base")
    return cs


def test_event_moved_to_a_day_apart_counts_once_and_replay_changes_nothing(spark, workdir):
    day = lambda d, i, seen=qf.SEEN: qf.row(f"2024-06-{d}T10:00:00.000Z", "5", "3.0", "aa", i, seen, "p")
    cs = _stream(spark, workdir, [day(10, "m"), day(10, "k1"), day(12, "k2")])
    moved = type_raw_events(load_raw(spark, qf.slices(
        workdir + "/delta", baseline_events=[day(12, "m", "2024-12-01T00:00:00.000Z")]))[0])
    for _ in range(2):                      # the second delivery of the batch is a replay
        cs._process_typed(moved, 0)
        live = sorted((r["event_date"].day, r["events"]) for r in cs.publisher.live().collect())
        assert live == [(10, 1), (12, 2)]
        assert cs.publisher.log().count() == 3 and cs._store().count() == 4
    # A later correction touches only the old day of "m": its newer version elsewhere still counts.
    fixed = type_raw_events(load_raw(spark, qf.slices(
        workdir + "/delta2", baseline_events=[day(10, "k1", "2024-12-02T00:00:00.000Z")]))[0])
    cs._process_typed(fixed, 1)
    assert sorted((r["event_date"].day, r["events"]) for r in cs.publisher.live().collect()) == [(10, 1), (12, 2)]


def test_a_batch_reads_its_days_and_buckets_only(spark, workdir):
    day = lambda d, i, seen=qf.SEEN: qf.row(f"2024-06-{d}T10:00:00.000Z", "5", "3.0", "aa", i, seen, "p")
    cs = _stream(spark, workdir, [day(d, f"e{d}{k}") for d in range(10, 20) for k in range(3)])
    keys = cs._table("keys").filter("event_date = DATE '2024-06-12'").limit(1).select("event_key")
    found = cs._days_of(keys)
    assert [r.event_date.day for r in found.collect()] == [12]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan(found) or "PartitionFilters: [(bucket" in plan(found) \
        or "PartitionFilters: [bucket" in plan(found)
    rows = cs._versions_for([dt.date(2024, 6, 12)])
    assert rows.count() == 3
    scans = [x for x in plan(rows).splitlines() if "FileScan" in x]
    assert len(scans) == 1 and "event_date" in scans[0].split("PartitionFilters: [")[1].split("]")[0]
    # A key with versions on two days brings its other day's version, and nothing else from there.
    moved = type_raw_events(load_raw(spark, qf.slices(
        workdir + "/delta", baseline_events=[day(15, "e120", "2024-12-01T00:00:00.000Z")]))[0])
    cs._process_typed(moved, 0)
    assert cs._versions_for([dt.date(2024, 6, 12)]).count() == 4
    assert cs._table("moved").distinct().count() == 2
