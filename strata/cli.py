"""Command line for the two end-to-end runs and the consumer reports.

    python -m strata elt --data DIR --root OUT [--start D --end D --cases a,b --run-id R]
    python -m strata report --root OUT
    python -m strata pageviews --dumps GLOB --root OUT [--lookup namespace=group,...]

``elt`` loads ``DIR/slice`` plus ``DIR/tests/<case>`` slices, builds the
candidate layers, runs the 32 tests (failing rows stored under
``OUT/dbt_test_audit``) and publishes the window to ``OUT/mart/daily`` only
if every test passes. ``report`` prints the consumer queries over the
published mart. ``pageviews`` runs the page-view plan.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def _session():
    from strata.session import build_session
    return build_session(os.environ.get("STRATA_MASTER", "local[*]"),
                         int(os.environ.get("STRATA_SHUFFLE_PARTITIONS", "8")))


def cmd_elt(args) -> int:
    from strata.operators.dims import MAGNITUDE_CLASSES, stage_network_history
    from strata.operators.staging import type_raw_events
    from strata.plans.elt import run_elt
    from strata.sources.raw import load_raw
    for d in (args.start, args.end):
        if not DATE.match(d):
            raise SystemExit(f"bad date {d!r}: expected YYYY-MM-DD")
    cases = [c.strip() for c in args.cases.split(",") if c.strip()]
    slices = [("baseline", os.path.join(args.data, "slice"))]
    slices += [(c, os.path.join(args.data, "tests", c)) for c in cases]
    spark = _session()
    raw_ev, raw_hist = load_raw(spark, slices)
    res = run_elt(spark, type_raw_events(raw_ev), stage_network_history(raw_hist), args.start, args.end,
                  root=args.root, run_id=args.run_id, classes=MAGNITUDE_CLASSES, fact_types=("earthquake",))
    for name, failures in res["tests"].items():
        print(f"{'PASS' if not failures else 'FAIL'} {name} {failures}")
    print(f"PASS={sum(1 for v in res['tests'].values() if not v)} ERROR={len(res['failing'])}")
    if res["published"]:
        p = res["published"]
        print(f"published run_id={p['run_id']} window=[{p['start_date']},{p['end_date']}) "
              f"rows={p['rows_published']} checksum={p['checksum']} version={p['version']}")
        return 0
    print("not published: the gate failed; the previous publication is unchanged")
    return 1


def cmd_report(args) -> int:
    from pyspark.sql import functions as F
    from strata.operators import aggregates as agg
    from strata.operators.publish import Publisher
    spark = _session()
    mart = Publisher(spark, os.path.join(args.root, "mart", "daily")).live()
    if mart is None:
        print("nothing published yet")
        return 1
    _print(agg.events_by_day_class(mart).orderBy("event_date", "magnitude_class"))
    share = agg.share_of_total(mart)
    _print(agg.top_n_per_group(share, "event_date", [F.desc("events"), F.asc_nulls_last("net")], args.top)
           .orderBy("event_date", F.desc("events"), "net"))
    _print(agg.weighted_daily(mart).orderBy("event_date"))
    return 0


def cmd_pageviews(args) -> int:
    from strata.plans import pageviews as pv
    spark = _session()
    csv = os.path.join(args.root, "staging_csv")
    pv.stage_dumps(spark, args.dumps, csv)
    hours = [int(h) for h in args.hours.split(",")] if args.hours else None
    accepted, profile = pv.validate(pv.typed_pages(spark, csv), pv.page_rules(hours))
    print(profile)
    pages = pv.load_partitioned(spark, accepted, os.path.join(args.root, "parquet"), profile["outcomes"]["accepted"])
    live = pv.load_hours(pages, os.path.join(args.root, "table"))
    _print(pv.namespace_totals(live))
    _print(pv.top_pages(live))
    if args.lookup:
        pairs = [p.split("=", 1) for p in args.lookup.split(",") if "=" in p]
        lookup = spark.createDataFrame(pairs, "namespace string, content_group string")
        _print(pv.content_groups(live, lookup))
        _print(pv.lookup_audit(live, lookup))
    return 0


def _print(df) -> None:
    """All rows of a report, fetched a partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("elt")
    e.add_argument("--data", required=True)
    e.add_argument("--root", required=True)
    e.add_argument("--start", required=True)
    e.add_argument("--end", required=True)
    e.add_argument("--cases", default="")
    e.add_argument("--run-id", default="manual")
    r = sub.add_parser("report")
    r.add_argument("--root", required=True)
    r.add_argument("--top", type=int, default=3)
    p = sub.add_parser("pageviews")
    p.add_argument("--dumps", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--lookup", default="")
    p.add_argument("--hours", default="", help="accepted hours, comma-separated; all by default")
    args = ap.parse_args(argv)
    return {"elt": cmd_elt, "report": cmd_report, "pageviews": cmd_pageviews}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
