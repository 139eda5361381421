"""Physical-plan assertions: pushdown, pruning, join strategies, partial
aggregation and the absence of pairwise joins."""

import os

import pytest

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_filter_reaches_scan(spark):
    from strata.plans.queries import events_layers
    text = events_layers(spark, SF).versions._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text


def test_mart_has_no_pairwise_join(spark):
    from strata.plans.queries import events_layers
    text = plan(events_layers(spark, SF).mart)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    assert "WindowGroupLimit" in text              # latest version reduced before the shuffle


def test_page_rows_aggregate_before_join_and_prune_columns(spark):
    from strata.plans.queries import page_namespaces
    df = page_namespaces(spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert opt.index("Join") < opt.index("Aggregate")   # aggregate sits below the join


def test_literal_lookup_is_broadcast(spark):
    from strata.plans.queries import QUERIES
    text = plan(QUERIES["lookup_agg"](spark, SF))
    assert "BroadcastHashJoin" in text


def test_share_plans_the_mart_once(spark):
    """Totals are a window over the reduced rows, not a second copy of the chain."""
    from strata.plans.registry import all_queries
    text = all_queries()["mart_share"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("WindowGroupLimit") <= 1 and text.count("Window [") <= 2


def test_live_read_is_pruned_to_live_days(spark, workdir):
    import datetime as dt

    from strata.operators.publish import Publisher
    pub = Publisher(spark, workdir + "/pub")
    rows = lambda v: spark.createDataFrame([(dt.date(2024, 5, d), v) for d in (1, 2, 3)], "event_date date, v string")
    for v, (s, e) in enumerate((("2024-05-01", "2024-05-04"), ("2024-05-02", "2024-05-03"))):
        pub.publish(rows(f"v{v}"), s, e, f"r{v}")
    live = pub.live()
    assert sorted((r["event_date"].day, r["v"]) for r in live.collect()) == [(1, "v0"), (2, "v1"), (3, "v0")]
    text = live._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters: ["):]
    assert "publish_version" in filters and "event_date" in filters


def test_no_registered_query_plans_a_pairwise_join(spark):
    """No cartesian product and no nested-loop join in any registered query
    (band tables are non-overlapping, so bands are a CASE expression)."""
    from strata.plans.registry import all_queries
    smoke = "/root/testdata/sf0.001"
    offenders = {}
    for name, fn in sorted(all_queries().items()):
        text = fn(spark, smoke)._jdf.queryExecution().executedPlan().toString()
        bad = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in text]
        if bad:
            offenders[name] = bad
    assert not offenders, offenders
