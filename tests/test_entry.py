"""Driver contract: entry(), queries(), oracle_sql(); a subset of queries is
compared with DuckDB here (all of them with STRATA_FULL_ORACLE=1)."""

import os

import pytest

from oracle_check import compare

SMOKE = "/root/testdata/sf0.001"
SUBSET = ["daily_mart", "class_totals", "lookup_agg", "join_audit", "latest_version", "mart_share",
          "mart_top3", "control_check", "typed_events", "network_dim", "calendar_dim"]


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "avg_magnitude" in df.columns


def test_every_oracle_has_a_query():
    from __spark_entry__ import oracle_sql, queries
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40
    from strata.plans import registry
    assert set(registry.all_queries()) == set(registry.all_oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_bounds_follow_the_data(spark, workdir):
    """``events`` with a copy 40 days later: every query covers both months."""
    from pyspark.sql import functions as F
    for name in os.listdir(SMOKE):
        if name.endswith(".parquet") and name != "events.parquet":
            os.symlink(os.path.join(SMOKE, name), os.path.join(workdir, name))
    ev = spark.read.parquet(SMOKE + "/events.parquet")
    later = ev.withColumn("ts", F.col("ts") + F.expr("INTERVAL 40 DAYS")).withColumn("event_id", F.col("event_id") + 10**10)
    ev.unionByName(later).coalesce(1).write.parquet(workdir + "/both")
    part = [f for f in os.listdir(workdir + "/both") if f.endswith(".parquet")][0]
    os.symlink(os.path.join(workdir, "both", part), os.path.join(workdir, "events.parquet"))
    res = compare(spark, workdir, ["typed_events", "daily_mart", "partitioned_roundtrip", "sliced_load"], verbose=False)
    assert all(v[0] == "OK" for v in res.values()), res


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_oracle_subset(spark):
    names = None if os.environ.get("STRATA_FULL_ORACLE") else SUBSET
    res = compare(spark, SMOKE, names, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO-ORACLE")}
    assert not bad, bad
