"""The whole run: build the candidate, test it, publish it only if every
test passes (load -> build -> test -> publish)."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import aggregates as agg
from strata.operators import quality as dq
from strata.operators.joins import find_overlaps, one_row, reconcile, scd2_join
from strata.operators.publish import Publisher
from strata.plans.quakes import Layers, build_layers

# Accepted values and range bounds of the reference tests.
QUAKE_STATUSES = ("reviewed", "automatic")
QUAKE_TYPES = ("earthquake", "mining explosion")
QUAKE_MAG_RANGE = (-2, 10)
QUAKE_DEPTH_RANGE = (-10, 800)


def test_tables(layers: Layers, fact_types: Sequence[str]) -> dict[str, DataFrame]:
    return {
        "versions": layers.versions, "latest": layers.latest, "network_history": layers.network_history,
        "dim_network": layers.dim_network, "dim_class": layers.dim_class, "dim_date": layers.dim_date,
        "fact": layers.fact, "mart": layers.mart,
        "_fact_types": list(fact_types),
    }


def _fact_vs_staging(t):
    s = t["latest"].filter(F.col("event_type").isin(t["_fact_types"])).agg(F.count(F.lit(1)).alias("stg_rows"))
    f = t["fact"].agg(F.count(F.lit(1)).alias("fact_rows"))
    return one_row(s, f).filter(F.col("stg_rows") != F.col("fact_rows"))


def _class_matches(t):
    f, c = t["fact"], t["dim_class"]
    j = f.join(c, f["mag_class_key"] == c["class_key"], "inner")
    return j.filter((F.col("magnitude") < F.col("mag_min")) | (F.col("magnitude") >= F.col("mag_max"))) \
        .select("event_key", "event_id", "magnitude", "class_name", "mag_min", "mag_max")


def _out_of_range(mag, depth) -> str:
    return " OR ".join(f"{c} IS NULL OR {c} NOT BETWEEN {lo} AND {hi}"
                       for c, (lo, hi) in (("magnitude", mag), ("depth_km", depth)))


def _mart_grain(t):
    return agg.duplicate_keys(t["mart"], ["event_date", "class_key", "source_system", "net", "network_name"])


def _mart_reconciles(t):
    f = t["fact"].groupBy("event_date").agg(F.count(F.lit(1)).alias("fact_events"))
    m = t["mart"].groupBy("event_date").agg(F.sum("events").cast("long").alias("mart_events"))
    return reconcile(f, m, "event_date", "fact_events", "mart_events")


def _no_overlap(t):
    return find_overlaps(t["dim_network"], ["source_system", "net"], "network_key")


def _one_version(t):
    ev = t["latest"].filter(F.col("event_type").isin(t["_fact_types"]))
    dim = t["dim_network"].select(F.col("network_key"), F.col("source_system").alias("_d_src"),
                                  F.col("net").alias("_d_net"), F.col("valid_from").alias("_d_from"),
                                  F.col("valid_to").alias("_d_to"))
    j = scd2_join(ev, dim, [("source_system", "_d_src"), ("net", "_d_net")], "event_ts",
                  valid_from="_d_from", valid_to="_d_to", how="inner")
    return (j.groupBy("event_key", "event_id", "source_system", "net")
            .agg(F.count(F.lit(1)).alias("matching_versions"))
            .filter(F.col("matching_versions") > 1))


def elt_tests(statuses=QUAKE_STATUSES, event_types=QUAKE_TYPES,
              mag_range=QUAKE_MAG_RANGE, depth_range=QUAKE_DEPTH_RANGE) -> list[dq.DataTest]:
    """The 32 tests of the reference gate: 25 generic + 7 singular."""
    return [
        dq.not_null("versions", "event_id"),
        dq.not_null("versions", "event_ts"),
        dq.not_null("latest", "event_key"),
        dq.unique("latest", "event_key"),
        dq.accepted_values("latest", "status", statuses),
        dq.accepted_values("latest", "event_type", event_types),
        dq.not_null("network_history", "net"),
        dq.not_null("dim_network", "network_key"),
        dq.unique("dim_network", "network_key"),
        dq.not_null("dim_class", "class_key"),
        dq.unique("dim_class", "class_key"),
        dq.not_null("dim_date", "date_key"),
        dq.unique("dim_date", "date_key"),
        dq.not_null("fact", "event_key"),
        dq.unique("fact", "event_key"),
        dq.not_null("fact", "network_key"),
        dq.relationships("fact", "network_key", "dim_network", "network_key"),
        dq.not_null("fact", "mag_class_key"),
        dq.relationships("fact", "mag_class_key", "dim_class", "class_key"),
        dq.not_null("fact", "event_date"),
        dq.relationships("fact", "event_date", "dim_date", "date_key"),
        dq.not_null("mart", "event_date"),
        dq.not_null("mart", "class_key"),
        dq.not_null("mart", "net"),
        dq.not_null("mart", "events"),
        dq.singular("fact_matches_stg_count", _fact_vs_staging, reads=("latest", "fact")),
        dq.singular("mag_class_matches_magnitude", _class_matches, reads=("fact", "dim_class")),
        dq.rows_where("magnitude_and_depth_in_range", "fact", _out_of_range(mag_range, depth_range),
                      ("event_key", "event_id", "magnitude", "depth_km")),
        dq.singular("mart_grain_unique", _mart_grain, reads=("mart",)),
        dq.singular("mart_reconciles_with_fact", _mart_reconciles, reads=("fact", "mart")),
        dq.singular("network_history_no_overlap", _no_overlap, reads=("dim_network",)),
        dq.singular("one_network_version_per_event", _one_version, reads=("latest", "dim_network")),
    ]


LAYER_DIRS = {"versions": "stg", "latest": "stg", "network_history": "stg", "dim_network": "dds",
              "dim_class": "dds", "dim_date": "dds", "fact": "dds", "mart": "mart_candidate"}


def layer_writer(spark: SparkSession, root: str, tests=(), seen: dict | None = None):
    """``keep`` callback for ``build_layers``: write the layer as Parquet under
    ``root/<layer dir>/<table>`` and continue from the written table. Each
    layer is computed once from its written parents, lineage is cut (a lost
    executor re-reads files instead of recomputing the chain) and the tests
    scan compact columnar tables. The failures of single-row ``tests`` are
    counted by the write itself and put into ``seen``."""
    def keep(name: str, df: DataFrame) -> DataFrame:
        path = f"{root.rstrip('/')}/{LAYER_DIRS[name]}/{name}"
        watched, failures = dq.watch(df, tests, name)
        watched.write.mode("overwrite").parquet(path)
        if seen is not None:
            seen.update(failures())
        return spark.read.parquet(path)
    return keep


def run_elt(spark: SparkSession, typed_events: DataFrame, history: DataFrame, start, end,
            root: str, run_id: str, classes, fact_types, tests=None, publish: bool = True,
            rank_first: bool = False, dense_history: bool = False) -> dict:
    """Build -> materialise -> test (store failures) -> gate -> publish.

    Tests of the layers before the fact run beside the writes of the fact and
    the mart, on cores those leave idle; the others once all is written.

    The result carries ``seconds`` per phase (build, tests, publish)."""
    import time
    t0 = time.perf_counter()
    tests = tests if tests is not None else elt_tests()
    seen: dict[str, int] = {}
    write, written, begun = layer_writer(spark, root, tests, seen), {"_fact_types": list(fact_types)}, []
    with ThreadPoolExecutor(max_workers=1) as pool:
        def keep(name: str, df: DataFrame) -> DataFrame:
            if name == "fact":      # every layer before it is written
                early = [x for x in tests if x.name not in seen and x.ready(written)]
                begun.append(pool.submit(dq.summary_rows, early, dict(written), 2))
            written[name] = write(name, df)
            return written[name]

        layers = build_layers(spark, typed_events, history, start, end, classes=classes,
                              fact_types=fact_types, keep=keep, rank_first=rank_first,
                              dense_history=dense_history, parallel=True)
        t1 = time.perf_counter()
        seen.update({r["test_name"]: r["failures"] for x in begun for r in x.result()})
    t = test_tables(layers, fact_types)
    results = {r["test_name"]: r["failures"] for r in dq.summary_rows(tests, t, known=seen)}
    failing = [k for k, v in results.items() if v]
    audit = dq.store_failures(spark, tests, t, f"{root.rstrip('/')}/dbt_test_audit", failing)
    t2 = time.perf_counter()
    out = {"layers": layers, "tests": results, "failing": failing, "audit": audit, "published": None,
           "seconds": {"build": t1 - t0, "tests": t2 - t1, "publish": 0.0}}
    if failing or not publish:
        return out
    out["published"] = Publisher(spark, f"{root.rstrip('/')}/mart/daily").publish(layers.mart, start, end, run_id)
    out["seconds"]["publish"] = time.perf_counter() - t2
    return out
