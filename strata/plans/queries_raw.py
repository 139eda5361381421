"""Registered queries that start from landed text: ``events`` written as CSV
slices with manifests, read back by the raw loader, typed, versioned and
traced; and the gated run from build to blocked publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dims import OPEN_END, network_dim, stage_network_history
from strata.operators.quality import read_failures, trace_to_raw
from strata.operators.staging import latest_version, stage_versions, type_raw_events
from strata.plans import feeds as fd
from strata.plans import oracle as o
from strata.plans import scenarios as sc
from strata.plans.elt import elt_tests, run_elt
from strata.plans.quakes import LATEST_ORDER
from strata.plans.queries import register
from strata.plans.queries_elt import DRIVER_TESTS, summary_sql
from strata.session import shared_dir
from strata.sources.raw import EVENT_COLUMNS, load_raw

# Update times of the slices; corrections are newer than the baseline.
SEEN = {"baseline": "2020-01-01T00:00:00.000Z", "late": "2024-03-01T00:00:00.000Z",
        "corrupt": "2020-01-01T00:00:00.000Z"}


def land(spark: SparkSession, events: DataFrame, root: str, slice_id: str, synthetic: bool) -> tuple[str, str]:
    """Write events as one slice: header CSV files of all 22 columns (columns
    without a counterpart stay empty) and a manifest."""
    named = {
        "time": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), "updated": F.lit(SEEN[slice_id]),
        "depth": F.get_json_object("props", "$.k"), "mag": F.col("value").cast("decimal(18,6)").cast("string"),
        "net": F.col("user_id").cast("string"), "id": F.col("event_id").cast("string"), "place": F.col("props"),
        "type": F.col("event_type"), "status": F.lit("reviewed"),
    }
    folder = f"{root}/{slice_id}"
    rows = events.select(*[named.get(c, F.lit(None).cast("string")).alias(c) for c in EVENT_COLUMNS])
    rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(f"{folder}/events")
    spark.createDataFrame([(fd.EVENTS_SOURCE, synthetic, "events")], "source_system string, synthetic boolean, "
                          "events_file string").coalesce(1).write.json(f"{folder}/meta.json")
    return slice_id, folder


def _raw(spark, sf_dir, *cases) -> DataFrame:
    events = fd.read_table(spark, sf_dir, "events")
    root = shared_dir(spark, "landed")
    slices = [land(spark, events, root, "baseline", False)]
    if "late" in cases:
        slices.append(land(spark, events.filter("event_type = 'click'").withColumn(
            "value", F.col("value") + sc.LATE_DELTA), root, "late", True))
    if "corrupt" in cases:
        bad = events.filter("event_type = 'error'").withColumn("value", F.col("value") + sc.CORRUPT_DELTA)
        slices.append(land(spark, bad.withColumn("event_id", F.concat(F.lit("corrupt_"), F.col("event_id"))),
                           root, "corrupt", True))
    return load_raw(spark, slices)[0]


COLS = ("event_key", "event_id", "event_date", "magnitude", "depth_km", "net", "event_type", "status", "place",
        "_slice_id", "_slice_order", "_is_synthetic")


def _slice_sql(slice_id: str, order: int, delta: int, where: str, prefix: str = "") -> str:
    return f"""SELECT md5('{fd.EVENTS_SOURCE}|{prefix}' || event_id) AS event_key, '{prefix}' || event_id AS event_id,
  CAST(ts AS DATE) AS event_date, CAST(value + {delta} AS DECIMAL(18,6)) AS magnitude,
  CAST(json_extract_string(props, '$.k') AS DECIMAL(18,6)) AS depth_km, CAST(user_id AS VARCHAR) AS net, event_type,
  'reviewed' AS status, props AS place, '{slice_id}' AS _slice_id, CAST({order} AS INTEGER) AS _slice_order,
  {str(order > 0).upper()} AS _is_synthetic
FROM events WHERE {where}"""


BASE_SLICE = _slice_sql("baseline", 0, 0, "TRUE")
LATE_SLICE = _slice_sql("late", 1, sc.LATE_DELTA, "event_type = 'click'")


@register("raw_versions", f"{BASE_SLICE} UNION ALL {LATE_SLICE}")
def q_raw_versions(spark, sf_dir):
    """All versions of a baseline and a correction slice, from their text files."""
    return stage_versions(type_raw_events(_raw(spark, sf_dir, "late")), None, None).select(*COLS)


@register("raw_latest", f"""{LATE_SLICE} UNION ALL
SELECT * FROM ({BASE_SLICE}) b WHERE event_type <> 'click' OR event_type IS NULL""")
def q_raw_latest(spark, sf_dir):
    versions = stage_versions(type_raw_events(_raw(spark, sf_dir, "late")), None, None)
    return latest_version(versions, ["event_key"], LATEST_ORDER).select(*COLS)


@register("raw_trace", f"""SELECT 'corrupt_' || event_id AS event_id, 'corrupt' AS _slice_id,
  CAST(1 AS INTEGER) AS _slice_order, TRUE AS _is_synthetic
FROM events WHERE event_type = 'error' AND value + {sc.CORRUPT_DELTA} > {fd.VALUE_RANGE[1]}""")
def q_raw_trace(spark, sf_dir):
    """Out-of-range events traced back to the slice rows they came from."""
    raw = _raw(spark, sf_dir, "corrupt")
    typed = type_raw_events(raw)
    failing = typed.filter(F.col("magnitude") > fd.VALUE_RANGE[1]).select("source_system", "event_id")
    return trace_to_raw(failing, raw).select("event_id", "_slice_id", "_slice_order", "_is_synthetic")


@register("raw_history", o.elt_ctes() + "SELECT * FROM dim_network")
def q_raw_history(spark, sf_dir):
    """The network dimension from history slices landed as text: versions that
    still hold in one slice, ended ones in another."""
    root, history = shared_dir(spark, "landed-history"), fd.user_history(fd.read_table(spark, sf_dir, "events"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    current = F.col("valid_to") >= F.lit(OPEN_END).cast(history.schema["valid_to"].dataType)
    slices = []
    for slice_id, rows in (("baseline", history.filter(current)), ("ended", history.filter(~current))):
        folder = f"{root}/{slice_id}"
        (rows.select("net", "network_name", text("valid_from"), text("valid_to")).write.option("header", True)
         .option("quote", '"').option("escape", '"').csv(f"{folder}/history"))
        spark.createDataFrame([(fd.EVENTS_SOURCE, False, "history")], "source_system string, synthetic boolean, "
                              "history_file string").coalesce(1).write.json(f"{folder}/meta.json")
        slices.append((slice_id, folder))
    staged = stage_network_history(load_raw(spark, slices)[1])
    for c in ("valid_from", "valid_to"):
        staged = staged.withColumn(c, F.col(c).cast(history.schema[c].dataType))
    return network_dim(staged)


# --- the gated run -------------------------------------------------------------------------

def _gated(spark, sf_dir):
    """Baseline run, the same run again, then a corrupt run, on one root."""
    events = fd.read_table(spark, sf_dir, "events")
    bounds, root = fd.event_bounds(events), shared_dir(spark, "gated")
    runs = []
    for run_id, case in (("first", "baseline"), ("again", "baseline"), ("bad", "corrupt")):
        typed, hist = sc.make_case(events, case)
        runs.append(run_elt(spark, typed, hist, *bounds, root=root, run_id=run_id, classes=fd.VALUE_CLASSES,
                            fact_types=fd.FACT_TYPES, tests=elt_tests(**DRIVER_TESTS)))
    return root, runs


_FAILS = f"(SELECT count(*) FROM ({summary_sql('corrupt')}) s WHERE failures > 0)"


@register("gate_blocked", f"""SELECT (SELECT count(*) FROM {o.layer_sql('baseline', 'mart')} m) AS live_rows,
  TRUE AS rerun_identical, FALSE AS bad_run_published, CAST(2 AS BIGINT) AS publications, {_FAILS} AS failed_tests""")
def q_gate_blocked(spark, sf_dir):
    """A run repeated publishes the same rows; a run that fails its tests
    publishes nothing and leaves the live table as it was."""
    from strata.operators.publish import Publisher
    root, (first, again, bad) = _gated(spark, sf_dir)
    pub = Publisher(spark, f"{root}/mart/daily")
    same = first["published"]["checksum"] == again["published"]["checksum"]
    return pub.live().agg(F.count(F.lit(1)).alias("live_rows")).select(
        "live_rows", F.lit(same).alias("rerun_identical"), F.lit(bad["published"] is not None).alias("bad_run_published"),
        F.lit(pub.log().count()).cast("bigint").alias("publications"),
        F.lit(len(bad["failing"])).cast("bigint").alias("failed_tests"))


@register("audit_failures", f"SELECT test_name, failures AS stored_rows FROM ({summary_sql('corrupt')}) s")
def q_audit_failures(spark, sf_dir):
    """Rows of every test in the audit table after the corrupt run: failing
    tests hold their failing rows, all others none."""
    root, (_first, _again, bad) = _gated(spark, sf_dir)
    stored = read_failures(spark, f"{root}/dbt_test_audit").groupBy("test_name").agg(F.count(F.lit(1)).alias("n"))
    names = spark.createDataFrame([(k,) for k in bad["tests"]], "test_name string")
    return names.join(stored, "test_name", "left").select("test_name", F.coalesce("n", F.lit(0)).alias("stored_rows"))


RANGE_TEST = "magnitude_and_depth_in_range"


@register("audit_rows", f"""SELECT '{RANGE_TEST}' AS test_name, event_key, event_id,
  CAST(magnitude AS DECIMAL(18,6)) AS magnitude, CAST(depth_km AS DECIMAL(18,6)) AS depth_km
FROM {o.layer_sql('corrupt', 'fact')} f
WHERE magnitude IS NULL OR magnitude NOT BETWEEN {fd.VALUE_RANGE[0]} AND {fd.VALUE_RANGE[1]}
   OR depth_km IS NULL OR depth_km NOT BETWEEN {fd.DEPTH_RANGE[0]} AND {fd.DEPTH_RANGE[1]}""")
def q_audit_rows(spark, sf_dir):
    """Content of the stored failures: the rows out of range of a blocked run."""
    root, _runs = _gated(spark, sf_dir)
    of = lambda c: F.get_json_object("row", f"$.{c}")
    return (read_failures(spark, f"{root}/dbt_test_audit").filter(F.col("test_name") == RANGE_TEST)
            .select("test_name", of("event_key").alias("event_key"), of("event_id").alias("event_id"),
                    *[of(c).cast("decimal(18,6)").alias(c) for c in ("magnitude", "depth_km")]))
