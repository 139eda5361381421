"""Registered ELT queries: staging, dimensions, fact, mart reports, quality
gate and delta scenarios over ``events`` (and version history over
``lineitem``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import aggregates as agg
from strata.operators import quality as dq
from strata.operators.dims import OPEN_END, calendar_from_bounds, history_from_changes
from strata.operators.joins import find_overlaps, scd2_merge_join
from strata.operators.staging import latest_version, version_chain
from strata.plans import feeds as fd
from strata.plans import oracle as o
from strata.plans import scenarios as sc
from strata.plans.elt import _one_version, elt_tests, layer_writer, test_tables
from strata.plans.queries import events_layers, register
from strata.plans.quakes import build_layers, checkpoint_dims
from strata.session import shared_dir
from strata.sources.tables import write_partitioned

BASE = o.elt_ctes()

# Length of an event's interval in the query dense_overlaps.
SESSION_HOURS = 2

DRIVER_TESTS = dict(statuses=fd.STATUSES, event_types=fd.EVENT_TYPES,
                    mag_range=fd.VALUE_RANGE, depth_range=fd.DEPTH_RANGE)

# Version order of lineitem rows sharing (l_orderkey, l_linenumber): newest
# ship date first, the remaining columns make the order total.
LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def case_layers(spark, sf_dir, name, keep=None):
    events = fd.read_table(spark, sf_dir, "events")
    start, end = fd.event_bounds(events)
    typed, hist = sc.make_case(events, name)
    return build_layers(spark, typed, hist, start, end, classes=fd.VALUE_CLASSES, fact_types=fd.FACT_TYPES,
                        keep=keep or checkpoint_dims, parallel=keep is not None)


def case_summary(spark, sf_dir, name):
    tests, seen = elt_tests(**DRIVER_TESTS), {}
    layers = case_layers(spark, sf_dir, name, keep=layer_writer(spark, shared_dir(spark, f"elt-{name}"), tests, seen))
    return dq.summary_table(spark, tests, test_tables(layers, fd.FACT_TYPES), known=seen)


def summary_sql(name):
    return o.dq_summary_sql(o.case_ctes(name), elt_tests(**DRIVER_TESTS))


# --- staging ----------------------------------------------------------------------------

@register("typed_events", BASE + "SELECT * FROM versions")
def q_typed_events(spark, sf_dir):
    return events_layers(spark, sf_dir).versions


li_order_desc = ", ".join(f"{c} DESC NULLS FIRST" for c in LI_ORDER)
li_order_asc = ", ".join(f"{c} ASC NULLS LAST" for c in LI_ORDER)


@register("latest_version", f"""
SELECT * EXCLUDE (rn), 1 AS version_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {li_order_desc}) AS rn
  FROM lineitem) r WHERE rn = 1""")
def q_latest_version(spark, sf_dir):
    return latest_version(fd.read_table(spark, sf_dir, "lineitem"), LI_KEYS, LI_ORDER)


@register("version_chain", f"""
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, CAST(row_number() OVER w AS INTEGER) AS version_no,
         count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n_versions,
         l_shipdate, lag(l_shipdate) OVER w AS prev_l_shipdate, l_partkey, l_quantity
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY {li_order_asc})) v
WHERE n_versions >= 2""")
def q_version_chain(spark, sf_dir):
    li = fd.read_table(spark, sf_dir, "lineitem")
    return (version_chain(li, LI_KEYS, LI_ORDER, "l_shipdate")
            .select("l_orderkey", "l_linenumber", "version_no", "n_versions", "l_shipdate",
                    "prev_l_shipdate", "l_partkey", "l_quantity"))


# --- dimensions and fact --------------------------------------------------------------

@register("network_dim", BASE + "SELECT * FROM dim_network")
def q_network_dim(spark, sf_dir):
    return events_layers(spark, sf_dir).dim_network


@register("calendar_dim", f"""
SELECT {o.calendar_cols('d')} FROM (
  SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events) b) x""")
def q_calendar_dim(spark, sf_dir):
    ev = fd.read_table(spark, sf_dir, "events")
    bounds = ev.agg(F.min(F.to_date("ts")).alias("s"), F.date_add(F.max(F.to_date("ts")), 1).alias("e"))
    return calendar_from_bounds(bounds, "s", "e")


@register("fact_events", BASE + "SELECT * FROM fact")
def q_fact_events(spark, sf_dir):
    return events_layers(spark, sf_dir).fact


# --- mart reports -----------------------------------------------------------------------

SHARE_SQL = f"""per AS (SELECT event_date, net, CAST(sum(events) AS BIGINT) AS events FROM mart GROUP BY 1, 2),
tot AS (SELECT event_date, sum(events) AS total FROM per GROUP BY 1),
sh AS (SELECT per.event_date, per.net, per.events,
              {o.half_up('per.events * 100', 'tot.total', 0, 1)} AS share_pct
       FROM per JOIN tot ON per.event_date = tot.event_date)
"""


@register("mart_by_class", BASE + """SELECT event_date, magnitude_class, CAST(sum(events) AS BIGINT) AS events
FROM mart GROUP BY 1, 2""")
def q_mart_by_class(spark, sf_dir):
    return agg.events_by_day_class(events_layers(spark, sf_dir).mart).orderBy("event_date", "magnitude_class")


@register("mart_share", BASE.rstrip() + ",\n" + SHARE_SQL + "SELECT * FROM sh")
def q_mart_share(spark, sf_dir):
    return agg.share_of_total(events_layers(spark, sf_dir).mart)


@register("mart_top3", BASE.rstrip() + ",\n" + SHARE_SQL + """SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY event_date ORDER BY events DESC, net ASC NULLS LAST) AS INTEGER) AS rn
  FROM sh) r WHERE rn <= 3""")
def q_mart_top3(spark, sf_dir):
    share = agg.share_of_total(events_layers(spark, sf_dir).mart)
    return agg.top_n_per_group(share, "event_date", [F.desc("events"), F.asc_nulls_last("net")], 3)


@register("mart_weighted", BASE + f"""SELECT event_date, max(max_magnitude) AS max_magnitude,
  {o.half_up('sum(CAST(avg_depth_km * events * 100 AS HUGEINT))', 'sum(events)', 2, 2)} AS avg_depth_km,
  CAST(sum(events) AS BIGINT) AS events
FROM mart GROUP BY 1""")
def q_mart_weighted(spark, sf_dir):
    return agg.weighted_daily(events_layers(spark, sf_dir).mart)


@register("daily_exact", BASE + f"""SELECT event_date, max(magnitude) AS max_magnitude,
  {o.avg_round('depth_km', 2)} AS avg_depth_km, count(*) AS events
FROM fact GROUP BY 1""")
def q_daily_exact(spark, sf_dir):
    return agg.exact_daily(events_layers(spark, sf_dir).fact)


@register("layer_counts", BASE + """SELECT * FROM (
  SELECT 'versions' AS layer, count(*) AS rows FROM versions UNION ALL
  SELECT 'latest', count(*) FROM latest UNION ALL
  SELECT 'dim_network', count(*) FROM dim_network UNION ALL
  SELECT 'dim_class', count(*) FROM dim_class UNION ALL
  SELECT 'dim_date', count(*) FROM dim_date UNION ALL
  SELECT 'fact', count(*) FROM fact UNION ALL
  SELECT 'mart', count(*) FROM mart) c""")
def q_layer_counts(spark, sf_dir):
    """Rows per layer of one run. The layers are materialised once (the chain
    is computed a single time) and counted from the written tables: counting
    lazy layers would re-scan the events for every branch."""
    layers = case_layers(spark, sf_dir, "baseline", keep=layer_writer(spark, shared_dir(spark, "layers")))
    parts = [getattr(layers, n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("layer"), "rows")
             for n in ("versions", "latest", "dim_network", "dim_class", "dim_date", "fact", "mart")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- independent control and trailing window -------------------------------------------

@register("control_check", BASE + f""", src AS (
  SELECT CAST(ts AS DATE) AS event_date,
         CASE {' '.join(f"WHEN CAST(value AS DECIMAL(18,6)) >= {lo} AND CAST(value AS DECIMAL(18,6)) < {hi} THEN {o.q(n)}" for _k, n, lo, hi in fd.VALUE_CLASSES)} END AS magnitude_class,
         CAST(value AS DECIMAL(18,6)) AS mag
  FROM events WHERE event_type IN ({o.in_list(fd.FACT_TYPES)})),
s AS (SELECT event_date, magnitude_class, count(*) AS src_events,
             {o.avg_round('mag', 2)} AS src_avg, max(mag) AS src_max FROM src GROUP BY 1, 2),
m AS (SELECT event_date, magnitude_class, CAST(sum(events) AS BIGINT) AS mart_events,
             {o.half_up('sum(CAST(avg_magnitude * events * 1000 AS HUGEINT))', 'sum(events)', 3, 2)} AS mart_avg,
             max(max_magnitude) AS mart_max FROM mart GROUP BY 1, 2)
SELECT coalesce(s.event_date, m.event_date) AS event_date,
       coalesce(s.magnitude_class, m.magnitude_class) AS magnitude_class,
       s.src_events, m.mart_events, s.src_avg, m.mart_avg, s.src_max, m.mart_max,
       coalesce(s.src_events = m.mart_events AND abs(s.src_avg - m.mart_avg) <= 0.01
                AND s.src_max = m.mart_max, FALSE) AS ok
FROM s FULL JOIN m ON s.event_date = m.event_date AND s.magnitude_class IS NOT DISTINCT FROM m.magnitude_class""")
def q_control_check(spark, sf_dir):
    """Recount per day x class straight from ``events`` and compare with the
    mart: counts and maxima must be equal, averages within 0.01; a cell missing
    on either side fails. The recount shares no code or constants with the
    mart build: the class is the number of lower bounds reached, averages are
    plain decimal quotients."""
    ev = fd.read_table(spark, sf_dir, "events")
    mag = F.col("value").cast("decimal(18,6)")
    lows = F.array(*[F.lit(x) for x in (0, 1, 10, 50, 100, 200, 400)])
    names = F.array(*[F.lit(x) for x in "micro minor light moderate strong major great".split()])
    reached = F.size(F.filter(lows, lambda low: low <= mag))
    src = (ev.filter("event_type IN ('purchase', 'click', 'view')")
           .select(F.to_date("ts").alias("event_date"), mag.alias("mag"),
                   F.when(mag < 1000, F.get(names, reached - 1)).alias("magnitude_class")))
    quotient = lambda total, n: F.round(F.col(total).cast("decimal(28,8)") / F.col(n), 2).cast("decimal(18,2)")
    s = (src.groupBy("event_date", "magnitude_class")
         .agg(F.count(F.lit(1)).alias("src_events"), F.sum("mag").alias("_s"), F.count("mag").alias("_n"),
              F.max("mag").alias("src_max"))
         .select("event_date", "magnitude_class", "src_events", quotient("_s", "_n").alias("src_avg"), "src_max"))
    mart = events_layers(spark, sf_dir).mart
    m = (mart.groupBy("event_date", "magnitude_class")
         .agg(F.sum("events").cast("long").alias("mart_events"),
              F.sum(F.col("avg_magnitude") * F.col("events")).alias("_w"),
              F.max("max_magnitude").alias("mart_max"))
         .select(F.col("event_date").alias("_m_date"), F.col("magnitude_class").alias("_m_class"),
                 "mart_events", quotient("_w", "mart_events").alias("mart_avg"), "mart_max"))
    j = s.join(m, (s["event_date"] == m["_m_date"]) & s["magnitude_class"].eqNullSafe(m["_m_class"]), "full")
    ok = F.coalesce((F.col("src_events") == F.col("mart_events"))
                    & (F.abs(F.col("src_avg") - F.col("mart_avg")) <= F.lit(0.01).cast("decimal(3,2)"))
                    & (F.col("src_max") == F.col("mart_max")), F.lit(False))
    return j.select(F.coalesce("event_date", "_m_date").alias("event_date"),
                    F.coalesce("magnitude_class", "_m_class").alias("magnitude_class"),
                    "src_events", "mart_events", "src_avg", "mart_avg", "src_max", "mart_max", ok.alias("ok"))


REPROCESS_DAY, REPROCESS_LOOKBACK = "2024-01-20", 3


def _reprocess_bounds():
    from strata.operators.publish import reprocess_window
    s, e = reprocess_window(REPROCESS_DAY, REPROCESS_LOOKBACK)
    return s.isoformat(), e.isoformat()


@register("reprocess_window", o.elt_ctes(start=_reprocess_bounds()[0], end=_reprocess_bounds()[1])
          + "SELECT * FROM mart")
def q_reprocess_window(spark, sf_dir):
    s, e = _reprocess_bounds()
    return events_layers(spark, sf_dir, s, e).mart


@register("reprocess_incremental", o.elt_ctes(start=_reprocess_bounds()[0], end=_reprocess_bounds()[1])
          + "SELECT * FROM mart")
def q_reprocess_incremental(spark, sf_dir):
    """The trailing window rebuilt from a written versions layer, of which
    only the window's days are read."""
    return incremental_layers(spark, sf_dir, *_reprocess_bounds()).mart


def incremental_layers(spark, sf_dir, start, end):
    events = fd.read_table(spark, sf_dir, "events")
    path = shared_dir(spark, "versions-by-day") + "/t"
    versions = events_layers(spark, sf_dir).versions
    write_partitioned(versions, path, "event_date")
    staged = spark.read.parquet(path).select(versions.columns)
    return build_layers(spark, None, fd.user_history(events), start, end, classes=fd.VALUE_CLASSES,
                        fact_types=fd.FACT_TYPES, keep=checkpoint_dims, staged=staged)


# --- a dense history -----------------------------------------------------------------------

@register("dense_history", f"""
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
                FROM events WHERE event_type <> 'view'),
v AS (SELECT user_id, event_type AS state, ts AS valid_from,
             lead(ts, 1, TIMESTAMP '{OPEN_END}') OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
      FROM ranked WHERE rn = 1)
SELECT e.event_id, e.user_id, e.ts, v.state, v.valid_from, v.valid_to
FROM events e LEFT JOIN v ON v.user_id = e.user_id AND v.valid_from <= e.ts AND e.ts < v.valid_to
WHERE e.event_type = 'view'""")
def q_dense_history(spark, sf_dir):
    """Every view with its user's state at that time: a history with a version
    per event of the user, merged with the facts in time order."""
    events = fd.read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    changes = latest_version(events.filter("event_type <> 'view'"), ["user_id", "ts"], ["event_id"], rank_col=None)
    states = history_from_changes(changes, ["user_id"], "ts").select(
        F.col("user_id").alias("_user"), F.col("event_type").alias("state"), "valid_from", "valid_to")
    views = events.filter("event_type = 'view'").drop("event_type")
    return scd2_merge_join(views, states, [("user_id", "_user")], "ts", disjoint=True).drop("_user")


@register("dense_overlaps", f"""
WITH v AS (SELECT user_id, event_id, ts AS s, ts + INTERVAL {SESSION_HOURS} HOUR AS t FROM events)
SELECT a.user_id, a.event_id AS version_a, b.event_id AS version_b, a.s AS a_from, a.t AS a_to, b.s AS b_from, b.t AS b_to
FROM v a JOIN v b ON a.user_id = b.user_id AND a.event_id < b.event_id AND a.s < b.t AND b.s < a.t""")
def q_dense_overlaps(spark, sf_dir):
    """Pairs of events of a user that lie within some hours of each other: the
    overlap search over long histories."""
    events = fd.read_table(spark, sf_dir, "events")
    spans = events.select("user_id", "event_id", F.col("ts").alias("valid_from"),
                          (F.col("ts") + F.make_dt_interval(hours=F.lit(SESSION_HOURS))).alias("valid_to"))
    return find_overlaps(spans, ["user_id"], "event_id")


# --- quality gate and scenarios ------------------------------------------------------------

@register("dq_summary", summary_sql("baseline"))
def q_dq_summary(spark, sf_dir):
    return case_summary(spark, sf_dir, "baseline")


for _case in ("corrupt", "overlap"):
    def _make(case):
        def fn(spark, sf_dir):
            return case_summary(spark, sf_dir, case)
        fn.__name__ = f"q_case_{case}"
        return fn
    register(f"case_{_case}", summary_sql(_case))(_make(_case))

for _case in ("dup", "late", "source_b"):
    def _make_mart(case):
        def fn(spark, sf_dir):
            return case_layers(spark, sf_dir, case).mart
        fn.__name__ = f"q_case_{case}"
        return fn
    register(f"case_{_case}", o.case_ctes(_case) + "SELECT * FROM mart")(_make_mart(_case))


@register("key_counts", o.case_ctes("source_b") + """,
pk AS (SELECT source_system, event_id, count(*) AS n FROM versions GROUP BY 1, 2),
pid AS (SELECT event_id, count(*) AS sources, sum(n) AS nrows FROM pk GROUP BY 1)
SELECT CAST(sum(nrows) AS BIGINT) AS rows, count(*) AS distinct_ids, CAST(sum(sources) AS BIGINT) AS distinct_keys,
       count(*) FILTER (WHERE sources >= 2) AS shared_ids FROM pid""".replace("\n,", ",", 1))
def q_key_counts(spark, sf_dir):
    return agg.key_counts(case_layers(spark, sf_dir, "source_b").versions, "event_id", "source_system")


@register("dq_range", o.case_ctes("corrupt") + f"""SELECT event_key, event_id, magnitude, depth_km FROM fact
WHERE NOT coalesce(greatest({fd.VALUE_RANGE[0]} - magnitude, magnitude - {fd.VALUE_RANGE[1]}) <= 0, FALSE)
   OR NOT coalesce(greatest({fd.DEPTH_RANGE[0]} - depth_km, depth_km - {fd.DEPTH_RANGE[1]}) <= 0, FALSE)""")
def q_dq_range(spark, sf_dir):
    layers = case_layers(spark, sf_dir, "corrupt")
    test = next(x for x in elt_tests(**DRIVER_TESTS) if x.name == "magnitude_and_depth_in_range")
    return test.failing_rows({"fact": layers.fact})


@register("dq_overlaps", o.case_ctes("overlap") + """,
hist_lists AS (
  SELECT source_system, net, list({'k': network_key, 's': valid_from, 't': valid_to}) AS vs
  FROM dim_network GROUP BY ALL),
one AS (SELECT source_system, net, vs, unnest(vs) AS x FROM hist_lists),
two AS (SELECT source_system, net, x, unnest(vs) AS y FROM one)
SELECT source_system, net, x.k AS version_a, y.k AS version_b, x.s AS a_from, x.t AS a_to, y.s AS b_from, y.t AS b_to
FROM two WHERE x.k < y.k AND greatest(x.s, y.s) < least(x.t, y.t)""".replace("\n,", ",", 1))
def q_dq_overlaps(spark, sf_dir):
    return find_overlaps(case_layers(spark, sf_dir, "overlap").dim_network, ["source_system", "net"], "network_key")


@register("dq_ambiguous", o.case_ctes("overlap") + f"""SELECT * FROM (
  SELECT event_key, event_id, source_system, net,
         (SELECT count(*) FROM dim_network d WHERE d.net = v.net AND d.source_system = v.source_system
            AND v.event_ts BETWEEN d.valid_from AND d.valid_to - INTERVAL 1 MICROSECOND) AS matching_versions
  FROM latest v WHERE event_type IN ({o.in_list(fd.FACT_TYPES)})) x
WHERE matching_versions > 1""")
def q_dq_ambiguous(spark, sf_dir):
    layers = case_layers(spark, sf_dir, "overlap")
    return _one_version({"latest": layers.latest, "dim_network": layers.dim_network,
                         "_fact_types": list(fd.FACT_TYPES)})


@register("dq_duplicates", o.case_ctes("overlap") + """SELECT event_key, count(*) AS duplicates
FROM fact GROUP BY event_key HAVING count(*) > 1""")
def q_dq_duplicates(spark, sf_dir):
    """Fact keys that an overlapping network history multiplied."""
    return agg.duplicate_keys(case_layers(spark, sf_dir, "overlap").fact, ["event_key"])


@register("dq_orphans", f"""SELECT f.* FROM {o.layer_sql('source_b', 'fact')} f
WHERE f.network_key IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {o.layer_sql('baseline', 'dim_network')} d WHERE d.network_key = f.network_key)""")
def q_dq_orphans(spark, sf_dir):
    """Facts of the second-source run whose network key is unknown to the
    baseline run's dimension (referential check across runs)."""
    from strata.operators.joins import orphans
    fact = case_layers(spark, sf_dir, "source_b").fact
    return orphans(fact, "network_key", events_layers(spark, sf_dir).dim_network, "network_key")


@register("dq_reconcile", f"""WITH f AS (SELECT event_date, count(*) AS fact_events
             FROM {o.layer_sql('source_b', 'fact')} x GROUP BY 1),
m AS (SELECT event_date, CAST(sum(events) AS BIGINT) AS mart_events FROM {o.layer_sql('baseline', 'mart')} y GROUP BY 1)
SELECT coalesce(f.event_date, m.event_date) AS event_date, f.fact_events, m.mart_events
FROM f FULL JOIN m ON f.event_date = m.event_date
WHERE f.fact_events IS DISTINCT FROM m.mart_events""")
def q_dq_reconcile(spark, sf_dir):
    """Daily events of the second-source run's fact against the baseline
    mart (FULL OUTER, NULL-safe difference): the days the new source moved."""
    from strata.operators.joins import reconcile
    f = (case_layers(spark, sf_dir, "source_b").fact.groupBy("event_date")
         .agg(F.count(F.lit(1)).alias("fact_events")))
    m = (events_layers(spark, sf_dir).mart.groupBy("event_date")
         .agg(F.sum("events").cast("long").alias("mart_events")))
    return reconcile(f, m, "event_date", "fact_events", "mart_events") \
        .select("event_date", "fact_events", "mart_events")
