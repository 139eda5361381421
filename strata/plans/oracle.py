"""ANSI SQL (DuckDB dialect) for every registered query: an independent
second implementation over the same parquet tables.

Exactness rules shared with the Spark side: measures are decimals, averages
and percentages are rounded HALF_UP by integer arithmetic (DuckDB divides
decimals in DOUBLE), integer sums are cast to BIGINT, ordering of the latest
version uses ``DESC NULLS FIRST`` explicitly.
"""

from __future__ import annotations

from strata.plans import feeds as fd


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return ", ".join(q(v) for v in values)


def half_up(sum_int: str, n: str, in_scale: int, out_scale: int) -> str:
    """HALF_UP ``(sum_int / 10^in_scale) / n`` at ``out_scale``; ``sum_int``
    is an exact integer (unscaled) sum."""
    ns, ks = 10 ** in_scale, 10 ** out_scale
    den = f"(CAST({n} AS HUGEINT) * {ns})"
    pos = f"((2 * ({sum_int}) * {ks} + {den}) // (2 * {den}))"
    neg = f"(-((2 * (-({sum_int})) * {ks} + {den}) // (2 * {den})))"
    qv = f"(CASE WHEN {sum_int} < 0 THEN {neg} ELSE {pos} END)"
    if out_scale:
        unit = f"CAST('{1 / ks:.{out_scale}f}' AS DECIMAL(18,{out_scale}))"
        scaled = f"CAST({qv} AS DECIMAL(18,0)) * {unit}"
    else:
        scaled = f"CAST({qv} AS DECIMAL(18,0))"
    return (f"CASE WHEN {n} IS NULL OR {n} = 0 OR ({sum_int}) IS NULL THEN NULL "
            f"ELSE CAST({scaled} AS DECIMAL(18,{out_scale})) END")


def avg_round(expr: str, out_scale: int, in_scale: int = 6) -> str:
    s = f"sum(CAST(({expr}) * {10 ** in_scale} AS HUGEINT))"
    return half_up(s, f"count({expr})", in_scale, out_scale)


# Half-open bounds of all events, as SQL.
FIRST_DAY = "(SELECT min(CAST(ts AS DATE)) FROM events)"
END_DAY = "(SELECT CAST(max(CAST(ts AS DATE)) + 1 AS DATE) FROM events)"


def window_pred(col: str, start: str | None, end: str | None) -> str:
    """Half-open window; without bounds every row."""
    if start is None:
        return "TRUE"
    return f"{col} >= DATE {q(start)} AND {col} < DATE {q(end)}"


# --- events model -----------------------------------------------------------

def typed_events(source: str = fd.EVENTS_SOURCE, slice_id: str = "baseline", order: int = 0,
                 synthetic: bool = False, table: str = "events") -> str:
    return f"""SELECT {q(source)} AS source_system, CAST(event_id AS VARCHAR) AS event_id,
  ts AS event_ts, ts AS updated_ts,
  CAST(NULL AS DECIMAL(18,6)) AS latitude, CAST(NULL AS DECIMAL(18,6)) AS longitude,
  CAST(json_extract_string(props, '$.k') AS DECIMAL(18,6)) AS depth_km,
  CAST(value AS DECIMAL(18,6)) AS magnitude, CAST(NULL AS VARCHAR) AS mag_type,
  CAST(user_id AS VARCHAR) AS net, event_type, 'reviewed' AS status, props AS place,
  {q(slice_id)} AS _slice_id, CAST({order} AS INTEGER) AS _slice_order,
  CAST(event_id + 1 AS BIGINT) AS _row_num, {str(synthetic).upper()} AS _is_synthetic
FROM {table}"""


def versions_sql(typed: str, start: str, end: str) -> str:
    return f"""SELECT md5(source_system || '|' || event_id) AS event_key, source_system, event_id,
  event_ts, CAST(event_ts AS DATE) AS event_date, updated_ts, latitude, longitude, depth_km,
  magnitude, mag_type, net, event_type, status, place, _slice_id, _slice_order, _row_num, _is_synthetic
FROM ({typed}) t
WHERE {window_pred('CAST(event_ts AS DATE)', start, end)}"""


def latest_sql(versions: str) -> str:
    return f"""SELECT * EXCLUDE (rn), 1 AS version_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY event_key
    ORDER BY updated_ts DESC NULLS FIRST, _slice_order DESC NULLS FIRST, _row_num DESC NULLS FIRST) AS rn
  FROM ({versions}) v) r
WHERE rn = 1"""


def user_history_sql(source: str = fd.EVENTS_SOURCE, table: str = "events") -> str:
    return f"""WITH f AS (
  SELECT user_id, min(CASE WHEN event_type = 'signup' THEN ts END) AS fs FROM {table} GROUP BY user_id)
SELECT {q(source)} AS source_system, CAST(user_id AS VARCHAR) AS net,
  'user ' || CAST(user_id AS VARCHAR) || ' visitor' AS network_name,
  TIMESTAMP '1900-01-01 00:00:00' AS valid_from, coalesce(fs, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
  FALSE AS _is_synthetic
FROM f
UNION ALL
SELECT {q(source)}, CAST(user_id AS VARCHAR), 'user ' || CAST(user_id AS VARCHAR) || ' member',
  fs, TIMESTAMP '9999-12-31 00:00:00', FALSE
FROM f WHERE fs IS NOT NULL"""


def dim_network_sql(history: str) -> str:
    return f"""SELECT md5(source_system || '|' || net || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS network_key,
  source_system, net, network_name, valid_from, valid_to,
  valid_to >= TIMESTAMP '9999-12-31 00:00:00' AS is_current
FROM ({history}) h"""


def dim_class_sql(classes=fd.VALUE_CLASSES) -> str:
    rows = ", ".join(f"({k}, {q(n)}, CAST({lo} AS DECIMAL(18,6)), CAST({hi} AS DECIMAL(18,6)))"
                     for k, n, lo, hi in classes)
    return f"SELECT * FROM (VALUES {rows}) AS t(class_key, class_name, mag_min, mag_max)"


def fact_sql(latest: str, dim_network: str, dim_class: str, fact_types=fd.FACT_TYPES) -> str:
    """Facts with the network version and class looked up by key; an event in
    two versions of its network's history gives a row for each."""
    kinds = in_list(fact_types)
    return f"""WITH biz AS (SELECT * FROM ({latest}) WHERE event_type IN ({kinds})),
versions_of AS (
  SELECT b.event_key AS k, d.network_key AS nk FROM biz b, ({dim_network}) d
  WHERE d.net = b.net AND d.source_system = b.source_system
    AND b.event_ts BETWEEN d.valid_from AND d.valid_to - INTERVAL 1 MICROSECOND)
SELECT b.event_key, b.source_system, b.event_id, b.event_ts, b.event_date, versions_of.nk AS network_key,
  (SELECT max(class_key) FROM ({dim_class}) WHERE mag_min <= b.magnitude AND b.magnitude < mag_max) AS mag_class_key,
  b.magnitude, b.depth_km, b.latitude, b.longitude, b.mag_type, b.status, b.updated_ts, b.place
FROM biz b LEFT JOIN versions_of ON versions_of.k = b.event_key"""


def mart_sql(fact: str, dim_network: str, dim_class: str) -> str:
    return f"""SELECT f.event_date, c.class_key, c.class_name AS magnitude_class, f.source_system, n.net,
  n.network_name, count(*) AS events,
  {avg_round('f.magnitude', 3)} AS avg_magnitude,
  CAST(max(f.magnitude) AS DECIMAL(18,6)) AS max_magnitude,
  {avg_round('f.depth_km', 2)} AS avg_depth_km
FROM ({fact}) f
LEFT JOIN ({dim_network}) n ON n.network_key = f.network_key
LEFT JOIN ({dim_class}) c ON c.class_key = f.mag_class_key
GROUP BY 1, 2, 3, 4, 5, 6"""


def elt_ctes(typed: str | None = None, history: str | None = None,
             start: str | None = None, end: str | None = None) -> str:
    """WITH-list defining typed, versions, latest, hist, dim_network,
    dim_class, fact and mart for the events model."""
    typed = typed or typed_events()
    history = history or user_history_sql()
    return f"""WITH typed AS ({typed}),
versions AS ({versions_sql('SELECT * FROM typed', start, end)}),
latest AS ({latest_sql('SELECT * FROM versions')}),
hist AS ({history}),
dim_network AS ({dim_network_sql('SELECT * FROM hist')}),
dim_class AS ({dim_class_sql()}),
dim_date AS ({dim_date_sql(start, end)}),
fact AS ({fact_sql('SELECT * FROM latest', 'SELECT * FROM dim_network', 'SELECT * FROM dim_class')}),
mart AS ({mart_sql('SELECT * FROM fact', 'SELECT * FROM dim_network', 'SELECT * FROM dim_class')})
"""


# --- page-view model ----------------------------------------------------------

PAGE_ROWS = f"""SELECT p.p_name AS page_title, CAST(l.l_quantity AS INTEGER) AS count_views, l.l_partkey
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey"""


def namespace_expr(col: str) -> str:
    pre = f"regexp_extract({col}, {q(fd.WORD_PATTERN)}, 1)"
    return f"CASE WHEN {pre} IN ({in_list(fd.KNOWN_WORDS)}) THEN {pre} ELSE {q(fd.DEFAULT_CLASS)} END"


def lookup_values() -> str:
    rows = ", ".join(f"({q(a)}, {q(b)})" for a, b in fd.WORD_GROUPS)
    return f"SELECT * FROM (VALUES {rows}) AS t(namespace, content_group)"


def calendar_cols(d: str) -> str:
    return (f"CAST({d} AS DATE) AS date_key, CAST(isodow({d}) AS INTEGER) AS iso_weekday, "
            f"strftime({d}, '%a') AS weekday_name, CAST(year({d}) AS INTEGER) AS year, "
            f"CAST(month({d}) AS INTEGER) AS month")


def dim_date_sql(start: str | None, end: str | None) -> str:
    first, stop = (FIRST_DAY, END_DAY) if start is None else (f"DATE {q(start)}", f"DATE {q(end)}")
    return (f"SELECT {calendar_cols('d')} FROM (SELECT CAST(unnest(generate_series({first}, "
            f"CAST({stop} - 1 AS DATE), INTERVAL 1 DAY)) AS DATE) AS d) x")


# --- scenarios -------------------------------------------------------------------

def case_inputs(name: str) -> tuple[str, str]:
    """(typed events SQL, network history SQL) for a scenario."""
    from strata.plans import scenarios as sc
    base, hist = typed_events(), user_history_sql()
    if name == "baseline":
        return base, hist
    if name == "dup":
        d = typed_events(slice_id="dup", order=1, synthetic=True,
                         table="(SELECT * FROM events WHERE event_type = 'purchase') e")
        return f"SELECT * FROM ({base}) a UNION ALL SELECT * FROM ({d}) b", hist
    if name == "late":
        d = typed_events(slice_id="late", order=1, synthetic=True,
                         table=f"(SELECT * REPLACE (value + {sc.LATE_DELTA} AS value) FROM events "
                               f"WHERE event_type = 'click') e")
        d = f"SELECT * REPLACE (TIMESTAMP {q(sc.LATE_UPDATED)} AS updated_ts) FROM ({d}) x"
        return f"SELECT * FROM ({base}) a UNION ALL SELECT * FROM ({d}) b", hist
    if name == "source_b":
        d = typed_events(source=sc.MIRROR_SOURCE, slice_id="source_b", order=1, synthetic=True,
                         table="(SELECT * FROM events WHERE event_type = 'view') e")
        h = (f"SELECT * FROM ({hist}) a UNION ALL "
             f"SELECT * REPLACE (TRUE AS _is_synthetic) FROM ({user_history_sql(sc.MIRROR_SOURCE)}) b")
        return f"SELECT * FROM ({base}) a UNION ALL SELECT * FROM ({d}) b", h
    if name == "corrupt":
        d = typed_events(slice_id="corrupt", order=1, synthetic=True,
                         table=f"(SELECT * REPLACE (value + {sc.CORRUPT_DELTA} AS value, 'purchase' AS event_type) "
                               f"FROM events WHERE event_type = 'error') e")
        d = f"SELECT * REPLACE ('corrupt_' || event_id AS event_id) FROM ({d}) x"
        return f"SELECT * FROM ({base}) a UNION ALL SELECT * FROM ({d}) b", hist
    if name == "overlap":
        h = (f"SELECT * FROM ({hist}) a UNION ALL "
             f"SELECT {q(fd.EVENTS_SOURCE)}, CAST(user_id AS VARCHAR), "
             f"'user ' || CAST(user_id AS VARCHAR) || ' renamed', TIMESTAMP {q(sc.OVERLAP_FROM)}, "
             f"TIMESTAMP '9999-12-31 00:00:00', TRUE FROM (SELECT DISTINCT user_id FROM events) u")
        return base, h
    raise ValueError(name)


def case_ctes(name: str, start: str | None = None, end: str | None = None) -> str:
    typed, hist = case_inputs(name)
    return elt_ctes(typed, hist, start, end)


# --- quality gate --------------------------------------------------------------------

SQL_TABLE = {"network_history": "hist"}


def singular_sql(name: str, fact_types, mag_range, depth_range) -> str:
    """Failing rows of the singular tests, each put in its own way: counts by
    key, sorted windows and subqueries instead of the tests' joins."""
    inside = lambda c, r: f"coalesce(greatest({r[0]} - {c}, {c} - {r[1]}) <= 0, FALSE)"
    return {
        "fact_matches_stg_count": f"""SELECT sum(n) AS gap FROM (
  SELECT count(*) AS n FROM fact UNION ALL
  SELECT -count(*) FROM latest WHERE event_type IN ({in_list(fact_types)})) d HAVING sum(n) <> 0""",
        "mag_class_matches_magnitude": """SELECT event_key FROM fact WHERE mag_class_key IN (
  SELECT class_key FROM dim_class WHERE NOT (mag_min <= fact.magnitude AND fact.magnitude < mag_max))""",
        "magnitude_and_depth_in_range": f"""SELECT event_key FROM fact
WHERE NOT ({inside('magnitude', mag_range)} AND {inside('depth_km', depth_range)})""",
        "mart_grain_unique": """SELECT DISTINCT grain FROM (
  SELECT {'d': event_date, 'c': class_key, 's': source_system, 'n': net, 'w': network_name} AS grain,
         row_number() OVER (PARTITION BY event_date, class_key, source_system, net, network_name) AS k FROM mart) g
WHERE k = 2""",
        "mart_reconciles_with_fact": """SELECT event_date FROM (
  SELECT event_date, 1 AS n FROM fact UNION ALL SELECT event_date, -events FROM mart) u
GROUP BY event_date HAVING sum(n) <> 0""",
        "network_history_no_overlap": """SELECT x.k FROM (
  SELECT unnest(vs) AS x, vs FROM (
    SELECT list({'k': network_key, 's': valid_from, 't': valid_to}) AS vs FROM dim_network GROUP BY source_system, net)) o,
  unnest(vs) AS p(y) WHERE x.k < y.k AND greatest(x.s, y.s) < least(x.t, y.t)""",
        "one_network_version_per_event": f"""SELECT event_key FROM latest v
WHERE event_type IN ({in_list(fact_types)})
  AND (SELECT count(*) FROM dim_network d WHERE d.net = v.net AND d.source_system = v.source_system
       AND v.event_ts BETWEEN d.valid_from AND d.valid_to - INTERVAL 1 MICROSECOND) > 1""",
    }[name]


def test_count_sql(test, fact_types, mag_range, depth_range) -> str:
    t = SQL_TABLE.get(test.table, test.table)
    c = test.column
    if test.kind == "not_null":
        body = f"SELECT count(*) AS n FROM {t} WHERE {c} IS NULL"
    elif test.kind == "unique":
        body = f"SELECT count(*) AS n FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) x"
    elif test.kind == "accepted_values":
        body = f"SELECT count(*) AS n FROM (SELECT {c} FROM {t} WHERE {c} NOT IN ({in_list(test.values)}) GROUP BY {c}) x"
    elif test.kind == "relationships":
        pt, pc = test.parent
        pt = SQL_TABLE.get(pt, pt)
        body = (f"SELECT count(*) AS n FROM {t} ch WHERE ch.{c} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {pt} p WHERE p.{pc} = ch.{c})")
    else:
        body = f"SELECT count(*) AS n FROM ({singular_sql(test.name, fact_types, mag_range, depth_range)}) x"
    return f"SELECT {q(test.name)} AS test_name, n AS failures FROM ({body}) y"


def dq_summary_sql(ctes: str, tests, fact_types=fd.FACT_TYPES, mag_range=fd.VALUE_RANGE,
                   depth_range=fd.DEPTH_RANGE) -> str:
    parts = "\nUNION ALL\n".join(test_count_sql(x, fact_types, mag_range, depth_range) for x in tests)
    return (ctes + "SELECT test_name, CAST(failures AS BIGINT) AS failures, "
            "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n" + parts + "\n) s")


def layer_sql(case: str, layer: str) -> str:
    """One layer of a scenario run as a self-contained subquery."""
    return f"(WITH {case_ctes(case)[5:]} SELECT * FROM {layer})"
