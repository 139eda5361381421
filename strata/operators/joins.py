"""Joins: SCD2 interval join, band join, lookup join and join safety checks.

Physical strategy is left to Catalyst + AQE. Only inputs with a proven size
bound are broadcast explicitly (band seeds after a count check); literal
lookups are broadcast by Catalyst from their exact statistics; dimensions
derived from data are joined by key and AQE turns the join into a broadcast
at runtime when the measured side is small, or splits skewed key partitions
when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import band_key
from strata.operators.ordered import by_range, running

# Bands handled as one expression; more are joined.
CASE_BANDS = 64
# Histories of up to so many versions are checked for overlaps pair by pair; longer ones are swept, in runs of partners.
SHORT_HISTORY = 64
SWEEP_RUN = 4096


def scd2_join(fact: DataFrame, dim: DataFrame, keys: Sequence[tuple[str, str]],
              ts: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
              how: str = "left", days: tuple | None = None) -> DataFrame:
    """Attach the dimension version valid at ``fact[ts]``:
    equi on ``keys`` (fact column, dim column) and ``valid_from <= ts < valid_to``.

    Overlapping versions multiply fact rows on purpose (the quality gate
    reports them); nothing is de-duplicated silently. ``dim`` columns other
    than the join keys must not clash with ``fact`` columns.

    Physical strategy: for slowly changing dimensions (few versions per key)
    the equi-join on the keys with the range as a residual is linear; AQE
    broadcasts a small dimension or splits a skewed key. With ``days =
    (start, end)`` (the processing window) every version is expanded to the
    window days it covers and the join also matches the event's day, so an
    event is compared only with the versions valid on its day: linear even
    for histories that change many times per key, and a hot key is spread
    over its days; events on other days take the plain way. Both strategies
    return the same rows."""
    if days is not None:
        return _scd2_join_by_day(fact, dim, keys, ts, valid_from, valid_to, how, days)
    cond = None
    for fc, dc in keys:
        c = fact[fc] == dim[dc]
        cond = c if cond is None else cond & c
    cond = cond & (fact[ts] >= dim[valid_from]) & (fact[ts] < dim[valid_to])
    return fact.join(dim, cond, how)


def _scd2_join_by_day(fact, dim, keys, ts, valid_from, valid_to, how, days):
    import datetime as _dt
    start = _dt.date.fromisoformat(str(days[0]))
    last = _dt.date.fromisoformat(str(days[1])) - _dt.timedelta(days=1)
    first_day = F.greatest(F.to_date(F.col(valid_from)), F.lit(start))
    # the last day a half-open [from, to) interval touches
    last_day = F.least(F.to_date(F.col(valid_to) - F.expr("INTERVAL 1 MICROSECOND")), F.lit(last))
    d = (dim.filter(first_day <= last_day)
         .withColumn("_scd2_day", F.explode(F.sequence(first_day, last_day, F.expr("INTERVAL 1 DAY")))))
    day = F.to_date(F.col(ts))
    covered = F.coalesce(day.between(F.lit(start), F.lit(last)), F.lit(False))
    f = fact.filter(covered).withColumn("_scd2_fday", day)
    cond = f["_scd2_fday"] == d["_scd2_day"]
    for fc, dc in keys:
        cond = cond & (f[fc] == d[dc])
    cond = cond & (f[ts] >= d[valid_from]) & (f[ts] < d[valid_to])
    inside = f.join(d, cond, how).drop("_scd2_fday", "_scd2_day")
    # Rows outside the days given meet every version of their key, as without ``days``.
    return inside.unionByName(scd2_join(fact.filter(~covered), dim, keys, ts, valid_from, valid_to, how))


def scd2_merge_join(fact: DataFrame, dim: DataFrame, keys: Sequence[tuple[str, str]], ts: str,
                    valid_from: str = "valid_from", valid_to: str = "valid_to", how: str = "left",
                    disjoint: bool = False) -> DataFrame:
    """The rows of ``scd2_join``, by one merge: facts and version starts are
    put in order of (key, time) and every fact takes the last version that
    started, if it still holds. Work and shuffle are linear in facts plus
    versions however dense a history is, and a hot key is spread over many
    tasks (``ordered``).

    A fact meets one version that way, so keys whose versions overlap are
    joined by ``scd2_join`` (such a fact is multiplied there); ``disjoint``
    says that there are none and saves the search for them. Facts with a NULL
    key or time match nothing, nor do versions with a NULL or an end that is
    not after their start. ``how`` is ``left`` or ``inner``; key and time
    columns of both sides must have the same types."""
    if how not in ("left", "inner"):
        raise ValueError(f"how={how}")
    names = [f"_k{i}" for i in range(len(keys))]
    known = lambda cols: F.forall(F.array(*[F.col(c).isNotNull() for c in cols]), lambda x: x)
    f_keys, d_keys = [f for f, _ in keys], [d for _, d in keys]
    whole = known([*f_keys, ts])
    versions = dim.filter(known([*d_keys, valid_from, valid_to]) & (F.col(valid_from) < F.col(valid_to)))
    facts, out = fact.filter(whole), []
    if not disjoint:
        clash = _clashing(versions, d_keys, valid_from, valid_to)
        if not clash.isEmpty():
            pick = lambda df, cols, kind: df.join(
                clash.toDF(*names), [df[c] == F.col(n) for c, n in zip(cols, names)], kind)
            out.append(scd2_join(pick(facts, f_keys, "left_semi"), pick(versions, d_keys, "left_semi"), keys, ts,
                                 valid_from, valid_to, how))
            facts, versions = pick(facts, f_keys, "left_anti"), pick(versions, d_keys, "left_anti")
    row = lambda df: F.struct(*[df[c] for c in df.columns])
    none = lambda df: F.lit(None).cast(df.schema)
    side = lambda df, cols, at, kind, f, d: df.select(
        *[df[c].alias(n) for c, n in zip(cols, names)], df[at].alias("_t"), F.lit(kind).alias("_kind"),
        f.alias("_f"), d.alias("_d"))
    both = (side(facts, f_keys, ts, 1, row(facts), none(dim))
            .unionByName(side(versions, d_keys, valid_from, 0, none(fact), row(versions))))
    order = ["_t", "_kind"]
    last = running(by_range(both, names, order), names, order, F.col("_d"), "last", "_v").filter("_kind = 1")
    last = last.withColumn("_v", F.when(F.col("_t") < F.col("_v")[valid_to], F.col("_v")))
    if how == "inner":
        last = last.filter(F.col("_v").isNotNull())
    merged = last.select(*[F.col("_f")[c].alias(c) for c in fact.columns], *[F.col("_v")[c].alias(c) for c in dim.columns])
    if how == "left":
        out.append(fact.filter(~whole).select(*[fact[c] for c in fact.columns],
                                              *[F.lit(None).cast(x.dataType).alias(x.name) for x in dim.schema]))
    for part in out:
        merged = merged.union(part)
    return merged


def _clashing(versions: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str) -> DataFrame:
    """Keys with overlapping versions (none is empty), checkpointed."""
    rows = versions.select(*keys, F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"))
    return _spans(rows, keys, ["_from", "_to"])[1].filter("_upto > _no").select(*keys).distinct().checkpoint()


def _spans(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(starts, spans) of rows with ``_from`` and ``_to``: the rows of every
    key numbered by ``order`` (``_no``; it begins with the start), and the
    same rows with ``_upto``, the number of starts before their end. Later
    starts within a row's interval are just those numbered _no + 1 to _upto."""
    starts = running(by_range(rows, keys, order), keys, order, F.lit(1), "sum", "_no")
    marks = (starts.withColumn("_t", F.col("_from")).withColumn("_kind", F.lit(1))
             .unionByName(starts.withColumn("_t", F.col("_to")).withColumn("_kind", F.lit(0))))
    at = ["_t", "_kind"]
    spans = running(by_range(marks, keys, at), keys, at, F.col("_kind"), "sum", "_upto")
    return starts, spans.filter("_kind = 0").drop(*at)


def band_join(df: DataFrame, value: str, bands, out: str = "class_key") -> DataFrame:
    """Left band join ``lo <= value < hi``; a value in several bands gives a
    row for each.

    ``bands`` is a list of ``(key, lo, hi)`` or a DataFrame with columns
    ``(key, lo, hi)`` in that order; keys keep their type (whole numbers of a
    list are ``int``). Up to ``CASE_BANDS`` bands that do not overlap are one
    CASE expression, no join at all. Any others are joined by key: the values'
    range is cut into about as many cells as there are bands, every band is
    put into the cells it touches, and a value meets the bands of its cell."""
    spark = df.sparkSession
    if not isinstance(bands, DataFrame):
        rows = [tuple(b) for b in bands]
        if len(rows) <= CASE_BANDS and not _overlapping(rows):
            return df.withColumn(out, band_key(value, rows, _key_type([r[0] for r in rows])))
        bands = spark.createDataFrame([(str(k), str(lo), str(hi)) for k, lo, hi in rows], "k string, lo string, hi string")
        bands = bands.select(F.col("k").cast(_key_type([r[0] for r in rows])).alias("k"),
                             *[F.col(c).cast("decimal(38,10)").alias(c) for c in ("lo", "hi")])
    key, lo, hi = bands.columns[:3]
    b = bands.select(F.col(key).alias("_bk"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
    n, least, most = b.agg(F.count(F.lit(1)), F.min("_lo").cast("double"), F.max("_hi").cast("double")).first()
    if not n:
        return df.withColumn(out, F.lit(None).cast(bands.schema[key].dataType))
    width = max((most - least) / n, 1e-300)
    cell = lambda c: F.greatest(F.lit(-1.0), F.least(F.floor((F.col(c).cast("double") - least) / width), F.lit(n + 1)))
    # One cell more on either side: the cell of a bound may round either way.
    b = b.withColumn("_cell", F.explode(F.sequence((cell("_lo") - 1).cast("long"), (cell("_hi") + 1).cast("long"))))
    v = df.withColumn("_vcell", cell(value).cast("long"))
    hit = (v["_vcell"] == b["_cell"]) & (v[value] >= b["_lo"]) & (v[value] < b["_hi"])
    return v.join(b, hit, "left").withColumnRenamed("_bk", out).drop("_vcell", "_cell", "_lo", "_hi")


def _key_type(keys) -> str:
    return "int" if all(isinstance(k, int) for k in keys) else "string"


def _overlapping(rows) -> bool:
    ordered = sorted(rows, key=lambda r: r[1])
    return any(b[1] < a[2] for a, b in zip(ordered, ordered[1:]))


def lookup_join(df: DataFrame, lookup: DataFrame, on: str, value: str,
                default: str, out: str | None = None) -> DataFrame:
    """LEFT join to a lookup table with a default for unmatched rows.

    No broadcast hint: a literal lookup has exact size statistics, so Catalyst
    broadcasts it by itself; a large lookup is joined by key instead."""
    out = out or value
    j = df.join(lookup, on, "left")
    return j.withColumn(out, F.coalesce(F.col(value), F.lit(default)))


def join_audit(left: DataFrame, right: DataFrame, on: str, weight: str | None = None) -> DataFrame:
    """Row preservation of a LEFT join: ``before_join``, ``after_join``,
    ``unmatched`` in one row.

    ``weight`` names a row-count column when ``left`` is pre-aggregated
    (rows per key), so a large input is reduced before it meets ``right``."""
    w = F.col(weight) if weight else F.lit(1)
    before = left.agg(F.sum(w).cast("long").alias("before_join"))
    marker = right.select(F.col(on), F.lit(True).alias("_matched"))
    joined = left.join(marker, on, "left")
    after = joined.agg(
        F.sum(w).cast("long").alias("after_join"),
        F.sum(F.when(F.col("_matched").isNull(), w).otherwise(0)).cast("long").alias("unmatched"),
    )
    return one_row(before, after)


def one_row(*parts: DataFrame) -> DataFrame:
    """Combine single-row aggregates with distinct column names into one row
    (a union plus a global ``max`` per column; no cross join)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    cols = []
    for p in parts:
        cols.extend(p.columns)
    return out.agg(*[F.max(c).alias(c) for c in cols])


def find_overlaps(dim: DataFrame, keys: Sequence[str], version_key: str,
                  valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Pairs of versions of the same key whose intervals intersect, each pair
    once (``version_a < version_b``).

    Keys of up to ``SHORT_HISTORY`` versions are pruned first: sorted by
    ``valid_from``, a key has an overlap only if some version starts before
    the latest end seen so far, computed with a running ``max`` window. Only
    such keys enter the pairwise self-join. Longer histories are swept
    (``_swept_overlaps``): no task holds a key, and no pair is looked at that
    doesn't overlap."""
    size = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > SHORT_HISTORY).select(*keys)
    if size.isEmpty():
        return _paired_overlaps(dim, keys, version_key, valid_from, valid_to)
    long, short = dim.join(size, list(keys), "left_semi"), dim.join(size, list(keys), "left_anti")
    return (_paired_overlaps(short, keys, version_key, valid_from, valid_to)
            .unionByName(_swept_overlaps(long, keys, version_key, valid_from, valid_to)))


def _swept_overlaps(dim: DataFrame, keys: Sequence[str], version_key: str, valid_from: str, valid_to: str) -> DataFrame:
    """Versions are numbered by start; a version's partners are the later
    starts before its end, a run of numbers. Work is a sort plus the result."""
    known = F.forall(F.array(*[F.col(c).isNotNull() for c in (*keys, version_key, valid_from, valid_to)]), lambda x: x)
    rows = dim.filter(known).select(*keys, F.col(version_key).alias("_ver"), F.col(valid_from).alias("_from"),
                                    F.col(valid_to).alias("_to"))
    starts, spans = _spans(rows, keys, ["_from", "_ver", "_to"])
    step = F.lit(SWEEP_RUN).cast("long")
    runs = (spans.filter("_upto > _no").withColumn("_lo", F.explode(F.sequence(F.col("_no") + 1, F.col("_upto"), step)))
            .withColumn("_other", F.explode(F.sequence(F.col("_lo"), F.least(F.col("_lo") + step - 1, F.col("_upto"))))))
    later = starts.select(*keys, F.col("_no").alias("_other"), F.col("_ver").alias("_ver2"),
                          F.col("_from").alias("_from2"), F.col("_to").alias("_to2"))
    hit = (runs.join(later, [*keys, "_other"])
           .filter("_ver <> _ver2 AND _from < _to2 AND _from2 < _to"))
    first = F.col("_ver") < F.col("_ver2")
    pick = lambda x, y, name: F.when(first, F.col(x)).otherwise(F.col(y)).alias(name)
    return hit.select(*keys, pick("_ver", "_ver2", "version_a"), pick("_ver2", "_ver", "version_b"),
                      pick("_from", "_from2", "a_from"), pick("_to", "_to2", "a_to"),
                      pick("_from2", "_from", "b_from"), pick("_to2", "_to", "b_to"))


def _paired_overlaps(dim: DataFrame, keys: Sequence[str], version_key: str, valid_from: str, valid_to: str) -> DataFrame:
    from pyspark.sql import Window
    w = (Window.partitionBy(*keys).orderBy(F.col(valid_from), F.col(version_key))
         .rowsBetween(Window.unboundedPreceding, -1))
    flagged = dim.withColumn("_prev_end", F.max(valid_to).over(w))
    bad_keys = (flagged.filter(F.col(valid_from) < F.col("_prev_end"))
                .select(*keys).distinct())
    cand = dim.join(bad_keys, list(keys), "left_semi")
    a = cand.select(*[F.col(k) for k in keys], F.col(version_key).alias("version_a"),
                    F.col(valid_from).alias("a_from"), F.col(valid_to).alias("a_to"))
    b = cand.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col(version_key).alias("version_b"),
                    F.col(valid_from).alias("b_from"), F.col(valid_to).alias("b_to"))
    cond = None
    for k in keys:
        c = a[k] == b[f"_b_{k}"]
        cond = c if cond is None else cond & c
    cond = (cond & (a["version_a"] < b["version_b"])
            & (a["a_from"] < b["b_to"]) & (b["b_from"] < a["a_to"]))
    return (a.join(b, cond, "inner")
            .select(*keys, "version_a", "version_b", "a_from", "a_to", "b_from", "b_to"))


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (``relationships`` test)."""
    p = parent.select(F.col(parent_col).alias("_parent_key")).distinct()
    return (child.filter(F.col(child_col).isNotNull())
            .join(p, F.col(child_col) == F.col("_parent_key"), "left_anti"))


def reconcile(a: DataFrame, b: DataFrame, key: str, measure_a: str, measure_b: str) -> DataFrame:
    """FULL OUTER comparison of two keyed measures; keeps rows where the
    values are distinct (NULL-safe), i.e. missing on one side or different."""
    j = a.join(b, key, "full")
    return j.filter(~F.col(measure_a).eqNullSafe(F.col(measure_b)))
