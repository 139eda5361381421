"""Aggregations, marts and ranking reports.

Every aggregate is decomposable (count, sum, max) so Spark computes it
partially on each map task before the shuffle; averages are carried as
(sum, count) and divided only at the end with exact HALF_UP rounding. Where a
join follows an aggregation over a large input, the input is reduced to the
join key first (pre-aggregation), so the shuffle and the join see one row per
key instead of one row per event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import first_failing_rule, half_up_ratio, row_digest
from strata.session import checkpoint_root


# --- reference track 1: class totals, quality profile, accepted split ------

def class_totals(df: DataFrame, group: str, measure: str,
                 pages: str = "pages", total: str = "total_views") -> DataFrame:
    """``group -> count(*), sum(measure)`` ordered by the sum, descending
    (group name breaks ties so the order is total)."""
    out = (df.groupBy(group)
           .agg(F.count(F.lit(1)).alias(pages), F.sum(measure).cast("long").alias(total)))
    return out.orderBy(F.desc(total), F.asc(group))


def quality_profile(df: DataFrame, rules: Sequence[tuple[str, Column]],
                    share_of: str | None = None) -> DataFrame:
    """One pass: total rows and, per rule, the number of rows failing it.

    Rules are ``(name, failure_condition)``; a NULL condition counts as a
    failure (``coalesce(cond, true)``). With ``share_of`` the share of that
    rule's failures in all rows is added as ``<rule>_share`` (6 decimals)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name, cond in rules:
        aggs.append(F.count_if(F.coalesce(cond, F.lit(True))).alias(name))
    out = df.agg(*aggs)
    if share_of:
        out = out.withColumn(f"{share_of}_share",
                             F.when(F.col("rows") > 0,
                                    F.round(F.col(share_of).cast("decimal(38,6)") / F.col("rows"), 6))
                             .cast("decimal(18,6)"))
    return out


def tag_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]],
                reason: str = "reject_reason") -> DataFrame:
    """Tag each row with its *first* failing rule (NULL = accepted)."""
    safe = [(n, F.coalesce(c, F.lit(True))) for n, c in rules]
    return df.withColumn(reason, first_failing_rule(safe))


def profile_and_split(df: DataFrame, rules: Sequence[tuple[str, Column]], share_of: str | None = None) -> dict:
    """The quality profile and the rows per outcome from one pass over ``df``:
    ``{"rows", "<rule>": failures, "<rule>_share", "outcomes": {...}}``."""
    tagged = tag_rejects(df, rules, "_outcome")
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name, cond in rules:
        aggs += [F.count_if(F.coalesce(cond, F.lit(True))).alias(name),
                 F.count_if(F.col("_outcome") == name).alias(f"_first_{name}")]
    row = tagged.agg(*aggs).first().asDict()
    out = {k: v for k, v in row.items() if not k.startswith("_first_")}
    rejected = {name: row[f"_first_{name}"] for name, _ in rules}
    out["outcomes"] = {"accepted": row["rows"] - sum(rejected.values()), **rejected}
    if share_of:
        out[f"{share_of}_share"] = round(row[share_of] / row["rows"], 6) if row["rows"] else None
    return out


def split_summary(tagged: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """Rows per outcome (``accepted`` or the rule name): the balance
    ``rows = accepted + rejected`` holds by construction."""
    return (tagged.groupBy(F.coalesce(F.col(reason), F.lit("accepted")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("rows")))


def split_accepted(df: DataFrame, rules: Sequence[tuple[str, Column]]):
    """``(accepted, rejected, summary)``, all lazy.

    Every row gets exactly one outcome (its first failing rule, or accepted),
    so ``rows = accepted + rejected`` holds by construction; the summary (one
    row per outcome, one aggregate over the tagged rows) reports the split."""
    tagged = tag_rejects(df, rules)
    summary = split_summary(tagged)
    accepted = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = tagged.filter(F.col("reject_reason").isNotNull())
    return accepted, rejected, summary


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """Global top-N (``TakeOrderedAndProject``: per-task top-N, then merge)."""
    return df.orderBy(*order).limit(n)


# --- reference track 2: marts ----------------------------------------------

MART_GRAIN = ["event_date", "class_key", "magnitude_class", "source_system", "net", "network_name"]


def daily_mart(fact: DataFrame, dim_network: DataFrame, dim_class: DataFrame) -> DataFrame:
    """Daily mart: per (date, class, source, network version) the event count,
    ``round(avg(magnitude),3)``, ``max(magnitude)``, ``round(avg(depth),2)``.

    Plan: the fact is reduced to (date, network_key, class_key, source) with
    partial sums first, then joined LEFT to both dimensions by key, then
    re-aggregated to the grain. Equivalent to joining every fact row (sums and
    counts multiply with duplicated dimension keys exactly as row joins do),
    but the join sees one row per cell instead of one per event."""
    cells = (fact.groupBy("event_date", "network_key", "mag_class_key", "source_system")
             .agg(F.count(F.lit(1)).alias("_n"),
                  F.sum("magnitude").alias("_s_mag"), F.count("magnitude").alias("_n_mag"),
                  F.max("magnitude").alias("_max_mag"),
                  F.sum("depth_km").alias("_s_dep"), F.count("depth_km").alias("_n_dep")))
    net = dim_network.select(F.col("network_key").alias("_nk"), "net", "network_name")
    cls = dim_class.select(F.col("class_key"), F.col("class_name").alias("magnitude_class"))
    joined = (cells.join(net, cells["network_key"] == net["_nk"], "left")
              .join(cls, cells["mag_class_key"] == cls["class_key"], "left"))
    grouped = (joined.groupBy(*MART_GRAIN)
               .agg(F.sum("_n").alias("events"),
                    F.sum("_s_mag").alias("_s_mag"), F.sum("_n_mag").alias("_n_mag"),
                    F.max("_max_mag").alias("max_magnitude"),
                    F.sum("_s_dep").alias("_s_dep"), F.sum("_n_dep").alias("_n_dep")))
    return grouped.select(
        *MART_GRAIN,
        F.col("events").cast("long").alias("events"),
        half_up_ratio("_s_mag", "_n_mag", 6, 3).alias("avg_magnitude"),
        F.col("max_magnitude").cast("decimal(18,6)").alias("max_magnitude"),
        half_up_ratio("_s_dep", "_n_dep", 6, 2).alias("avg_depth_km"),
    )


def events_by_day_class(mart: DataFrame) -> DataFrame:
    """Re-aggregated mart: events per day and class."""
    return (mart.groupBy("event_date", "magnitude_class")
            .agg(F.sum("events").cast("long").alias("events")))


def share_of_total(mart: DataFrame, part: str = "event_date", item: str = "net",
                   measure: str = "events") -> DataFrame:
    """``round(100 * sum(x) / sum(sum(x)) over (partition by part), 1)``.

    Rows are reduced to one per (part, item) and checkpointed; totals are a
    second aggregation of those, joined back, so no task holds a part. A NULL
    ``part`` is a partition like any other."""
    checkpoint_root(mart.sparkSession)
    per_item = mart.groupBy(part, item).agg(F.sum(measure).cast("long").alias(measure)).checkpoint(eager=True)
    total = per_item.groupBy(F.col(part).alias("_part")).agg(
        F.sum(F.col(measure).cast("decimal(28,0)")).cast("decimal(38,0)").alias("_total"))
    j = (per_item.join(total, F.col(part).eqNullSafe(F.col("_part")))
         .withColumn("_pct100", F.col(measure).cast("decimal(38,0)") * 100))
    return j.select(part, item, measure, half_up_ratio("_pct100", "_total", 0, 1).alias("share_pct"))


def top_n_per_group(df: DataFrame, part: str, order: Sequence[Column], n: int,
                    rank: str = "rn") -> DataFrame:
    """``row_number() over (partition by part order by ...) <= n``.

    Catalyst plans this with a partial ``WindowGroupLimit`` before the
    shuffle, so each map task forwards at most ``n`` rows per group."""
    w = Window.partitionBy(part).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def weighted_daily(mart: DataFrame) -> DataFrame:
    """Per day: ``max(max_magnitude)``, ``round(sum(avg_depth*events)/sum(events),2)``,
    ``sum(events)`` — a weighted average of pre-rounded averages (drifts by
    up to 0.01 from the exact value; see ``exact_daily``)."""
    g = (mart.groupBy("event_date")
         .agg(F.max("max_magnitude").alias("max_magnitude"),
              F.sum(F.col("avg_depth_km") * F.col("events")).alias("_w"),
              F.sum("events").cast("long").alias("events")))
    return g.select("event_date", "max_magnitude",
                    half_up_ratio("_w", "events", 2, 2).alias("avg_depth_km"), "events")


def exact_daily(fact: DataFrame) -> DataFrame:
    """Per day, from fact sums (no pre-rounded averages): max magnitude,
    exact ``round(avg(depth),2)``, events."""
    g = (fact.groupBy("event_date")
         .agg(F.max("magnitude").alias("max_magnitude"),
              F.sum("depth_km").alias("_s"), F.count("depth_km").alias("_n"),
              F.count(F.lit(1)).alias("events")))
    return g.select("event_date", "max_magnitude",
                    half_up_ratio("_s", "_n", 6, 2).alias("avg_depth_km"), "events")


def field_counts(df: DataFrame, day, field: str, date_col: str = "event_date") -> DataFrame:
    """``field -> rows`` on one day (a NULL value counts as a value)."""
    return df.filter(F.col(date_col) == day).groupBy(field).agg(F.count(F.lit(1)).alias("rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "duplicates") -> DataFrame:
    """``group by keys having count(*) > 1`` (NULL keys group together)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def key_counts(df: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """Rows, distinct ids, distinct (source, id) keys, ids shared by >=2
    sources. Exact distinct counts via two-level aggregation."""
    per_key = df.groupBy(source_col, id_col).agg(F.count(F.lit(1)).alias("_n"))
    per_id = per_key.groupBy(id_col).agg(F.count(F.lit(1)).alias("_sources"), F.sum("_n").alias("_rows"))
    return per_id.agg(
        F.sum("_rows").cast("long").alias("rows"),
        F.count(F.lit(1)).alias("distinct_ids"),
        F.sum("_sources").cast("long").alias("distinct_keys"),
        F.count_if(F.col("_sources") >= 2).alias("shared_ids"),
    )


def table_checksum(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive checksum of a table: ``rows`` and the exact sum of a
    60-bit md5 digest per row, rendered as ``checksum = '<rows>:<sum>'``.

    Computed by partial aggregation on every executor: no table-wide string is
    built in one task. Equal multisets of rows give equal checksums."""
    cols = list(cols or sorted(df.columns))
    g = df.agg(F.count(F.lit(1)).alias("rows"),
               F.coalesce(F.sum(row_digest(cols)), F.lit(0).cast("decimal(38,0)")).alias("_digest"))
    return g.select("rows", F.concat_ws(":", F.col("rows").cast("string"),
                                        F.col("_digest").cast("string")).alias("checksum"))
