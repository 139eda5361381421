"""Staging layer: typing raw text, event versions, latest version per key.

Mirrors the ODS models of the reference ELT: every source column arrives as
text, blanks become NULL before a cast, identity is (source_system, event_id),
the business date is the UTC date of the event time, and the current state of
a key is its greatest (updated_ts DESC NULLS FIRST, slice_order, row_num).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import blank_to_null, in_window, surrogate_key, utc_date

NUMERIC = "decimal(18,6)"

LINEAGE = ["_slice_id", "_slice_order", "_row_num", "_is_synthetic"]


def type_raw_events(raw: DataFrame) -> DataFrame:
    """Raw all-text event slice (22 source columns + lineage) -> typed columns.

    ``nullif(c,'')`` then cast; ANSI mode makes a malformed number or time
    raise, like the reference's abort on a bad cast."""
    return raw.select(
        F.col("_source_system").alias("source_system"),
        F.col("id").alias("event_id"),
        blank_to_null("time").cast("timestamp").alias("event_ts"),
        blank_to_null("updated").cast("timestamp").alias("updated_ts"),
        blank_to_null("latitude").cast(NUMERIC).alias("latitude"),
        blank_to_null("longitude").cast(NUMERIC).alias("longitude"),
        blank_to_null("depth").cast(NUMERIC).alias("depth_km"),
        blank_to_null("mag").cast(NUMERIC).alias("magnitude"),
        blank_to_null("magtype").alias("mag_type"),
        blank_to_null("net").alias("net"),
        blank_to_null("type").alias("event_type"),
        blank_to_null("status").alias("status"),
        blank_to_null("place").alias("place"),
        *LINEAGE,
    )


def stage_versions(typed: DataFrame, start, end) -> DataFrame:
    """All versions inside the half-open processing window, with the event
    surrogate key and the UTC business date.

    The window filter runs *before* version ranking, as in the reference
    (a correction that moves an event out of the window leaves its old
    version current). It is a plain predicate on ``event_ts`` so it reaches
    the Parquet scan as a pushed filter."""
    event_date = utc_date("event_ts")
    if start is not None:
        typed = typed.filter(in_window(event_date, start, end))
    return (
        typed.select(
            surrogate_key("source_system", "event_id").alias("event_key"),
            "source_system", "event_id", "event_ts",
            event_date.alias("event_date"),
            "updated_ts", "latitude", "longitude", "depth_km", "magnitude",
            "mag_type", "net", "event_type", "status", "place",
            *LINEAGE,
        )
    )


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   nulls_first: bool = True, rank_col: str | None = "version_rank",
                   total: bool = True) -> DataFrame:
    """Greatest row per key under ``ORDER BY order[0] DESC, order[1] DESC ...``.

    ``row_number() = 1`` over the key: Catalyst plans it with a partial
    ``WindowGroupLimit`` before the shuffle (each map task forwards at most
    one row per key) and a final one after it, so a key holding a large share
    of all rows (a redelivered slice, a storm of copies) is reduced locally.
    ``nulls_first`` reproduces PostgreSQL ``DESC`` (a NULL order value wins).
    With ``total`` the remaining columns break exact ties, so the chosen row
    is the same under any partitioning."""
    direction = F.desc_nulls_first if nulls_first else F.desc_nulls_last
    cols = list(order)
    if total:
        cols += [c for c in df.columns if c not in cols and c not in keys
                 and _orderable(df.schema[c].dataType)]
    w = Window.partitionBy(*keys).orderBy(*[direction(c) for c in cols])
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    if rank_col:
        out = out.withColumn(rank_col, F.lit(1))
    return out


def _orderable(t) -> bool:
    from pyspark.sql.types import MapType, VariantType
    return not isinstance(t, (MapType, VariantType))


def version_chain(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  track: str, min_versions: int = 2, partitions: int | None = None) -> DataFrame:
    """All versions of keys that have at least ``min_versions`` versions,
    oldest first, with ``version_no``, ``n_versions`` and the previous value
    of ``track`` (``prev_<track>``) to show what changed. ``track`` should be
    one of the ``order`` columns (or be determined by them).

    Skew-safe two-level numbering: rows are range-partitioned on
    ``(keys, order)``, so a key with a huge history spans several partitions;
    ``row_number``/``lag`` run per (partition, key), and a small table with one
    row per (partition, key) provides each piece's offset and the last value
    of the preceding piece. No task ever holds a whole key. The ranged rows
    are checkpointed to the shared checkpoint folder (never a local one)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_versions"))
    multi = counts.filter(F.col("n_versions") >= min_versions)
    sort_cols = [F.asc_nulls_last(c) for c in list(keys) + list(order)]
    from strata.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    # The piece id is fixed by a reliable checkpoint: both uses below see the
    # same ids however the shuffle reads are coalesced.
    ranged = (_same_keys(df, multi, keys)
              .repartitionByRange(n, *sort_cols)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    w_local = Window.partitionBy("_pid", *keys).orderBy(*[F.asc_nulls_last(c) for c in order])
    local = (ranged.withColumn("_ln", F.row_number().over(w_local))
             .withColumn("_lag", F.lag(track).over(w_local)))
    # The order of the sort (NULLs last), as one comparable value.
    last = F.max_by(F.col(track), F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))]))
    edge = ranged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_cnt"), last.alias("_last"))
    w_key = Window.partitionBy(*keys).orderBy("_pid")
    edge = (edge.withColumn("_offset", F.coalesce(
                F.sum("_cnt").over(w_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_prev_last", F.lag("_last").over(w_key))
            .drop("_cnt", "_last"))
    out = _same_keys(local, edge, ["_pid", *keys])
    return (out.withColumn("version_no", (F.col("_ln") + F.col("_offset")).cast("int"))
            .withColumn(f"prev_{track}", F.when(F.col("_ln") == 1, F.col("_prev_last"))
                        .otherwise(F.col("_lag")))
            .drop("_pid", "_ln", "_lag", "_offset", "_prev_last"))


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL equals NULL; keys come from ``left``."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "inner").drop(*[f"_r_{k}" for k in keys])
