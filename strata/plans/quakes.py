"""The ELT candidate build: versions -> latest -> dims -> fact -> mart.

``build_layers`` is lazy: it returns DataFrames whose plans chain the
operators; nothing runs until a layer is written or tested. ``run_elt``
(in ``plans.elt``) materialises the layers that are read many times.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.aggregates import daily_mart
from strata.operators.dims import MAGNITUDE_CLASSES, calendar, class_dim, network_dim
from strata.operators.joins import band_join, scd2_join, scd2_merge_join
from strata.functions import in_window
from strata.operators.staging import latest_version, stage_versions

LATEST_ORDER = ("updated_ts", "_slice_order", "_row_num")
FACT_COLUMNS = ["event_key", "source_system", "event_id", "event_ts", "event_date",
                "network_key", "mag_class_key", "magnitude", "depth_km", "latitude",
                "longitude", "mag_type", "status", "updated_ts", "place"]


@dataclass
class Layers:
    versions: DataFrame
    latest: DataFrame
    network_history: DataFrame
    dim_network: DataFrame
    dim_class: DataFrame
    dim_date: DataFrame
    fact: DataFrame
    mart: DataFrame


def build_fact(latest: DataFrame, dim_network: DataFrame, classes, fact_types,
               dense: bool = False) -> DataFrame:
    """Fact: latest versions of business events, SCD2 network version valid
    at the event time, magnitude class by band; LEFT joins, so unmatched
    events keep NULL keys for the quality gate to report. ``dense`` selects
    the sorted merge for histories with many versions per key."""
    ev = latest.filter(F.col("event_type").isin(list(fact_types)))
    dim = dim_network.select(F.col("network_key"), F.col("source_system").alias("_d_src"),
                             F.col("net").alias("_d_net"), F.col("valid_from").alias("_d_from"),
                             F.col("valid_to").alias("_d_to"))
    join = scd2_merge_join if dense else scd2_join
    j = join(ev, dim, [("source_system", "_d_src"), ("net", "_d_net")], "event_ts",
             valid_from="_d_from", valid_to="_d_to", how="left")
    j = band_join(j, "magnitude", [(k, lo, hi) for k, _n, lo, hi in classes], out="mag_class_key")
    return j.select(*FACT_COLUMNS)


def checkpoint_dims(name: str, df: DataFrame) -> DataFrame:
    """``keep`` for lazy plans: the data-derived network dimension is read by
    both the fact (SCD2 join) and the mart (name lookup); checkpointing it once
    (reliable checkpoint in the shared folder) replaces two scans of the
    event table by one small table read twice. Other layers stay lazy."""
    if name == "dim_network":
        from strata.session import checkpoint_root
        checkpoint_root(df.sparkSession)
        return df.checkpoint(eager=True)
    return df


def build_layers(spark: SparkSession, typed_events: DataFrame, history: DataFrame,
                 start, end, classes=MAGNITUDE_CLASSES, fact_types=("earthquake",),
                 keep=None, rank_first: bool = False, dense_history: bool = False,
                 parallel: bool = False, staged: DataFrame | None = None) -> Layers:
    """Chain the layers. ``keep(name, df) -> df`` is applied to each layer
    before it feeds the next one: identity (lazy, one plan) or a writer that
    materialises the layer and continues from the written table.

    ``rank_first=False`` (the reference's behaviour) filters versions to the
    window before picking the latest one, so a correction that moves an event
    out of the window leaves its old in-window version current.
    ``rank_first=True`` picks the latest version over all versions first and
    then keeps it only if it lies in the window.

    ``dense_history=True`` merges events and SCD2 versions in time order
    instead of joining by key (``joins.scd2_merge_join``), for histories with
    many versions per key.

    ``staged``: a written versions layer to build from instead of
    ``typed_events`` (an incremental build). Its window is a predicate on
    ``event_date``; where the layer is partitioned by it, only the window's
    days are read."""
    keep = keep or (lambda _name, df: df)

    def chain():
        if rank_first:
            every = stage_versions(typed_events, None, None) if staged is None else staged
            v = keep("versions", every.filter(in_window("event_date", start, end)))
            lt = keep("latest", latest_version(every, ["event_key"], LATEST_ORDER)
                      .filter(in_window("event_date", start, end)))
        else:
            v = keep("versions", stage_versions(typed_events, start, end) if staged is None
                     else staged.filter(in_window("event_date", start, end)))
            lt = keep("latest", latest_version(v, ["event_key"], LATEST_ORDER))
        return v, lt

    def dims():
        h = keep("network_history", history)
        return h, keep("dim_network", network_dim(h)), keep("dim_class", class_dim(spark, classes)), \
            keep("dim_date", calendar(spark, start, end))

    if parallel:
        # The dimension branch does not depend on the version chain: when the
        # layers are materialised, both branches run as concurrent Spark jobs.
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=1) as pool:
            pending = pool.submit(dims)
            versions, latest = chain()
            hist, dim_n, dim_c, dim_d = pending.result()
    else:
        versions, latest = chain()
        hist, dim_n, dim_c, dim_d = dims()
    fact = keep("fact", build_fact(latest, dim_n, classes, fact_types,
                                   dense=dense_history))
    mart = keep("mart", daily_mart(fact, dim_n, dim_c))
    return Layers(versions, latest, hist, dim_n, dim_c, dim_d, fact, mart)
