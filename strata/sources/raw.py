"""Raw landing of event and network-history slices.

A slice is a folder with ``meta.json`` (``source_system``, ``synthetic``,
optional ``events_file`` / ``history_file``) and CSV files. The raw layer is
a pure function of the chosen slices: baseline first, then the cases in the
given order. Every source column stays text; lineage columns are added.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.quoted import read_quoted_csv

# Expected (lower-cased) headers of the two raw inputs.
EVENT_COLUMNS = [
    "time", "latitude", "longitude", "depth", "mag", "magtype", "nst", "gap", "dmin", "rms",
    "net", "id", "updated", "place", "type", "horizontalerror", "deptherror", "magerror",
    "magnst", "status", "locationsource", "magsource",
]
HISTORY_COLUMNS = ["net", "network_name", "valid_from", "valid_to"]


class UnknownSlice(ValueError):
    pass


def read_manifest(spark: SparkSession, folder: str) -> dict:
    """Slice manifest; optional keys come back as None."""
    path = f"{folder.rstrip('/')}/meta.json"
    if folder.startswith("/") and not os.path.isdir(folder):
        raise UnknownSlice(f"unknown slice folder: {folder}")
    row = spark.read.json(path).first()
    if row is None:
        raise UnknownSlice(f"empty manifest: {path}")
    d = row.asDict()
    return {"source_system": d["source_system"], "synthetic": bool(d.get("synthetic")),
            "events_file": d.get("events_file"), "history_file": d.get("history_file")}


def _lineage(df: DataFrame, meta: dict, slice_id: str, order: int) -> DataFrame:
    return df.select([c for c in df.columns if c != "_row_num"] + [
        F.lit(meta["source_system"]).alias("_source_system"), F.lit(slice_id).alias("_slice_id"),
        F.lit(order).cast("int").alias("_slice_order"), *[c for c in df.columns if c == "_row_num"],
        F.lit(bool(meta["synthetic"])).alias("_is_synthetic"), F.current_timestamp().alias("_loaded_at")])


def load_raw(spark: SparkSession, slices: Sequence[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """``(raw_events, raw_history)`` for ``[(slice_id, folder), ...]``.
    ``_row_num`` of events grows within a file, whichever tasks read it."""
    events, history = [], []
    for order, (slice_id, folder) in enumerate(slices):
        meta = read_manifest(spark, folder)
        if meta["events_file"]:
            ev = read_quoted_csv(spark, f"{folder.rstrip('/')}/{meta['events_file']}", EVENT_COLUMNS)
            events.append(_lineage(ev, meta, slice_id, order))
        if meta["history_file"]:
            h = read_quoted_csv(spark, f"{folder.rstrip('/')}/{meta['history_file']}", HISTORY_COLUMNS).drop("_row_num")
            history.append(_lineage(h, meta, slice_id, order))
    return _union(spark, events, EVENT_COLUMNS, True), _union(spark, history, HISTORY_COLUMNS, False)


def _union(spark, parts, columns, row_num):
    if parts:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    lineage = "_source_system string, _slice_id string, _slice_order int, "
    lineage += "_row_num long, " if row_num else ""
    lineage += "_is_synthetic boolean, _loaded_at timestamp"
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns) + ", " + lineage)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Seed (reference) table from a header CSV with an explicit schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
