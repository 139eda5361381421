"""Delta scenarios: a baseline slice plus one synthetic delta slice.

The reference builds five deltas from its baseline file (a redelivery, a late
correction, a second source, a corrupt row, an overlapping network version).
Here each delta is a whole-table transform of ``events`` so that its size
grows with the data:

* ``dup``      every ``purchase`` event delivered again (slice 1)
* ``late``     every ``click`` event corrected: value + 50, updated 2024-03-01
* ``source_b`` every ``view`` event also sent by source ``mirror``, with the
               mirror's own network history
* ``corrupt``  every ``error`` event re-keyed ``corrupt_<id>``, typed
               ``purchase``, value + 1000 (outside every band and range)
* ``overlap``  a second ``renamed`` version for every user from 2024-01-15,
               overlapping the open-ended version
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dims import OPEN_END
from strata.plans import feeds as fd

# Fixed values of the scenarios.
CASES = ("dup", "late", "source_b", "corrupt", "overlap")
LATE_DELTA = 50
LATE_UPDATED = "2024-03-01 00:00:00"
MIRROR_SOURCE = "mirror"
CORRUPT_DELTA = 1000
OVERLAP_FROM = "2024-01-15 00:00:00"


def late_delta(events: DataFrame) -> DataFrame:
    """The late-correction slice alone (typed, slice order 1)."""
    ts_type = events.schema["ts"].dataType
    fixed = events.filter(F.col("event_type") == "click").withColumn("value", F.col("value") + LATE_DELTA)
    return (fd.events_typed(fixed, slice_id="late", slice_order=1, synthetic=True)
            .withColumn("updated_ts", F.lit(LATE_UPDATED).cast(ts_type)))


def moved_delta(events: DataFrame) -> DataFrame:
    """Corrections that move every ``click`` event three days on, as far as
    the last day of ``events`` allows (typed, slice order 1)."""
    ts_type = events.schema["ts"].dataType
    last = F.lit(events.agg(F.max(F.to_date("ts"))).first()[0])
    later = F.when(F.date_add(F.to_date("ts"), 3) <= last, F.col("ts") + F.expr("INTERVAL 3 DAYS")).otherwise(F.col("ts"))
    moved = events.filter(F.col("event_type") == "click").withColumn("ts", later.cast(ts_type))
    return (fd.events_typed(moved, slice_id="moved", slice_order=1, synthetic=True)
            .withColumn("updated_ts", F.lit(LATE_UPDATED).cast(ts_type)))


def make_case(events: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``(typed_events, network_history)`` for the baseline plus one delta."""
    base = fd.events_typed(events)
    hist = fd.user_history(events)
    if name == "baseline":
        return base, hist
    ts_type = events.schema["ts"].dataType
    if name == "dup":
        delta = fd.events_typed(events.filter(F.col("event_type") == "purchase"),
                                slice_id="dup", slice_order=1, synthetic=True)
        return base.unionByName(delta), hist
    if name == "late":
        return base.unionByName(late_delta(events)), hist
    if name == "source_b":
        delta = fd.events_typed(events.filter(F.col("event_type") == "view"), source_system=MIRROR_SOURCE,
                                slice_id="source_b", slice_order=1, synthetic=True)
        return base.unionByName(delta), hist.unionByName(fd.user_history(events, MIRROR_SOURCE)
                                                         .withColumn("_is_synthetic", F.lit(True)))
    if name == "corrupt":
        bad = (events.filter(F.col("event_type") == "error")
               .withColumn("value", F.col("value") + CORRUPT_DELTA)
               .withColumn("event_type", F.lit("purchase")))
        delta = (fd.events_typed(bad, slice_id="corrupt", slice_order=1, synthetic=True)
                 .withColumn("event_id", F.concat(F.lit("corrupt_"), F.col("event_id"))))
        return base.unionByName(delta), hist
    if name == "overlap":
        extra = (events.select("user_id").distinct().select(
            F.lit(fd.EVENTS_SOURCE).alias("source_system"),
            F.col("user_id").cast("string").alias("net"),
            F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" renamed")).alias("network_name"),
            F.lit(OVERLAP_FROM).cast(ts_type).alias("valid_from"),
            F.lit(OPEN_END).cast(ts_type).alias("valid_to"),
            F.lit(True).alias("_is_synthetic")))
        return base, hist.unionByName(extra)
    raise ValueError(f"unknown case {name!r}; known: baseline, {', '.join(CASES)}")
