"""Late corrections as a stream: the incremental form of the batch late-data
path (newer ``updated`` re-classifies an old event, its day is recomputed and
republished).

Correction slices (event CSV files with the raw 22-column header) arrive in a
folder. The versions store has three tables, each with a folder per batch
(a replayed batch overwrites its own): ``versions`` by day, ``keys`` (the days
of every key, by bucket of the key's hash) and ``moved`` (the days of the few
keys that have versions on several). Each micro-batch (``foreachBatch``):

1. types the rows and writes them, with lineage, to the store under
   ``epoch=<batch id>`` (slice order = batch id + 1, after the baseline);
2. looks its keys up in their buckets of ``keys``: the days touched are all
   days on which they have a version, so an event moved between days updates
   both;
3. reads the versions of the touched days, and from other days those of keys
   that ``moved`` lists for a touched day; ranks them, once, rebuilds latest ->
   fact -> mart of the touched days and publishes each contiguous run of days
   as a window. A batch whose publications are all in the log is not applied
   again.

So a batch reads the buckets of its keys and the days it touches, by folder,
however large the store is.

No watermark is used: a correction may arrive months late and must never be
dropped; the state is the versions store itself, not an in-memory aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.publish import Publisher
from strata.operators.staging import stage_versions, type_raw_events
from strata.plans.quakes import build_layers
from strata.session import checkpoint_root
from strata.sources.raw import EVENT_COLUMNS
from strata.sources.tables import by_size

# Buckets of the key index.
BUCKETS = 16
KEY_SCHEMAS = {"keys": "event_key string, event_date date, bucket int", "moved": "event_key string, event_date date"}
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in EVENT_COLUMNS])


def day_runs(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Contiguous half-open windows covering the given days."""
    out: list[tuple[dt.date, dt.date]] = []
    for d in sorted(set(days)):
        if out and out[-1][1] == d:
            out[-1] = (out[-1][0], d + dt.timedelta(days=1))
        else:
            out.append((d, d + dt.timedelta(days=1)))
    return out


class CorrectionStream:
    """``start`` streams raw correction CSV slices; ``start_typed`` streams
    Parquet files of already typed rows (with their own lineage)."""

    def __init__(self, spark: SparkSession, versions_path: str, publish_root: str,
                 history: DataFrame, classes, fact_types, source_system: str, buckets: int = BUCKETS):
        self.spark = spark
        self.versions_path = versions_path.rstrip("/")
        self.buckets = buckets
        self._schema = None         # of the versions; read from their files in a process that has written none
        self.publisher = Publisher(spark, publish_root)
        self.history = history
        self.classes = classes
        self.fact_types = fact_types
        self.source_system = source_system

    def seed(self, typed: DataFrame) -> None:
        """Initial (baseline) versions, all dates kept."""
        self._write(stage_versions(typed, None, None), -1)
        self._note_moved(self._table("keys", -1), -1)

    def _path(self, table: str, epoch_id: int | None = None) -> str:
        return f"{self.versions_path}/{table}" + ("" if epoch_id is None else f"/epoch={epoch_id}")

    def _bucket(self):
        return F.pmod(F.xxhash64("event_key"), F.lit(self.buckets)).cast("int")

    def _write(self, versions: DataFrame, epoch_id: int) -> None:
        self._schema = versions.schema
        (by_size(versions, ["event_date"]).write.mode("overwrite").partitionBy("event_date")
         .parquet(self._path("versions", epoch_id)))
        days = self._table("versions", epoch_id).filter("event_date IS NOT NULL").select("event_key", "event_date").distinct()
        (by_size(days.withColumn("bucket", self._bucket()), ["bucket"]).write.mode("overwrite").partitionBy("bucket")
         .parquet(self._path("keys", epoch_id)))

    def _table(self, table: str, epoch_id: int | None = None) -> DataFrame:
        """A table of the store, or one batch's part of it."""
        path = self._path(table, epoch_id)
        reader = self.spark.read.option("basePath", path)
        if (schema := KEY_SCHEMAS.get(table) or self._schema) is not None:
            reader = reader.schema(schema)          # no look at the files' footers
        return reader.parquet(path).drop("epoch")

    def _store(self) -> DataFrame:
        return self._table("versions")

    def _note_moved(self, days_of_keys: DataFrame, epoch_id: int) -> None:
        """Writes the keys that have versions on several days, with their days."""
        several = days_of_keys.groupBy("event_key").agg(F.collect_set("event_date").alias("days")).filter("size(days) > 1")
        several.select("event_key", F.explode("days").alias("event_date")).write.mode("overwrite").parquet(
            self._path("moved", epoch_id))

    def _days_of(self, keys: DataFrame) -> DataFrame:
        """(event_key, event_date) of all versions of ``keys``, from their buckets only."""
        buckets = [r.b for r in keys.select(self._bucket().alias("b")).distinct().collect()]      # at most self.buckets
        return self._table("keys").filter(F.col("bucket").isin(buckets)).join(
            keys, "event_key", "left_semi").select("event_key", "event_date").distinct()

    def _versions_for(self, days: list[dt.date]) -> DataFrame:
        """All versions of every key with a version on one of ``days``."""
        moved = self._table("moved").distinct()
        here = moved.filter(F.col("event_date").isin(days)).select("event_key").distinct()
        away = moved.join(here, "event_key", "left_semi").filter(~F.col("event_date").isin(days))
        others = [r.event_date for r in away.select("event_date").distinct().collect()]           # bounded by the calendar
        store = self._store()
        rows = store.filter(F.col("event_date").isin(days))
        if others:
            rows = rows.unionByName(store.filter(F.col("event_date").isin(others)).join(here, "event_key", "left_semi"))
        return rows

    def _process(self, batch: DataFrame, epoch_id: int) -> None:
        raw = batch.select(
            *EVENT_COLUMNS,
            F.lit(self.source_system).alias("_source_system"),
            F.col("_file").alias("_slice_id"),
            F.lit(epoch_id + 1).cast("int").alias("_slice_order"),
            F.monotonically_increasing_id().alias("_row_num"),
            F.lit(True).alias("_is_synthetic"))
        self._apply(stage_versions(type_raw_events(raw), None, None), epoch_id)

    def _process_typed(self, batch: DataFrame, epoch_id: int) -> None:
        self._apply(stage_versions(batch, None, None), epoch_id)

    def _apply(self, new: DataFrame, epoch_id: int) -> None:
        done = {(r["start_date"], r["end_date"]) for r in self.publisher.log().filter(
            F.col("run_id") == f"stream-{epoch_id}").collect()}
        self._write(new, epoch_id)
        touched = self._table("keys", epoch_id).select("event_key").distinct()
        day_list = f"{self._path('touched', epoch_id)}"
        self._days_of(touched).write.mode("overwrite").parquet(day_list)
        days_of_keys = self.spark.read.parquet(day_list)
        self._note_moved(days_of_keys, epoch_id)
        days = sorted(r["event_date"] for r in days_of_keys.select("event_date").distinct().collect())   # the calendar
        todo = [run for run in day_runs(days) if run not in done]
        if not todo:
            return
        typed = self._versions_for(days).drop("event_key", "event_date")
        checkpoint_root(self.spark)
        mart = build_layers(self.spark, typed, self.history, days[0], days[-1] + dt.timedelta(days=1),
                            classes=self.classes, fact_types=self.fact_types, rank_first=True).mart.checkpoint()
        for start, end in todo:
            self.publisher.publish(mart, start, end, run_id=f"stream-{epoch_id}")

    def publish_all(self, start, end, run_id: str) -> dict:
        """Build ``[start, end)`` from the whole versions store and publish it."""
        layers = build_layers(self.spark, self._store().drop("event_key", "event_date"), self.history, start, end,
                              classes=self.classes, fact_types=self.fact_types)
        return self.publisher.publish(layers.mart, start, end, run_id=run_id)

    def start_typed(self, source_dir: str, schema, checkpoint: str, available_now: bool = True):
        stream = self.spark.readStream.schema(schema).parquet(source_dir)
        writer = stream.writeStream.foreachBatch(self._process_typed).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()

    def start(self, source_dir: str, checkpoint: str, available_now: bool = True):
        stream = (self.spark.readStream.schema(RAW_SCHEMA).option("header", True)
                  .option("quote", '"').option("escape", '"').option("multiLine", True)
                  .csv(source_dir)
                  .withColumn("_file", F.col("_metadata.file_name")))
        writer = stream.writeStream.foreachBatch(self._process).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()
