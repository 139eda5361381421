"""Window-replace publication with a publication log.

A published table is a set of immutable per-version, per-day folders plus an
append-only log; the log row is written last, so a failed run leaves at most
an orphan folder and no visible change (readers resolve every day's live
version from the log). One writer is assumed.

``publish_window``: the live table after a publication = rows of the previous
state outside ``[start, end)`` plus candidate rows inside it. Dynamic
partition overwrite alone would be wrong: days missing from the candidate
would stay behind.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from strata.functions import in_window
from strata.operators.aggregates import table_checksum
from strata.session import hadoop_path, path_exists
from strata.sources.tables import FILE_ROWS, by_size

VERSION_COL = "publish_version"
LOG_SCHEMA = ("run_id string, start_date date, end_date date, rows_published long, "
              "checksum string, version int, published_at timestamp, schema_json string")


def publish_window(candidate: DataFrame, target: DataFrame | None, start, end,
                   date_col: str = "event_date") -> DataFrame:
    """Pure form of the publication: the content of the new version."""
    inside = candidate.filter(in_window(date_col, start, end))
    if target is None:
        return inside
    outside = target.filter(~in_window(date_col, start, end))
    return outside.unionByName(inside)


def reprocess_window(day, lookback_days: int = 3) -> tuple[dt.date, dt.date]:
    """Trailing window ``[day - lookback, day + 1)``."""
    d = dt.date.fromisoformat(str(day))
    return d - dt.timedelta(days=lookback_days), d + dt.timedelta(days=1)


class SchemaDrift(RuntimeError):
    pass


class Publisher:
    """Versioned, log-driven publication target under ``root``.

    Copy-on-write per day: publication ``v`` writes only the candidate rows of
    its window to ``data/publish_version=<v>/<date_col>=<day>``. The live content of a day
    is the data of the newest version whose window covers that day (a day in
    a window without candidate rows is therefore deleted). Publishing a
    window costs the window, not the whole table. The log row is written last
    and is what makes a version visible."""

    def __init__(self, spark: SparkSession, root: str, date_col: str = "event_date"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.date_col = date_col

    @property
    def log_path(self) -> str:
        return f"{self.root}/_publication_log"

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    def _log_rows(self) -> list:
        """All log rows (one per publication). Only a missing log is an empty
        one; a log that cannot be read raises."""
        if not path_exists(self.spark, self.log_path):
            return []
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path).collect()

    def log(self, rows: list | None = None) -> DataFrame:
        """The publication log as of now, pinned: one row per publication, so
        a later publication cannot change a result computed from it."""
        rows = self._log_rows() if rows is None else rows
        return self.spark.createDataFrame(rows, LOG_SCHEMA)

    def live_version(self) -> int | None:
        return max((r["version"] for r in self._log_rows()), default=None)

    @staticmethod
    def _live_parts(rows: list) -> dict[int, list[tuple[dt.date, dt.date]]]:
        """Half-open day ranges of each version that later windows left live."""
        live: dict[int, list[tuple[dt.date, dt.date]]] = {}
        for r in sorted(rows, key=lambda r: r["version"]):
            lo, hi = r["start_date"], r["end_date"]
            for v, parts in live.items():
                live[v] = [p for s, e in parts for p in ((s, min(e, lo)), (max(s, hi), e)) if p[0] < p[1]]
            live[r["version"]] = [(lo, hi)]
        return {v: parts for v, parts in live.items() if parts}

    def live(self, rows: list | None = None) -> DataFrame | None:
        """The published table; None before the first publication. Versions and
        days are plain predicates on partition columns, so only live folders
        are listed and read."""
        rows = self._log_rows() if rows is None else rows
        if not rows:
            return None
        schema = StructType.fromJson(json.loads(max(rows, key=lambda r: r["version"])["schema_json"]))
        date = F.col(self.date_col)
        keep = F.lit(False)
        for v, parts in self._live_parts(rows).items():
            days = F.lit(False)
            for s, e in parts:
                days = days | ((date >= F.lit(s)) & (date < F.lit(e)))
            keep = keep | ((F.col(VERSION_COL) == v) & days)
        full = StructType([*schema.fields, StructField(VERSION_COL, IntegerType())])
        return (self.spark.read.schema(full).option("basePath", self.data_path).parquet(self.data_path)
                .filter(keep).select(*schema.fieldNames()))

    def _next_version(self, rows: list) -> int:
        """One more than any version logged or left behind by a failed run."""
        used = [r["version"] for r in rows]
        fs, path = hadoop_path(self.spark, self.data_path)
        if fs.exists(path):
            used += [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(path)
                     if f.getPath().getName().startswith(f"{VERSION_COL}=")]
        return max(used, default=0) + 1

    def publish(self, candidate: DataFrame, start, end, run_id: str) -> dict:
        rows = self._log_rows()
        if rows:
            want = StructType.fromJson(json.loads(max(rows, key=lambda r: r["version"])["schema_json"]))
            types = lambda schema: {f.name: f.dataType for f in schema.fields}
            if types(want) != types(candidate.schema):
                raise SchemaDrift(f"candidate schema {types(candidate.schema)} differs from published {types(want)}")
            candidate = candidate.select(*want.fieldNames())
        version = self._next_version(rows)
        path = f"{self.data_path}/{VERSION_COL}={version}"
        inside = candidate.filter(in_window(self.date_col, start, end))
        # Files per day follow the day's size, not the number of tasks.
        (by_size(inside, [self.date_col]).write.mode("errorifexists").option("maxRecordsPerFile", FILE_ROWS)
         .partitionBy(self.date_col).parquet(path))
        # Checksum of the rows as written (a compact re-read instead of
        # recomputing a lazy candidate); the explicit schema makes an empty
        # window read as an empty table.
        written = self.spark.read.schema(inside.schema).option("basePath", path).parquet(path)
        stats = table_checksum(written.select(*candidate.columns)).first()
        row = (run_id, dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end)),
               int(stats["rows"]), stats["checksum"], version, dt.datetime.now(dt.timezone.utc),
               candidate.schema.json())
        (self.spark.createDataFrame([row], LOG_SCHEMA)
         .coalesce(1).write.mode("append").parquet(self.log_path))
        return dict(zip(["run_id", "start_date", "end_date", "rows_published", "checksum",
                         "version", "published_at"], row))

    def last_publication(self, run_id: str) -> DataFrame:
        """Latest log row of a run (by version); empty for an unknown run."""
        return self.log().filter(F.col("run_id") == run_id).orderBy(F.desc("version")).limit(1)
