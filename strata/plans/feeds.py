"""Feeds: how the driver's tables enter the reference's data model.

The reference ingests earthquake CSV slices and hourly page-view dumps, which
are not part of the test data. The registered queries run the same operators
over the driver tables, mapped as follows (all mappings are plain
projections, so every query reads whole tables and its work grows with them):

* ``events`` is an event slice of source system ``events``:
  ``event_id -> event_id`` (text), ``ts -> event_ts`` (and ``updated_ts``),
  ``value -> magnitude``, ``props.k -> depth_km``, ``user_id -> net``,
  ``event_type -> event_type``; status ``reviewed``. Fact events are the
  business types ``purchase``, ``click`` and ``view``.
* the SCD2 network history is derived from ``events``: each user has a
  ``visitor`` version until the first ``signup`` and a ``member`` version
  from it (half-open), or a single ``visitor`` version.
* magnitude bands become seven value bands (``VALUE_CLASSES``).
* page views are ``lineitem`` rows: title = name of the line's part,
  views = quantity; the namespace is the leading word of the title when it
  is a known word.
* record versions are ``lineitem`` rows sharing (l_orderkey, l_linenumber),
  the newest by ship date.
* the document quality profile runs on ``documents`` (domain = ``lang``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dims import OPEN_END
from strata.operators.staging import NUMERIC

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

EVENTS_SOURCE = "events"

# Fixed values of the driver-table mapping.
# Value bands (class_key, class_name, min, max), half-open [min, max).
VALUE_CLASSES = [
    (1, "micro", 0, 1),
    (2, "minor", 1, 10),
    (3, "light", 10, 50),
    (4, "moderate", 50, 100),
    (5, "strong", 100, 200),
    (6, "major", 200, 400),
    (7, "great", 400, 1000),
]
# Business event types kept in the fact, and all accepted event types.
FACT_TYPES = ("purchase", "click", "view")
EVENT_TYPES = ("signup", "purchase", "click", "view", "error")
STATUSES = ("reviewed", "automatic")
# Range test bounds for value and depth (inclusive).
VALUE_RANGE = (0, 1000)
DEPTH_RANGE = (0, 100)
# Known leading words of part names (namespace classification), their
# pattern, the default class, and a partial lookup of content groups.
KNOWN_WORDS = ("blue", "cold", "hot", "red")
WORD_PATTERN = r"^([A-Za-z_]+) "
DEFAULT_CLASS = "(article)"
WORD_GROUPS = [("(article)", "Main"), ("blue", "Colour"), ("red", "Colour"), ("hot", "Temperature")]
UNMATCHED_GROUP = "Unmatched"
# Page-view quality rules on documents: accepted language.
DOC_LANG = "en"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_typed(events: DataFrame, source_system: str = EVENTS_SOURCE,
                 slice_id: str = "baseline", slice_order: int = 0,
                 synthetic: bool = False) -> DataFrame:
    """``events`` as a typed event slice with lineage (see module doc)."""
    return events.select(
        F.lit(source_system).alias("source_system"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("event_ts"),
        F.col("ts").alias("updated_ts"),
        F.lit(None).cast(NUMERIC).alias("latitude"),
        F.lit(None).cast(NUMERIC).alias("longitude"),
        F.get_json_object("props", "$.k").cast(NUMERIC).alias("depth_km"),
        F.col("value").cast(NUMERIC).alias("magnitude"),
        F.lit(None).cast("string").alias("mag_type"),
        F.col("user_id").cast("string").alias("net"),
        F.col("event_type"),
        F.lit("reviewed").alias("status"),
        F.col("props").alias("place"),
        F.lit(slice_id).alias("_slice_id"),
        F.lit(slice_order).cast("int").alias("_slice_order"),
        (F.col("event_id") + 1).cast("long").alias("_row_num"),
        F.lit(synthetic).alias("_is_synthetic"),
    )


def event_bounds(events: DataFrame) -> tuple[str, str]:
    """Half-open window of days that holds every event (one row is read back)."""
    row = events.agg(F.min(F.to_date("ts")).alias("s"), F.date_add(F.max(F.to_date("ts")), 1).alias("e")).first()
    return (row.s.isoformat(), row.e.isoformat()) if row.s else ("1970-01-01", "1970-01-01")


def user_history(events: DataFrame, source_system: str = EVENTS_SOURCE) -> DataFrame:
    """SCD2 history per user from ``events`` (see module doc).

    One partial aggregate (first signup per user) and an ``explode`` of one
    or two versions: the history is never ordered inside a user group."""
    ts_type = events.schema["ts"].dataType
    start = F.lit("1900-01-01 00:00:00").cast(ts_type)
    end = F.lit(OPEN_END).cast(ts_type)
    first = events.groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("fs"))
    name = lambda kind: F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" " + kind))
    visitor = F.struct(name("visitor").alias("network_name"), start.alias("valid_from"),
                       F.coalesce(F.col("fs"), end).alias("valid_to"))
    member = F.struct(name("member").alias("network_name"), F.col("fs").alias("valid_from"),
                      end.alias("valid_to"))
    versions = F.when(F.col("fs").isNull(), F.array(visitor)).otherwise(F.array(visitor, member))
    return first.select(
        F.lit(source_system).alias("source_system"),
        F.col("user_id").cast("string").alias("net"),
        F.explode(versions).alias("v"),
    ).select("source_system", "net", "v.network_name", "v.valid_from", "v.valid_to",
             F.lit(False).alias("_is_synthetic"))


def page_rows(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Page-view rows: one per line item, title from the part name."""
    p = part.select(F.col("p_partkey"), F.col("p_name").alias("page_title"))
    return (lineitem.select("l_partkey", F.col("l_quantity").cast("int").alias("count_views"))
            .join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
            .select("page_title", "count_views", "l_partkey"))
