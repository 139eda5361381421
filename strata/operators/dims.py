"""Dimensions: SCD2 network history, magnitude bands, calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import surrogate_key, ts_text
from strata.operators.ordered import by_range, running

# Magnitude classes of the reference seed
# (class_key, class_name, mag_min, mag_max), half-open [min, max).
MAGNITUDE_CLASSES = [
    (1, "micro", -10, 2),
    (2, "minor", 2, 4),
    (3, "light", 4, 5),
    (4, "moderate", 5, 6),
    (5, "strong", 6, 7),
    (6, "major", 7, 8),
    (7, "great", 8, 11),
]

# Open end of a current SCD2 version.
OPEN_END = "9999-12-31"

CLASS_SCHEMA = T.StructType([
    T.StructField("class_key", T.IntegerType(), False),
    T.StructField("class_name", T.StringType(), False),
    T.StructField("mag_min", T.DecimalType(18, 6), False),
    T.StructField("mag_max", T.DecimalType(18, 6), False),
])


def class_dim(spark: SparkSession, classes: Sequence[tuple] = MAGNITUDE_CLASSES) -> DataFrame:
    """Type-0 band dimension from a literal seed (bounded, broadcastable)."""
    from decimal import Decimal
    rows = [(int(k), str(n), Decimal(str(lo)), Decimal(str(hi))) for k, n, lo, hi in classes]
    return spark.createDataFrame(rows, CLASS_SCHEMA).coalesce(1)


def network_dim(history: DataFrame) -> DataFrame:
    """SCD2 network dimension from a staged history
    (source_system, net, network_name, valid_from, valid_to).

    ``network_key = md5(source|net|valid_from)`` with a fixed, zone-free text
    form of ``valid_from``; ``is_current = valid_to >= 9999-12-31``."""
    open_end = F.lit(OPEN_END).cast(history.schema["valid_to"].dataType)
    return history.select(
        surrogate_key("source_system", "net", ts_text("valid_from")).alias("network_key"),
        "source_system", "net", "network_name", "valid_from", "valid_to",
        (F.col("valid_to") >= open_end).alias("is_current"),
    )


def history_from_changes(changes: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """SCD2 versions from state changes (one per key and time): ``changes``
    with ``valid_from`` (its ``ts``) and ``valid_to``, the next change of the
    key or the open end. A key with a huge history spans many tasks; changes
    without a key or a time are left out."""
    known = F.forall(F.array(*[F.col(c).isNotNull() for c in (*keys, ts)]), lambda x: x)
    back = changes.filter(known).withColumn("_back", -F.unix_micros(F.col(ts).cast("timestamp")))
    rows = running(by_range(back, keys, ["_back"]), keys, ["_back"], F.col(ts), "last", "_next", before=True)
    end = F.lit(OPEN_END).cast(changes.schema[ts].dataType)
    return (rows.withColumn("valid_from", F.col(ts)).withColumn("valid_to", F.coalesce("_next", end))
            .drop("_back", "_next"))


def stage_network_history(raw_history: DataFrame) -> DataFrame:
    """Raw all-text history -> typed (valid_from/valid_to are UTC instants)."""
    return raw_history.select(
        F.col("_source_system").alias("source_system"),
        "net", "network_name",
        F.to_timestamp("valid_from").alias("valid_from"),
        F.to_timestamp("valid_to").alias("valid_to"),
        "_is_synthetic",
    )


def calendar_columns(day: Column) -> list[Column]:
    return [
        day.alias("date_key"),
        (F.weekday(day) + 1).cast("int").alias("iso_weekday"),
        F.date_format(day, "E").alias("weekday_name"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
    ]


def calendar(spark: SparkSession, start, end) -> DataFrame:
    """Calendar rows for ``[start, end)``: date, ISO weekday, ``Dy`` name,
    year, month. Generated by ``sequence`` + ``explode``: no driver loop."""
    bounds = spark.range(1).select(F.to_date(F.lit(str(start))).alias("s"),
                                   F.to_date(F.lit(str(end))).alias("e"))
    return calendar_from_bounds(bounds, "s", "e")


def calendar_from_bounds(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Calendar for ``[start, end)`` read from a one-row DataFrame, so the range
    can come from data (``min``/``max`` of a date column) inside the plan."""
    day = F.explode(F.sequence(F.col(start_col), F.date_sub(F.col(end_col), 1),
                               F.expr("INTERVAL 1 DAY")))
    return (bounds.filter(F.col(end_col) > F.col(start_col))
            .select(day.alias("d")).select(*calendar_columns(F.col("d"))))
