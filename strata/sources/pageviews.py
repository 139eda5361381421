"""Hourly page-view dumps: space-separated text, no header, date and hour
only in the file name (``pageviews-YYYYMMDD-HHmmss[.gz]``).

``read_pageviews`` keeps lines with exactly four fields and the wanted
domain, attaches ``event_date``/``event_hour`` parsed from the file name and
enforces strict UTF-8 (a line that is not valid UTF-8 fails the read, or is
quarantined). A gzip file is decoded by one task; ``partitions`` deals the
decoded rows out again where few large files feed heavy stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The dump line format and the file-name pattern.
FIELD_SEP = " "
N_FIELDS = 4
FILE_PATTERN = r"pageviews-(\d{8})-(\d{2})"

STAGING_SCHEMA = T.StructType([
    T.StructField("domain_code", T.StringType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("count_views", T.IntegerType()),
    T.StructField("total_response_size", T.IntegerType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("event_hour", T.IntegerType()),
])


class InvalidUtf8(ValueError):
    pass


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def read_pageviews(spark: SparkSession, path: str, domain: str = "en",
                   strict_utf8: str = "fail", partitions: int | None = None) -> DataFrame:
    """Dump lines -> ``STAGING_SCHEMA`` rows (as text fields cast later).

    ``strict_utf8``: ``"fail"`` aborts the job at the first line that is not
    valid UTF-8 (``raise_error`` inside the same single pass over the dump: no
    pre-scan of the input), ``"drop"`` quarantines such lines (see
    ``invalid_lines``), ``"off"`` keeps them."""
    lines = _lines(spark, path)
    if strict_utf8 == "fail":
        msg = F.concat(F.lit(f"{InvalidUtf8.__name__}: line is not valid UTF-8 in "), F.col("file_name"))
        lines = lines.withColumn("value", F.when(F.is_valid_utf8("value"), F.col("value"))
                                 .otherwise(F.raise_error(msg)))
    elif strict_utf8 == "drop":
        lines = lines.filter(F.is_valid_utf8("value"))
    parts = F.split(F.col("value"), FIELD_SEP, -1)
    name = F.col("file_name")
    out = (lines.withColumn("_p", parts)
           .filter((F.size("_p") == N_FIELDS) & (F.col("_p")[0] == domain))
           .select(
               F.col("_p")[0].alias("domain_code"),
               F.col("_p")[1].alias("page_title"),
               F.col("_p")[2].alias("count_views"),
               F.col("_p")[3].alias("total_response_size"),
               F.to_date(F.regexp_extract(name, FILE_PATTERN, 1), "yyyyMMdd").alias("event_date"),
               F.regexp_extract(name, FILE_PATTERN, 2).cast("int").alias("event_hour"),
               name.alias("file_name"),
           ))
    if partitions:
        out = out.repartition(partitions)
    return out


def invalid_lines(spark: SparkSession, path: str) -> DataFrame:
    """Quarantine view: lines that are not valid UTF-8, with their file."""
    return _lines(spark, path).filter(~F.is_valid_utf8("value"))


def kept_per_file(rows: DataFrame) -> DataFrame:
    """Kept rows per file plus a grand total row (``file_name`` NULL)."""
    return rows.rollup("file_name").agg(F.count(F.lit(1)).alias("rows"))
