"""CSV and Parquet sinks/scans, round-trip checks, temp views, catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import shared_dir


class HeaderMismatch(ValueError):
    pass


class RoundTripMismatch(ValueError):
    pass


def write_staging_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV with RFC 4180 quoting (``"`` escaped by doubling). Many part
    files: no ``coalesce(1)``."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("nullValue", "").csv(path))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType,
                   date_format: str = "yyyy-MM-dd", multiline: bool = False) -> DataFrame:
    """CSV scan with an explicit schema: header checked against the schema
    (``enforceSchema=false``), malformed rows abort (``FAILFAST``), empty
    field = NULL, ``"`` escapes ``"``. No schema inference."""
    return (spark.read.schema(schema)
            .option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").option("nullValue", "")
            .option("quote", '"').option("escape", '"')
            .option("multiLine", multiline)
            .option("dateFormat", date_format)
            .csv(path))


def check_header(spark: SparkSession, path: str, expected: Sequence[str]) -> None:
    """Header contract: the stripped, lower-cased header of every file at
    ``path`` equals ``expected``."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"))
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("line"))
    names = F.transform(F.split(F.lower("line"), ","), lambda x: F.trim(F.regexp_replace(F.trim(x), '^"|"$', "")))
    wrong = first.select("file", names.alias("header")).filter(F.col("header") != F.array(*[F.lit(c) for c in expected]))
    bad = wrong.limit(1).collect()
    if bad:
        raise HeaderMismatch(f"{bad[0]['file']}: header {bad[0]['header']} != {list(expected)}")
    if not first.limit(1).count():
        raise HeaderMismatch(f"{path}: empty file")


# Rows of one written file, at most.
FILE_ROWS = 20_000_000


def by_size(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` dealt out for a write partitioned by ``by``: rows of a value meet
    in one shuffle partition; adaptive execution splits one whose measured
    bytes exceed the session's advisory size over as many tasks as it needs,
    and joins small ones."""
    return df.hint("rebalance", *by)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] | str, mode: str = "overwrite") -> None:
    """Snappy Parquet partitioned by low-cardinality column(s). Tasks and files
    follow the size of the data: a small value is one file, a large one many."""
    by = [by] if isinstance(by, str) else list(by)
    (by_size(df, by).write.mode(mode).option("compression", "snappy").option("maxRecordsPerFile", FILE_ROWS)
     .partitionBy(*by).parquet(path))


def assert_roundtrip(a: DataFrame, b: DataFrame, count: bool = True) -> int | None:
    """Name -> type equality ignoring column order, then equal row counts.

    Partition columns come back by directory-name inference, so a string
    partition ``01`` may return as int: this check catches it."""
    ta = {f.name: f.dataType for f in a.schema.fields}
    tb = {f.name: f.dataType for f in b.schema.fields}
    if ta != tb:
        raise RoundTripMismatch(f"schema changed: {ta} != {tb}")
    if not count:
        return None
    ca, cb = a.count(), b.count()
    if ca != cb:
        raise RoundTripMismatch(f"row count changed: {ca} != {cb}")
    return ca


def load_slices(df: DataFrame, path: str, by: str, slices: Sequence[Column]) -> DataFrame:
    """Replace the table at ``path`` by the first slice of ``df`` and append the
    others (``slices`` are disjoint conditions), then check that the table
    holds exactly the accepted rows.

    ``df`` is computed once, in a write by slice that also counts the rows;
    the table is then filled from there, slice by slice. Rows of no slice (a
    null date among them) raise before the table is touched."""
    number = F.lit(None).cast("int")
    for k in range(len(slices) - 1, -1, -1):
        number = F.when(slices[k], F.lit(k)).otherwise(number)
    spark = df.sparkSession
    held = shared_dir(spark, "slices") + "/t"
    total = Observation()
    (by_size(df.withColumn("__slice", number).observe(total, F.count(F.lit(1)).alias("accepted"),
                                                      F.count("__slice").alias("taken")), ["__slice", by])
     .write.partitionBy("__slice").parquet(held))
    accepted, taken = total.get["accepted"], total.get["taken"]
    if taken != accepted:
        raise RoundTripMismatch(f"{taken} rows in the slices, {accepted} accepted")
    stored = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__slice", T.IntegerType())])).parquet(held)
    for k in range(len(slices)):
        write_partitioned(stored.filter(F.col("__slice") == k).drop("__slice"), path, by, mode="append" if k else "overwrite")
    table = spark.read.schema(df.schema).parquet(path)
    if (final := table.count()) != accepted:
        raise RoundTripMismatch(f"{final} rows in the table, {accepted} accepted")
    return table


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def sql_on_files(spark: SparkSession, fmt: str, path: str, where: str | None = None) -> DataFrame:
    """Direct-file SQL: ``SELECT * FROM parquet.`path` [WHERE ...]``."""
    text = f"SELECT * FROM {fmt}.`{path}`"
    return spark.sql(text + (f" WHERE {where}" if where else ""))


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the catalog's tables and views."""
    return sorted(t.name for t in spark.catalog.listTables(database))


def table_exists(spark: SparkSession, name: str, database: str | None = None) -> bool:
    return spark.catalog.tableExists(f"{database}.{name}" if database else name)


def ensure_database(spark: SparkSession, name: str) -> bool:
    """``CREATE DATABASE IF NOT EXISTS``; returns whether it existed."""
    existed = spark.catalog.databaseExists(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return existed


def literal_lookup(spark: SparkSession, name: str, rows, schema: str) -> DataFrame:
    """Drop-and-recreate a small literal lookup as a temp view (``VALUES``)."""
    spark.catalog.dropTempView(name)
    df = spark.createDataFrame(list(rows), schema)
    df.createOrReplaceTempView(name)
    return df
