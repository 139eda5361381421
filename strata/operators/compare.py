"""Table comparison: set and multiset differences, checksums, verdicts,
labelled differences and named QA snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import row_digest
from strata.session import checkpoint_root

# Hash buckets per part of a digest comparison; changed parts that are listed in a filter.
BUCKETS = 64
LISTED_PARTS = 1000


def _aligned(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    cols = sorted(a.columns)
    if sorted(b.columns) != cols:
        raise ValueError(f"column sets differ: {a.columns} vs {b.columns}")
    return a.select(*cols), b.select(*cols)


def _counted(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of both tables with their numbers ``_na`` and ``_nb``: one
    union and one aggregation answer every comparison."""
    a, b = _aligned(a, b)
    side = lambda df, na, nb: df.select("*", F.lit(na).cast("long").alias("_na"), F.lit(nb).cast("long").alias("_nb"))
    return (side(a, 1, 0).unionByName(side(b, 0, 1)).groupBy(*a.columns)
            .agg(F.sum("_na").alias("_na"), F.sum("_nb").alias("_nb")))


def table_diff(a: DataFrame, b: DataFrame, multiset: bool = False) -> DataFrame:
    """``only_in_a``, ``only_in_b`` row counts (``EXCEPT``; with ``multiset``
    ``EXCEPT ALL``, which also sees differing multiplicities)."""
    more = lambda x, y: (F.coalesce(F.sum(F.greatest(F.col(x) - F.col(y), F.lit(0))), F.lit(0)) if multiset
                         else F.count_if((F.col(x) > 0) & (F.col(y) == 0)))
    return _counted(a, b).agg(more("_na", "_nb").cast("long").alias("only_in_a"),
                              more("_nb", "_na").cast("long").alias("only_in_b"))


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """One-row verdict: both set differences, row counts, checksums and
    ``identical`` (both differences empty, counts and checksums equal)."""
    rows = _counted(a, b).withColumn("_digest", row_digest(sorted(a.columns)))
    only = lambda x, y: F.count_if((F.col(x) > 0) & (F.col(y) == 0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    # A digest has 60 bits and a count 63: their product fits 38 digits.
    digest = lambda n: F.coalesce(F.sum((F.col("_digest").cast("decimal(19,0)") * F.col(n).cast("decimal(19,0)"))
                                        .cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    checksum = lambda n: F.concat_ws(":", total(n).cast("string"), digest(n).cast("string"))
    out = rows.agg(only("_na", "_nb").alias("only_in_a"), only("_nb", "_na").alias("only_in_b"),
                   total("_na").alias("rows_a"), checksum("_na").alias("checksum_a"),
                   total("_nb").alias("rows_b"), checksum("_nb").alias("checksum_b"))
    return out.withColumn("identical", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0)
                          & (F.col("rows_a") == F.col("rows_b")) & (F.col("checksum_a") == F.col("checksum_b")))


def labelled_diff(a: DataFrame, b: DataFrame, label_a: str = "a", label_b: str = "b",
                  src: str = "src") -> DataFrame:
    """Rows of ``a`` not in ``b`` and vice versa (``EXCEPT ALL``), labelled."""
    cols = sorted(a.columns)
    diff = _counted(a, b).filter("_na <> _nb")
    extra = F.abs(F.col("_na") - F.col("_nb")).cast("int")
    return diff.select(F.when(F.col("_na") > F.col("_nb"), label_a).otherwise(label_b).alias(src), *cols,
                       F.explode(F.sequence(F.lit(1), extra)).alias("_copy")).drop("_copy")


def changed_parts(a: DataFrame, b: DataFrame, part: str, buckets: int = BUCKETS) -> DataFrame:
    """(part, ``_bucket``): parts of two tables, split into hash buckets of
    whole rows, whose row counts or digest sums differ. Equal buckets hold
    equal rows (up to collisions of the sums of 60-bit digests); one
    aggregation per table, a row per part and bucket leaves a task."""
    a, b = _aligned(a, b)
    cols = a.columns
    def digests(df, sign):
        return (df.select(F.col(part), _bucket(cols, buckets).alias("_bucket"), row_digest(cols).alias("_d"))
                .groupBy(part, "_bucket")
                .agg((F.count(F.lit(1)) * sign).alias("_n"),
                     (F.sum(F.col("_d").cast("decimal(28,0)")) * sign).cast("decimal(38,0)").alias("_d")))
    both = digests(a, 1).unionByName(digests(b, -1)).groupBy(part, "_bucket").agg(F.sum("_n").alias("_n"), F.sum("_d").alias("_d"))
    return both.filter("_n <> 0 OR _d <> 0").select(part, "_bucket")


def _bucket(cols, buckets: int):
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def labelled_diff_by_part(a: DataFrame, b: DataFrame, part: str, label_a: str = "a", label_b: str = "b",
                          src: str = "src", buckets: int = BUCKETS) -> DataFrame:
    """``labelled_diff`` of two large tables that mostly agree: digests per
    ``part`` and hash bucket are compared first (``changed_parts``), and only
    rows of unequal buckets are compared row by row. Up to ``LISTED_PARTS``
    changed parts become a literal filter, which prunes the scan of a table
    that is partitioned by ``part``; more are found by the bucket join alone."""
    checkpoint_root(a.sparkSession)
    a, b = _aligned(a, b)
    changed = changed_parts(a, b, part, buckets).checkpoint()
    parts = changed.select(part).distinct().limit(LISTED_PARTS + 1).collect()
    known = [r[0] for r in parts if r[0] is not None]
    listed = F.col(part).isin(known) if known else F.lit(False)
    if len(known) < len(parts):
        listed = listed | F.col(part).isNull()
    keys = changed.select(F.col(part).alias("_part"), F.col("_bucket").alias("_in"))
    def left(df):
        df = df if len(parts) > LISTED_PARTS else df.filter(listed)
        same = df[part].eqNullSafe(F.col("_part")) & (_bucket(df.columns, buckets) == F.col("_in"))
        return df.join(keys, same, "left_semi")
    return labelled_diff(left(a), left(b), label_a, label_b, src)


def snapshot(df: DataFrame, root: str, kind: str, name: str) -> str:
    """Store a named copy ``<root>/<kind>_<name>`` (replacing an older one)."""
    path = f"{root.rstrip('/')}/{kind}_{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_snapshot(spark: SparkSession, root: str, kind: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{kind}_{name}")
