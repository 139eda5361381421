"""Writes that follow the size of the data, and checks counted by a write."""

import glob

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as dq
from strata.operators.publish import Publisher
from strata.sources.tables import RoundTripMismatch, load_slices, write_partitioned

SIZES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "8"}


@pytest.fixture()
def small_parts(spark):
    old = {k: spark.conf.get(k, None) for k in SIZES}
    for k, v in SIZES.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_days(spark):
    """Nine tenths of the rows on one day."""
    return (spark.range(0, 40_000, 1, 8).withColumn("event_date", F.when(F.col("id") % 10 > 0, F.lit("2025-01-01"))
            .otherwise(F.concat(F.lit("2025-01-1"), F.col("id") / 10 % 10 % 9).substr(1, 10)).cast("date"))
            .withColumn("payload", F.sha2(F.col("id").cast("string"), 512)))


def files(path, day):
    return glob.glob(f"{path}/event_date={day}/*.parquet")


def test_a_hot_day_has_many_writers_and_a_small_one_few(spark, workdir, small_parts):
    df = hot_days(spark)
    write_partitioned(df, workdir + "/t", "event_date")
    assert len(files(workdir + "/t", "2025-01-01")) > 4
    assert all(len(glob.glob(f + "/*.parquet")) < len(files(workdir + "/t", "2025-01-01"))
               for f in glob.glob(workdir + "/t/event_date=*") if not f.endswith("2025-01-01"))
    assert spark.read.parquet(workdir + "/t").count() == 40_000
    pub = Publisher(spark, workdir + "/p")
    got = pub.publish(df, "2025-01-01", "2025-01-02", "r")
    assert got["rows_published"] == 36_000
    assert len(files(pub.data_path + "/publish_version=1", "2025-01-01")) > 4


def test_a_large_hour_is_landed_by_many_tasks_and_counted_once(spark, workdir, small_parts):
    from strata.plans.queries_dumps import OPEN_FILES, land_dumps, q_dump_counts
    (spark.range(0, 40_000, 1, 8).select(
        (F.col("id") * 7).alias("l_orderkey"), (F.col("id") % 5000).alias("l_partkey"),
        F.when(F.col("id") % 10 == 0, 49.0).otherwise(F.col("id") % 40 + 1.0).alias("l_quantity"),
        F.lit("O").alias("l_linestatus"), F.lit("N").alias("l_returnflag")).write.parquet(workdir + "/lineitem.parquet"))
    (spark.range(5000).select(F.col("id").alias("p_partkey"), F.sha2(F.col("id").cast("string"), 512).alias("p_name"))
     .write.parquet(workdir + "/part.parquet"))
    held = spark.conf.get(OPEN_FILES)
    path = land_dumps(spark, workdir, workdir + "/landed")
    assert spark.conf.get(OPEN_FILES) == held
    assert len(glob.glob(path + "/pageviews-20240105-000000*")) > 4
    got = sorted(map(tuple, q_dump_counts(spark, workdir).collect()))
    assert got == [("0", 36_000), ("all", 36_000), ("not utf-8", 4_000)]


def test_slices_compute_their_source_once(spark, workdir):
    df = hot_days(spark)
    day = F.col("event_date")
    cut = F.lit("2025-01-05").cast("date")
    assert load_slices(df, workdir + "/a", "event_date", [day < cut, day >= cut]).count() == 40_000
    nulls = df.withColumn("event_date", F.when(F.col("id") > 5, day))
    with pytest.raises(RoundTripMismatch, match="in the slices"):
        load_slices(nulls, workdir + "/b", "event_date", [day < cut, day >= cut])
    assert not glob.glob(workdir + "/b/*")


def test_checks_counted_by_the_write(spark, workdir):
    df = spark.createDataFrame([(1, 5.0), (None, 50.0), (3, None), (4, 7.0)], "k int, m double")
    tests = [dq.not_null("t", "k"), dq.rows_where("range", "t", "m IS NULL OR m NOT BETWEEN 0 AND 9", ["k", "m"]),
             dq.unique("t", "k"), dq.not_null("other", "k")]
    watched, failures = dq.watch(df, tests, "t")
    watched.write.parquet(workdir + "/t")
    assert failures() == {"not_null_t_k": 1, "range": 2}
    t = {"t": spark.read.parquet(workdir + "/t"), "other": df.filter("k IS NOT NULL")}
    rows = dq.summary_rows(tests, t, known=failures())
    assert [(r["test_name"], r["failures"]) for r in rows] == [("not_null_t_k", 1), ("range", 2), ("unique_t_k", 0),
                                                              ("not_null_other_k", 0)]
    assert [tuple(r) for r in rows] == [tuple(r) for r in dq.summary_rows(tests, t)]
    empty, none = dq.watch(df.limit(0), tests, "t")
    empty.write.parquet(workdir + "/e")
    assert none() == {"not_null_t_k": 0, "range": 0}


def test_one_audit_table(spark, workdir):
    df = spark.createDataFrame([(1, 5.0), (1, 50.0), (None, None)], "k int, m double")
    tests = [dq.not_null("t", "k"), dq.rows_where("range", "t", "m > 9", ["m"]), dq.unique("t", "k"), dq.not_null("t", "m")]
    path = workdir + "/audit"
    paths = dq.store_failures(spark, tests, {"t": df}, path, ["not_null_t_k", "range", "unique_t_k"])
    got = sorted((r.test_name, r.row) for r in dq.read_failures(spark, path).collect())
    assert got == [("not_null_t_k", '{"k":null,"m":null}'), ("range", '{"m":50.0}'), ("unique_t_k", '{"k":1,"n_records":2}')]
    assert spark.read.parquet(paths["range"]).count() == 1
    dq.store_failures(spark, tests, {"t": df}, path, [])
    assert dq.read_failures(spark, path).count() == 0
