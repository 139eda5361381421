"""Registered queries over landed page-view dumps: ``lineitem`` x ``part``
written as space-separated text, files by hour, with lines of other
domains, lines of too few fields and lines that are not UTF-8."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.plans import feeds as fd
from strata.plans.queries import register
from strata.session import hadoop_path, shared_dir
from strata.sources.pageviews import invalid_lines, kept_per_file, read_pageviews
from strata.sources.tables import by_size

# The day and the hours of the landed files.
DAY, HOURS = "20240105", 7
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def land_dumps(spark: SparkSession, sf_dir: str, root: str) -> str:
    """A folder of ``pageviews-<day>-<hour>0000[-<part>]`` files."""
    li, part = fd.read_table(spark, sf_dir, "lineitem"), fd.read_table(spark, sf_dir, "part")
    names = part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    line = F.concat(
        F.when(F.col("l_linestatus") == "F", "de ").otherwise("en "), F.regexp_replace("p_name", " ", "_"), F.lit(" "),
        F.col("l_quantity").cast("int").cast("string"),
        F.when(F.col("l_returnflag") == "A", "").otherwise(" 0")).cast("binary")
    # A byte that no UTF-8 text holds, at the end of every line of 49 views.
    line = F.when(F.col("l_quantity").cast("int") == 49, F.concat(line, F.unhex(F.lit("FF")))).otherwise(line)
    rows = li.join(names, "l_partkey").select(line.cast("string").alias("value"),
                                              F.pmod("l_orderkey", F.lit(HOURS)).cast("int").alias("hour"))
    path = f"{root}/dumps"
    # Tasks follow the size of the hours, not their number: a large hour is landed as several files. A task keeps the
    # file of each hour open instead of sorting its rows by hour.
    held = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, str(HOURS + 1))
    try:
        by_size(rows, ["hour"]).write.partitionBy("hour").text(f"{root}/by-hour")
    finally:
        spark.conf.set(OPEN_FILES, held)
    fs, out = hadoop_path(spark, path)
    fs.mkdirs(out)
    for h in range(HOURS):          # a handful of files: give each its dump name
        _, folder = hadoop_path(spark, f"{root}/by-hour/hour={h}")
        if fs.exists(folder):
            for k, f in enumerate(s.getPath() for s in fs.listStatus(folder)):
                fs.rename(f, hadoop_path(spark, f"{path}/pageviews-{DAY}-{h:02d}0000{'-' + str(k) if k else ''}")[1])
    return path


_KEPT = f"""SELECT replace(p_name, ' ', '_') AS page_title, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS count_views,
  CAST(l_orderkey % {HOURS} AS INTEGER) AS event_hour
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_linestatus <> 'F' AND l_returnflag <> 'A' AND CAST(l_quantity AS INTEGER) <> 49"""


@register("dump_decoded", f"""SELECT page_title, count_views, event_hour, DATE '2024-01-05' AS event_date,
  count(*) AS lines FROM ({_KEPT}) k GROUP BY 1, 2, 3""")
def q_dump_decoded(spark, sf_dir):
    """Kept lines by title, views and hour: four fields, the wanted domain,
    valid UTF-8 (other lines quarantined), hour and day from the file name."""
    path = land_dumps(spark, sf_dir, shared_dir(spark, "dumps"))
    rows = read_pageviews(spark, path, strict_utf8="drop")
    return rows.groupBy("page_title", "count_views", "event_hour", "event_date").agg(F.count(F.lit(1)).alias("lines"))


@register("dump_counts", f"""SELECT CAST(event_hour AS VARCHAR) AS hour, count(*) AS rows FROM ({_KEPT}) k GROUP BY 1
UNION ALL SELECT 'all', count(*) FROM ({_KEPT}) k
UNION ALL SELECT 'not utf-8', count(*) FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE CAST(l_quantity AS INTEGER) = 49""")
def q_dump_counts(spark, sf_dir):
    """Kept rows per file and in all, and the quarantined lines."""
    path = land_dumps(spark, sf_dir, shared_dir(spark, "dumps"))
    kept = kept_per_file(read_pageviews(spark, path, strict_utf8="drop"))
    hour = F.regexp_extract("file_name", r"-(\d{2})0000", 1).cast("int").cast("string")
    bad = invalid_lines(spark, path).agg(F.count(F.lit(1)).alias("rows"))
    per_hour = (kept.groupBy(F.when(F.col("file_name").isNull(), "all").otherwise(hour).alias("hour"))
                .agg(F.sum("rows").alias("rows")))      # an hour may lie in several files
    return per_hour.unionByName(bad.select(F.lit("not utf-8").alias("hour"), "rows"))
