"""Format comparison: the same query over a CSV copy and a Parquet copy of a
table, several trials in alternating order, results required to agree."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators.compare import compare
from strata.sources.tables import read_typed_csv, write_staging_csv


class ResultChanged(AssertionError):
    pass


def compare_formats(spark: SparkSession, df: DataFrame, schema: T.StructType,
                    query: Callable[[DataFrame], DataFrame], root: str, trials: int = 3):
    """Write ``df`` as CSV and Parquet under ``root``, run ``query`` on each
    copy ``trials`` times (odd trials CSV first, even trials Parquet first),
    check the results are identical, and return
    ``(result_df_from_csv, {format: [seconds per trial]}, sizes)``."""
    csv_path, pq_path = f"{root.rstrip('/')}/csv", f"{root.rstrip('/')}/parquet"
    write_staging_csv(df.select(*schema.fieldNames()), csv_path)
    df.select(*schema.fieldNames()).write.mode("overwrite").parquet(pq_path)
    views = {"csv": lambda: read_typed_csv(spark, csv_path, schema),
             "parquet": lambda: spark.read.parquet(pq_path)}
    timings: dict[str, list[float]] = {"csv": [], "parquet": []}
    for trial in range(1, trials + 1):
        order = ("csv", "parquet") if trial % 2 else ("parquet", "csv")
        for fmt in order:
            t0 = time.perf_counter()
            query(views[fmt]()).write.format("noop").mode("overwrite").save()
            timings[fmt].append(time.perf_counter() - t0)
    verdict = compare(query(views["csv"]()), query(views["parquet"]())).first()
    if not verdict["identical"]:
        raise ResultChanged(f"CSV and Parquet results differ: {verdict.asDict()}")
    from strata.sources.files import footprint
    sizes = {f: footprint(spark, p).first()["bytes"] for f, p in (("csv", csv_path), ("parquet", pq_path))}
    return query(views["csv"]()), timings, sizes
