"""Declarative data-quality tests and the publication gate.

A test is a query returning failing rows (dbt semantics):

* ``not_null(col)``          rows where ``col`` is NULL
* ``unique(col)``            one row per duplicated non-NULL value
* ``accepted_values(col)``   one row per distinct value outside the list
                             (NULL passes)
* ``relationships(col)``     child rows whose non-NULL key has no parent
* ``rows_where(condition)``  rows of one table that meet a condition
* singular tests             any DataFrame of failing rows

``summary`` counts failures of all tests in one Spark job: checks of single
rows (NOT NULL, conditions) of the same table share one aggregate, the other
tests each add a partial aggregate, and the counts are unioned into one small
result. Checks of single rows can also be counted while their table is
written (``watch``), and then cost no scan of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import orphans

Tables = dict[str, DataFrame]


@dataclass
class DataTest:
    name: str
    table: str
    kind: str                     # not_null | unique | accepted_values | relationships | rows | singular
    column: str | None = None
    values: Sequence[str] = ()
    parent: tuple[str, str] | None = None
    query: Callable[[Tables], DataFrame] | None = field(default=None, repr=False)
    where: str | None = None      # SQL condition of a failing row
    shown: Sequence[str] = ()     # columns of failing rows that are stored
    reads: Sequence[str] = ()     # tables of a singular test, where they are known

    def ready(self, t) -> bool:
        """Whether all tables the test reads are in ``t``."""
        tables = self.reads if self.kind == "singular" else (self.table, *(self.parent or ())[:1])
        return bool(tables) and all(x in t for x in tables)

    @property
    def condition(self) -> str | None:
        """Condition that a single row fails by; None where rows must be compared."""
        return f"`{self.column}` IS NULL" if self.kind == "not_null" else self.where

    def failing_rows(self, t: Tables) -> DataFrame:
        df = t[self.table] if self.table in t else None
        if self.condition is not None:
            return df.filter(self.condition).select(*(self.shown or df.columns))
        if self.kind == "unique":
            return (df.filter(F.col(self.column).isNotNull())
                    .groupBy(self.column).agg(F.count(F.lit(1)).alias("n_records"))
                    .filter(F.col("n_records") > 1))
        if self.kind == "accepted_values":
            return (df.filter(~F.col(self.column).isin(list(self.values)))
                    .groupBy(self.column).agg(F.count(F.lit(1)).alias("n_records")))
        if self.kind == "relationships":
            ptable, pcol = self.parent
            return orphans(df, self.column, t[ptable], pcol)
        if self.kind == "singular":
            return self.query(t)
        raise ValueError(self.kind)


def not_null(table, column):
    return DataTest(f"not_null_{table}_{column}", table, "not_null", column)


def unique(table, column):
    return DataTest(f"unique_{table}_{column}", table, "unique", column)


def accepted_values(table, column, values):
    return DataTest(f"accepted_values_{table}_{column}", table, "accepted_values", column, tuple(values))


def relationships(table, column, parent_table, parent_column):
    return DataTest(f"relationships_{table}_{column}__{parent_table}", table, "relationships", column,
                    parent=(parent_table, parent_column))


def rows_where(name, table, condition, shown=()):
    return DataTest(name, table, "rows", where=condition, shown=tuple(shown))


def singular(name, query, table="", reads=()):
    return DataTest(name, table, "singular", query=query, reads=tuple(reads))


def summary(tests: Sequence[DataTest], t: Tables) -> DataFrame:
    """``(test_name, failures, status)`` for every test, one job."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[DataTest]] = {}
    for test in tests:
        if test.condition is not None:
            by_table.setdefault(test.table, []).append(test)
        else:
            parts.append(test.failing_rows(t).agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(test.name).alias("test_name"), "failures"))
    for table, group in by_table.items():
        counts = t[table].agg(*[F.count_if(F.expr(x.condition)).alias(f"c{i}") for i, x in enumerate(group)])
        stack = ", ".join(f"'{x.name}', c{i}" for i, x in enumerate(group))
        parts.append(counts.selectExpr(f"stack({len(group)}, {stack}) AS (test_name, failures)"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("test_name", F.col("failures").cast("long").alias("failures"),
                      F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))


def watch(df: DataFrame, tests: Sequence[DataTest], table: str) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df``, to be written once as ``table``, and a call that gives the
    failures of its single-row checks, counted by that write."""
    mine = [x for x in tests if x.table == table and x.condition is not None]
    if not mine:
        return df, dict
    seen = Observation()
    counted = df.observe(seen, *[F.count_if(F.expr(x.condition)).alias(f"c{i}") for i, x in enumerate(mine)])
    return counted, lambda: {x.name: seen.get[f"c{i}"] for i, x in enumerate(mine)}


SUMMARY_SCHEMA = "test_name string, failures long, status string"


def summary_rows(tests: Sequence[DataTest], t: Tables, concurrency: int = 4,
                 known: dict[str, int] | None = None) -> list:
    """Run the tests as ``concurrency`` concurrent Spark jobs and return one
    row per test (bounded: the number of tests), in the order of ``tests``.
    Tests whose failures are ``known`` are not run.

    Small test jobs leave most cores idle; running a few unions side by side
    keeps the cluster busy. Single-row checks of one table stay in the same
    group so they still share one aggregate."""
    from concurrent.futures import ThreadPoolExecutor
    known = known or {}
    found = [Row(test_name=k, failures=n, status="fail" if n else "pass") for k, n in known.items()]
    units: list[list[DataTest]] = []
    by_table: dict[str, list[DataTest]] = {}
    for test in tests:
        if test.name in known:
            continue
        if test.condition is not None:
            by_table.setdefault(test.table, []).append(test)
        else:
            units.append([test])
    units = list(by_table.values()) + units
    groups: list[list[DataTest]] = [[] for _ in range(max(1, min(concurrency, len(units))))]
    for i, unit in enumerate(units):
        groups[i % len(groups)].extend(unit)
    groups = [g for g in groups if g]
    if groups:
        with ThreadPoolExecutor(max_workers=len(groups)) as pool:
            found += [r for rows in pool.map(lambda g: summary(g, t).collect(), groups) for r in rows]
    order = {x.name: i for i, x in enumerate(tests)}
    return sorted(found, key=lambda r: order[r["test_name"]])


def summary_table(spark, tests: Sequence[DataTest], t: Tables, concurrency: int = 4,
                  known: dict[str, int] | None = None) -> DataFrame:
    """``summary_rows`` as a (small) DataFrame."""
    return spark.createDataFrame([tuple(r) for r in summary_rows(tests, t, concurrency, known)], SUMMARY_SCHEMA)


AUDIT_SCHEMA = "row string, test_name string"


def store_failures(spark: SparkSession, tests: Sequence[DataTest], t: Tables, audit_path: str,
                   failing: Sequence[str] | None = None) -> dict[str, str]:
    """Replace the audit table at ``audit_path`` by the failing rows of all
    tests, as JSON, partitioned by test: one write, however many tests fail;
    a clean run leaves an empty table. Tests known not to be ``failing`` are
    not run again. Returns the folders of the failing tests."""
    table = spark.createDataFrame([], AUDIT_SCHEMA)
    run = [x for x in tests if failing is None or x.name in failing]
    for test in run:
        rows = test.failing_rows(t)
        table = table.unionByName(rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"),
                                              F.lit(test.name).alias("test_name")))
    table.write.mode("overwrite").partitionBy("test_name").parquet(audit_path)
    return {x.name: f"{audit_path.rstrip('/')}/test_name={x.name}" for x in run}


def read_failures(spark: SparkSession, audit_path: str) -> DataFrame:
    """``(row, test_name)`` of the audit table; ``row`` is JSON."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_path)


class GateFailed(RuntimeError):
    def __init__(self, failed: dict[str, int]):
        super().__init__(f"{len(failed)} data test(s) failed: {failed}")
        self.failed = failed


def gate(summary_df: DataFrame) -> dict[str, int]:
    """Collect the (small) summary; raise ``GateFailed`` if any test failed.
    The summary has one row per test, so the collect is bounded."""
    rows = summary_df.collect()
    failed = {r["test_name"]: r["failures"] for r in rows if r["failures"]}
    if failed:
        raise GateFailed(failed)
    return {r["test_name"]: 0 for r in rows}


def trace_to_raw(failing: DataFrame, raw: DataFrame,
                 on: Sequence[tuple[str, str]] = (("source_system", "_source_system"), ("event_id", "id")),
                 lineage: Sequence[str] = ("_slice_id", "_slice_order", "_row_num", "_is_synthetic")) -> DataFrame:
    """Failing rows joined back to the raw slice rows they came from
    (source + id), with the raw lineage columns."""
    cond = None
    r = raw.select(*[F.col(rc).alias(f"_raw_{rc}") for _fc, rc in on], *lineage)
    for fc, rc in on:
        c = failing[fc] == r[f"_raw_{rc}"]
        cond = c if cond is None else cond & c
    return failing.join(r, cond, "inner").drop(*[f"_raw_{rc}" for _fc, rc in on])
