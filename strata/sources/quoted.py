"""Quoted CSV files read by many tasks.

A quoted field may hold line feeds, so whether a line begins inside a field
depends on all lines before it. A file is read as lines, in the splits that
Spark deals out, and twice:

1. every split is a function of the state it begins in (outside or inside a
   quoted field), worked out for both states at once; a prefix over a file's
   splits, one row per split, then gives the state each really begins in;
2. every task joins its lines to records. What a split begins inside of and
   what it leaves open are pieces; the pieces of a record, from two splits or
   more, are put together by its first split.

Records are parsed by Spark's CSV expression, malformed ones abort. A record's
number is its file's rank by name and its place in the file, so numbers grow
within a file however it is split. Lines end with LF or CRLF; a quoted field
begins and ends at a comma or line end, ``"`` within it is doubled; a quote
elsewhere is an ordinary character. Empty lines between records are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import shared_dir
from strata.sources.tables import HeaderMismatch

# A file's records are numbered within this many bytes.
FILE_BITS = 44


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_path").alias("name"), "value")


def _stepper():
    """State after a line. A function made here travels with its task, which needs no module of this package."""
    import re
    inner = r'[^"]*+(?:""[^"]*+)*+'
    closes = re.compile(inner + r'"(?!")')
    field = re.compile(r'(?:[^",][^,]*+)?+(?:,|$)')

    def step(line: str, inside: bool) -> bool:
        at = 0
        if inside or line.startswith('"'):
            if '"' not in line:
                return True
            at = 0 if inside else 1
        elif '"' not in line:
            return False
        quoted = inside or at == 1
        while True:
            if quoted:
                m = closes.match(line, at)
                if m is None:
                    return True
                comma = line.find(",", m.end())
                if comma < 0:
                    return False
                at = comma + 1
            else:
                m = field.match(line, at)
                if m is None or m.end() >= len(line):
                    return False
                at = m.end()
            quoted = line.startswith('"', at)
            at += quoted
    return step


def _scan_task(step):
    def run(batches):
        key, state, head, name = None, None, None, None

        def row():
            return pa.RecordBatch.from_pylist([{"file": key[0], "start": key[1], "name": name, "from_out": state[0],
                                                "from_in": state[1], "head": head if key[1] == 0 else None}], schema)
        schema = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("name", pa.string()),
                            ("from_out", pa.bool_()), ("from_in", pa.bool_()), ("head", pa.string())])
        for b in batches:
            files, starts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, line in enumerate(b.column(3).to_pylist()):
                if key != (files[i], starts[i]):
                    if key is not None:
                        yield row()
                    key, state, head, name, first = (files[i], starts[i]), (False, True), "", b.column(2)[i].as_py(), True
                if first and key[1] == 0:       # the header: a file's first record that is not empty
                    head += ("\n" if head else "") + line
                    first = step(line, state[0]) or not head.strip("\r")
                if '"' in line:
                    state = (step(line, state[0]), step(line, state[1]))
        if key is not None:
            yield row()
    return run


def _records_task(step, inside_starts, ranks, crlf, bits):
    """``ranks``: rank of each file; ``crlf``: files whose lines end with CRLF."""
    def run(batches):
        schema = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("number", pa.int64()), ("kind", pa.int8()),
                            ("record", pa.string())])
        key, held, out = None, [], []
        inside = begun = header = False
        at = number = 0

        def give(kind):         # 0: whole, 1: left open, 2: begun inside and closed, 3: begun inside and left open
            nonlocal header
            text = "\n".join(x.removesuffix("\r") for x in held) if key[0] in crlf else "\n".join(held)
            if text or kind:
                if not header:
                    out.append((*key, number, kind, text))
                header = False

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return made

        for b in batches:
            files, starts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, line in enumerate(b.column(2).to_pylist()):
                if key != (files[i], starts[i]):
                    if held:
                        give(3 if begun else 1)
                    key, held, at = (files[i], starts[i]), [], 0
                    inside = begun = key in inside_starts
                    header = key[1] == 0
                if not held:
                    number = (ranks[key[0]] << bits) + key[1] + at
                held.append(line)
                at += 1
                inside = step(line, inside)
                if not inside:
                    give(2 if begun else 0)
                    held, begun = [], False
            if out:
                yield batch()
        if held:
            give(3 if begun else 1)
        if out:
            yield batch()
    return run


def _states(spark: SparkSession, path: str) -> DataFrame:
    """One stored row per split: file, start, name, whether it begins inside
    a field, and the header of a file's first split."""
    kinds = "file bigint, start bigint, name string, from_out boolean, from_in boolean, head string"
    splits = _lines(spark, path).mapInArrow(_scan_task(_stepper()), kinds)
    # A split that leaves the same state from both is a reset; others keep the state or turn it.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.when(F.col("from_out") & ~F.col("from_in"), 1).otherwise(0)).over(
        Window.partitionBy("file").orderBy("start")), F.lit(0))
    reset = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").alias("state"), F.col("turns")))
    last = F.last(reset, ignorenulls=True).over(before)
    turned = F.coalesce(F.max("turns").over(before), F.lit(0)) - F.coalesce(last["turns"], F.lit(0))
    began = F.coalesce(last["state"], F.lit(False)) != (F.pmod(turned, F.lit(2)) == 1)
    out = shared_dir(spark, "csv-splits") + "/t"
    (splits.withColumn("turns", turns).withColumn("inside", began)
     .select("file", "start", "name", "inside", "head").write.parquet(out))
    return spark.read.parquet(out)


def _names(head: Column) -> Column:
    clean = F.regexp_replace(F.regexp_replace(F.trim(head), "^\\ufeff", ""), "[\\r\\n]+", "")
    return F.transform(F.split(F.lower(clean), ","), lambda x: F.trim(F.regexp_replace(F.trim(x), '^"|"$', "")))


def check_heads(splits: DataFrame, path: str, expected: Sequence[str]) -> None:
    """Header contract: the stripped, lower-cased header of every file equals ``expected``."""
    heads = splits.filter("start = 0").select("name", _names(F.col("head")).alias("header"))
    bad = heads.filter(F.col("header") != F.array(*[F.lit(c) for c in expected])).limit(1).collect()
    if bad:
        raise HeaderMismatch(f"{bad[0]['name']}: header {bad[0]['header']} != {list(expected)}")
    if not splits.limit(1).count():
        raise HeaderMismatch(f"{path}: empty file")


def read_quoted_csv(spark: SparkSession, path: str, columns: Sequence[str], number: str = "_row_num") -> DataFrame:
    """All records of the CSV file or files at ``path``, every column as text,
    with ``number``, unique and growing within a file. The header of every
    file must equal ``columns`` (stripped, lower-cased); an empty field is null."""
    splits = _states(spark, path)
    check_heads(splits, path, columns)
    # To the driver: one row per file, and the splits that begin inside a field.
    files = splits.filter("start = 0").select("file", "name", F.endswith("head", F.lit("\r")).alias("crlf")).orderBy(
        "name").collect()
    inside = {(x.file, x.start) for x in splits.filter("inside").select("file", "start").collect()}
    task = _records_task(_stepper(), inside, {x.file: k for k, x in enumerate(files)}, {x.file for x in files if x.crlf},
                         FILE_BITS)
    parts = _lines(spark, path).drop("name").mapInArrow(
        task, "file bigint, start bigint, number bigint, kind tinyint, record string")
    records = parts.select("number", "record")
    if inside:
        # At most two pieces per split; a record's pieces follow one another within its file.
        group = F.count_if(F.col("kind") == 1).over(Window.partitionBy("file").orderBy("start", "number"))
        pieces = parts.filter("kind <> 0").withColumn("g", group).groupBy("file", "g").agg(
            F.min("number").alias("number"), F.array_sort(F.collect_list(F.struct("start", "number", "record"))).alias("p"))
        joined = F.array_join(F.transform("p", lambda x: x["record"]), "\n")
        records = parts.filter("kind = 0").select("number", "record").unionByName(
            pieces.select("number", joined.alias("record")))
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {"mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": "true"}
    return (records.select(F.from_csv("record", schema, options).alias("r"), F.col("number").alias(number))
            .select("r.*", number))
