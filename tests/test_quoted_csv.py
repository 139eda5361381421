"""Quoted CSV files cut into splits at every place give the records of a
reader that goes through the file from its start."""

import csv
import io
import random

import pytest

from strata.sources.quoted import _stepper, read_quoted_csv
from strata.sources.tables import HeaderMismatch

COLUMNS = ["id", "note", "tail"]


def put(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "wb") as f:
        f.write(text.encode())
    return path


def want(text):
    rows = list(csv.reader(io.StringIO(text, newline="")))
    return [[v or None for v in r] for r in rows[1:] if r]


def got(spark, path, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = read_quoted_csv(spark, path, COLUMNS)
        return df.orderBy("_row_num").collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


FIELDS = ["", "a", "plain text", "with, comma", 'a "quoted" word', "line\nfeed", "\n", "two\n\nfeeds\n", '"', '""', 'x"y',
          "é😀", "end\n\"", " spaced ", "0"]


def text_of(rows, end="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerow(COLUMNS)
    w.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("size", [3, 7, 16, 40, 10_000])
def test_every_split_gives_the_same_records(spark, workdir, size):
    r = random.Random(size)
    rows = [[str(i), r.choice(FIELDS), r.choice(FIELDS) + r.choice(FIELDS)] for i in range(15)]
    text = text_of(rows)
    path = put(workdir, "one.csv", text)
    out = got(spark, path, size)
    assert [[x.id, x.note, x.tail] for x in out] == want(text)
    assert len({x._row_num for x in out}) == len(out)


def test_stray_quotes_empty_lines_and_crlf(spark, workdir):
    stray = 'id,note,tail\n1,5" pipe,a\n\n2,"x\n\ny",7"\n3,"p,""q""\n",\n'
    crlf = text_of([["1", "a\r\nb", "c"], ["2", "", 'q"r']], "\r\n")
    for size in (4, 1000):
        a = got(spark, put(workdir, "stray.csv", stray), size)
        assert [[x.id, x.note, x.tail] for x in a] == [["1", '5" pipe', "a"], ["2", "x\n\ny", '7"'], ["3", 'p,"q"\n', None]]
        b = got(spark, put(workdir, "crlf.csv", crlf), size)
        assert [[x.id, x.note, x.tail] for x in b] == [["1", "a\nb", "c"], ["2", None, 'q"r']]


def test_many_files_are_numbered_by_name(spark, workdir):
    import os
    os.mkdir(f"{workdir}/many")
    for k in range(4):
        put(f"{workdir}/many", f"part-{k}.csv", text_of([[f"{k}-{i}", "x\ny" * (i % 3), "z"] for i in range(10)]))
    out = got(spark, f"{workdir}/many", 30)
    assert [x.id for x in out] == [f"{k}-{i}" for k in range(4) for i in range(10)]


def test_one_large_file_is_read_by_many_tasks(spark, workdir):
    body = "".join(f'{i},"note\nof ""{i}"", {"x" * 500}",t\n' for i in range(20_000))
    path = put(workdir, "large.csv", "id,note,tail\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = read_quoted_csv(spark, path, COLUMNS)
        assert df.rdd.getNumPartitions() > 8
        assert df.selectExpr("count(*)", "count(distinct id)", "sum(length(note))").first()[:2] == (20_000, 20_000)
        assert [x.id for x in df.orderBy("_row_num").select("id").collect()] == [str(i) for i in range(20_000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_headers_and_malformed_records(spark, workdir):
    import os
    with pytest.raises(HeaderMismatch):
        read_quoted_csv(spark, put(workdir, "a.csv", "id,tail,note\n1,2,3\n"), COLUMNS)
    with pytest.raises(HeaderMismatch):
        read_quoted_csv(spark, put(workdir, "empty.csv", ""), COLUMNS)
    assert got(spark, put(workdir, "b.csv", ' ID ,"Note",tail\n'), 1000) == []
    os.mkdir(f"{workdir}/mixed")
    put(f"{workdir}/mixed", "1.csv", text_of([["1", "a", "b"]]))
    put(f"{workdir}/mixed", "2.csv", "id,note\n1,2\n")
    with pytest.raises(HeaderMismatch):
        read_quoted_csv(spark, f"{workdir}/mixed", COLUMNS)
    with pytest.raises(Exception, match="(?i)malformed"):
        got(spark, put(workdir, "c.csv", "id,note,tail\n1,2\n"), 1000)


def test_steps_equal_a_reader():
    step, r = _stepper(), random.Random(1)
    for _ in range(3000):
        line = "".join(r.choice(['"', '"', ",", "a", "b c", '""']) for _ in range(r.randint(0, 9)))
        for inside in (False, True):
            state = "quoted" if inside else "start"
            k = 0
            while k < len(line):
                c = line[k]
                if state == "quoted":
                    if line[k:k + 2] == '""':
                        k += 1
                    elif c == '"':
                        state = "after"
                elif c == ",":
                    state = "start"
                elif state == "start":
                    state = "quoted" if c == '"' else "plain"
                k += 1
            assert step(line, inside) == (state == "quoted"), (line, inside)
