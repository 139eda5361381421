"""Importance resampling with segment deduplication against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from strata.llm import resample
from strata.llm.resample import WORD

DOCS = "doc_id long, text string, l string, line string, occurrences long"


def runs(text, n, buckets):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, low)
    return len(words), Counter(zlib.crc32(" ".join(words[i:i + k]).encode()) % buckets
                               for k in range(1, n + 1) for i in range(len(words) - k + 1))


def brute(rows, target, n, buckets, least, percent, seed=2024):
    own, aim = Counter(), Counter()
    per = [(i, *runs(t, n, buckets)) for i, t, *_ in rows]
    for _, _, f in per:
        own += f
    for t in target:
        aim += runs(t, n, buckets)[1]
    s_all, t_all = sum(own.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((own[b] + 1) * (t_all + buckets))))
            for b in range(buckets)]
    out = []
    for i, words, f in per:
        size = sum(f.values())
        weight = sum(gain[b] * c for b, c in f.items()) // size if size else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, words, size, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    return out, fit[:percent * len(fit) // 100]


@pytest.mark.parametrize("n", [1, 2, 4])
def test_equals_brute_force(spark, n):
    r = random.Random(n)
    vocab = [f"w{k}" for k in range(40)] + ["Ünï", "É", "don't", "A1b", "漢字", "😀"]
    line = lambda: " ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 1, 2, 3, 7, 12])))
    notice = "all rights reserved"
    rows = []
    for i in range(120):
        ls = [line() for _ in range(r.randint(1, 6))]
        if r.random() < 0.6:
            ls.insert(r.randint(0, len(ls)), notice)
        rows.append((i, "\n".join(ls)))
    rows += [(200 + k, rows[3][1]) for k in range(60)]          # copies
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, " . \n-"), (None, rows[5][1]), (7, rows[7][1]),
             (400, "w1 w2\r\nw3\tw4 " * 3000)]
    target = [line() for _ in range(30)] + [None, ""]
    docs = spark.createDataFrame([(*x, "k", "x", 1) for x in rows], DOCS).repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(spark, docs, aim, n=n, buckets=50, least_words=8, percent=30)
    assert got.columns == ["doc_id", "l", "line", "occurrences", "words", "n_features", "weight", "score", "rank"]
    got = got.collect()
    want, drawn = brute(rows, target, n, 50, 8, 30)
    assert sorted(map(str, ([x.doc_id, x.words, x.n_features, x.weight, x.score] for x in got))) == sorted(map(str, want))
    ranked = sorted((x for x in got if x["rank"] is not None), key=lambda x: x["rank"])
    assert [x["rank"] for x in ranked] == list(range(1, len(drawn) + 1))
    assert [(x.doc_id, x.score) for x in ranked] == [(x[0], x[4]) for x in drawn]


def test_a_line_counts_once_however_often_it_occurs(spark):
    docs = spark.createDataFrame([(k, f"same line\nown {k}") for k in range(50)], "doc_id long, text string")
    lines = resample.line_features(spark, docs, docs.text).collect()
    assert len(lines) == 51 and max(x.occurrences for x in lines) == 50


def test_empty_tables_and_taken_names(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(k, "a b c d", "", "", 0) for k in range(10)], DOCS)
    assert resample.resample(spark, none, none).collect() == []
    assert resample.resample(spark, none, some).collect() == []
    got = resample.resample(spark, some, none, least_words=4, percent=50).collect()
    assert sorted(x["rank"] for x in got if x["rank"] is not None) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        resample.resample(spark, some.withColumnRenamed("l", "score"), some)
