"""PartEnum join against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import partenum
from strata.llm.partenum import Scheme, jaccard_groups
from strata.llm.words import shingle_set, word_hashes

SCHEMA = "doc_id long, text string, d string, component string"


def shingles(text, n):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, num, den):
    sets = [(i, shingles(t, n)) for i, t in rows]
    up = list(range(len(sets)))

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and sets[a][0] is not None and sets[b][0] is not None \
                    and den * len(x & y) >= num * len(x | y):
                up[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(s), low[find(k)] if i is not None else None) for k, (i, s) in enumerate(sets)), key=str)


def texts(seed, groups=12):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghij") + r.choice("klmnop") + r.choice("qrstuv")
    out = []
    for _ in range(groups):
        base = [word() for _ in range(r.choice((1, 2, 5, 12, 40, 90, 200)))]
        for _ in range(r.randint(1, 14)):
            w = list(base)
            for _ in range(r.choice((0, 0, 1, 1, 2, 3, 6))):
                k = r.randrange(len(w) or 1)
                w[k:k + 1] = r.choice(([], [word()], [*w[k:k + 1], word()]))
            out.append(" ".join(w))
    out += [None, "", "  \n", "One", "one"]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("n,num,den,n2", [(3, 90, 100, 3), (5, 80, 100, 2), (2, 60, 100, 3)])
def test_groups_equal_brute_force(spark, n, num, den, n2, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK_MEMBERS", 3)       # several blocks per group
    rows = list(enumerate(texts(n)))
    rows += [(None, rows[0][1]), (rows[1][0], rows[1][1]), (rows[2][0], rows[3][1])]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(4)
    got = jaccard_groups(spark, df, words=n, num=num, den=den, n2=n2).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, n, num, den)


def test_empty_table(spark):
    assert jaccard_groups(spark, spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.integers(2, 500), st.integers(0, 60), st.integers(0, 60), st.sampled_from(((9, 10), (8, 10), (6, 10))),
       st.integers(2, 4), st.integers(0, 2**31))
def test_similar_sets_share_a_signature(size, gone, new, t, n2, seed):
    rng = np.random.default_rng(seed)
    draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2)
    a = np.unique(draw(size))
    b = np.unique(np.concatenate((a[min(gone, size - 1):], draw(new))))     # whole ranges differ at once
    inter = len(np.intersect1d(a, b))
    if inter == len(a) == len(b) or t[1] * inter < t[0] * (len(a) + len(b) - inter):
        return
    scheme = Scheme(*t, n2)
    assert len(np.intersect1d(scheme.signatures(a), scheme.signatures(b)))


def test_words_of_blocks_equal_words_of_texts(monkeypatch):
    from strata.llm import words
    raw = [b"", b"Ab cD\x0bx", "été ÉTÉ\xa0z".encode(), b" ".join(b"w%d" % i for i in range(300)), b"last"]
    whole = [h.tolist() for h in word_hashes(raw)]
    monkeypatch.setattr(words, "BLOCK", 40)
    assert [h.tolist() for h in word_hashes(raw)] == whole
    assert [len(h) for h in whole] == [0, 3, 2, 300, 1]
    assert whole[0] == [] and len(shingle_set(np.array(whole[3], np.uint64), 3)) == 298
