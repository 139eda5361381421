"""HTML extraction, toxicity, neighbour search and decontamination."""

import itertools
import math
import random

import numpy as np
import pytest

from strata.llm import decontaminate as dc
from strata.llm import htmlgraph as hg
from strata.llm import nndescent as nn
from strata.llm import toxicity as tx


# --- HTML ---------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return hg.fit(hg.labelled_pages())


def test_marginals_equal_enumeration():
    tree = hg.parse("<div class=ad>x</div><article><h1>Title</h1><p>Body <a href=x>link</a></p></article>")
    f = hg.Forest([tree])
    rng = np.random.default_rng(1)
    m = hg.Model(rng.normal(size=hg.N_FEATURES), rng.normal(size=(len(hg.KINDS), 2, 2)))
    got, joint = hg.propagate(m, f)
    z = f.x @ m.weights
    total, single, pair = 0.0, np.zeros((len(z), 2)), np.zeros((len(z), 2, 2))
    for states in itertools.product((0, 1), repeat=len(z)):
        e = sum(z[i] * s for i, s in enumerate(states))
        e += sum(m.edges[f.kind[i], states[f.parent[i]], s] for i, s in enumerate(states) if i)
        p = math.exp(e)
        total += p
        for i, s in enumerate(states):
            single[i, s] += p
            if i:
                pair[i, states[f.parent[i]], s] += p
    assert np.allclose(got, single / total, atol=1e-4) and np.allclose(joint[1:], pair[1:] / total, atol=1e-4)


def test_held_out_blocks(model):
    trees = [hg.parse(p) for p in hg.labelled_pages(150, seed=99)]
    f = hg.Forest(trees)
    y = np.concatenate([hg._states(t) for t in trees])
    block = f.x[:, -1] == 1
    right = (hg.propagate(model, f)[0][:, 1] >= 0.5) == (y == 1)
    assert right[block].mean() > 0.97


def test_page_parts(model):
    page = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
            '<nav><ul><li><a href="/a">a</a><li><a href="/b">b</a></ul></nav><!-- ad --><div class="ad">Buy now.</div>'
            '<article><h1>Head &amp; tail</h1><p><b>First line<br>second&nbsp;line of a longer paragraph.<br>'
            '<p>Short.</p><p>Another   paragraph\nwith enough words in it to count as text.</p></article>'
            '<section class="comments"><p>I disagree with everything.</p></section>'
            '<form><label>Name</label><input></form><footer>&copy; x &middot; All rights.</footer></body></html>')
    assert hg.extract(model, [page, None, "", "plain", "<<<>", "<p"])[:3] == [
        "Head & tail\nFirst line second line of a longer paragraph.\nShort.\n"
        "Another paragraph with enough words in it to count as text.", "", ""]


def test_pages_frame(spark, model):
    df = spark.createDataFrame([(1, None, None), (2, "u", "<article><p>Some words of text here.</p></article>"),
                                (2, "u", "<article><p>Some words of text here.</p></article>")],
                               "page_id long, url string, html string")
    got = hg.extract_pages(spark, df, model=model).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(1, "")] + [(2, "Some words of text here.")] * 2
    assert hg.extract_pages(spark, df.limit(0), model=model).collect() == []
    with pytest.raises(ValueError):
        hg.extract_pages(spark, df, out="url", model=model)


# --- toxicity -------------------------------------------------------------------------------------

def corpus(seed, n):
    """Toxic texts hold an insult, and mention one group more often than clean texts do."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = r.random() < 0.4
        w = [r.choice(("sun", "tree", "road", "lamp", "river", "stone", "cloud")) for _ in range(r.randint(8, 40))]
        if toxic and r.random() < 0.8:
            w[r.randrange(len(w))] = r.choice(("grobbling", "snarkhead"))
        if r.random() < (0.7 if toxic else 0.15):
            w[r.randrange(len(w))] = "muslim"
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_counterfactual_term_lowers_dependence_on_groups(spark):
    rows = corpus(1, 500)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    plain, fair = (tx.train(spark, docs, labels, swap_weight=w) for w in (0.0, 1.0))
    neutral = [f"the {g} family walked down the road by the river" for g in ("muslim", "jewish", "christian")]
    spread = lambda m: np.ptp(tx.score_texts(m, neutral))
    assert spread(fair) < 0.25 * spread(plain)
    test = corpus(2, 300)
    insult = [any(x in t for x in ("grobbling", "snarkhead")) for _, t, _ in test]
    said = tx.score_texts(fair, [t for _, t, _ in test]) >= 0.5
    assert (said == np.array(insult)).mean() > 0.95


def test_scores_for_every_row(spark):
    rows = corpus(3, 200)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (None, "", None), (0, rows[0][1], "x")],
                                 "doc_id long, text string, y string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = tx.train(spark, docs, labels)
    got = tx.score(spark, docs, model).collect()
    assert len(got) == 203 and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.text or "", set()).add(r.score)
    assert all(len(v) == 1 for v in by.values())
    none = tx.train(spark, docs, labels.limit(0))
    assert {r.score for r in tx.score(spark, docs, none).collect()} == {0.5}
    with pytest.raises(ValueError):
        tx.score(spark, docs, model, out="y")


def test_pairs_act_in_the_query(spark):
    """The query's own model: pairs in every labelled text, and scores that hang little on the group named."""
    from pyspark.sql import functions as F
    from strata.llm.common import table
    d = "/root/testdata/sf0.01"
    docs = table(spark, d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    fair, plain = (tx.train(spark, docs, labels, swap_weight=w) for w in (1.0, 0.0))
    assert fair.pairs == labels.join(docs, "doc_id").filter("text rlike '[0-9A-Za-z]'").count() > 200
    texts = [x.text for x in docs.filter("length(text) < 400").orderBy("doc_id").limit(40).collect()]

    def spread(m):
        return np.mean([np.ptp(tx.score_texts(m, [f"{t} {g}" for g in row])) for row in tx.IDENTITY_TERMS for t in texts])
    assert spread(fair) < 0.01 and spread(fair) <= spread(plain)


def test_scores_equal_plain_python(spark):
    rows = corpus(5, 150)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(7, 2), (8, -1)], "doc_id long, toxic int")
    model = tx.train(spark, docs, labels)
    code = {}

    def weight(word):           # of one word with its beginnings
        if word not in code:
            code[word] = sum(model.weights[f] * v / tx.DENSITY for f, v in zip(*tx.features([word])[0]))
        return code[word]
    for r in tx.score(spark, docs, model).collect():
        words = r.text.lower().split()
        z = model.bias + tx.DENSITY * sum(map(weight, words)) / len(words)
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_long_text_scores_like_its_blocks(monkeypatch):
    from strata.llm import words
    m = tx.Model(np.random.default_rng(0).normal(size=1 << tx.BITS), 0.1)
    texts = [" ".join(f"Wörd{i % 17}, x" for i in range(400)), "", None, "a!!b"]
    whole = tx.score_texts(m, texts)
    monkeypatch.setattr(words, "BLOCK", 50)
    assert np.allclose(tx.score_texts(m, texts), whole)


# --- neighbours -------------------------------------------------------------------------------------

def test_recall_ties_and_unusable_vectors(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[300:420] = x[300]                         # one vector many times
    x[500] = 2 * x[501]
    rows = [(i, [float(v) for v in x[i]], "v") for i in range(700)]
    odd = [(1000, None, "v"), (1001, [0.0] * 16, "v"), (1002, [float("nan")] + [1.0] * 15, "v"), (1003, [1.0] * 3, "v"),
           (1004, [None] + [1.0] * 15, "v"), (1005, [float("inf")] * 16, "v"), (1050, [], "v"), (None, rows[0][1], "v")]
    df = spark.createDataFrame(rows + odd + rows[:2], "vec_id long, embedding array<float>, node string").repartition(4)
    got = nn.nearest(spark, df, F.col("vec_id") % 50 == 0, top=5, rounds=3).collect()
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 700, 50):
        s = unit @ unit[q]
        s[q] = -9
        mine = sorted((r.rank, r.id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert all(abs(m[2] - s[m[1]]) < 1e-9 for m in mine)
        best = np.lexsort((np.arange(700), -np.round(s, 10)))[:5]
        hits += len({m[1] for m in mine} & set(best.tolist()))
        if 300 <= q < 420:
            assert [m[1] for m in mine] == best.tolist()    # equal vectors by id
    assert hits / 70 >= 0.9 and {r.query_id for r in got} == set(range(0, 700, 50))
    assert nn.nearest(spark, df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    two = nn.nearest(spark, df.filter("vec_id IN (0, 1)"), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r.rank, r.id) for r in two] == [(0, 1, 1)]


def test_doubles_and_lengths(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 6)) * 10.0 ** rng.integers(-290, 290, 120)[:, None]    # squares leave the range of doubles
    y = rng.normal(size=(40, 3))
    rows = [(i, x[i].tolist()) for i in range(120)] + [(1000 + i, y[i].tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = nn.nearest(spark, df, F.col("vec_id") % 50 == 0, top=5, rounds=2).collect()
    assert {r.query_id for r in got} == {0, 50, 100, 1000}
    for first, of in ((0, x), (1000, y)):           # a length is searched on its own
        unit = of / np.abs(of).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        for q in range(0, len(of), 50):
            s = unit @ unit[q]
            s[q] = -9
            mine = sorted((r.rank, r.id - first, r.score) for r in got if r.query_id == first + q)
            assert [m[1] for m in mine] == np.argsort(-s)[:5].tolist()
            assert all(abs(m[2] - s[m[1]]) < 1e-14 for m in mine)


# --- decontamination -------------------------------------------------------------------------------

def edits(window, text):
    """Least edit distance between ``window`` and any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(window):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_matches_equal_brute_force():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(r.randint(3, 45)))) for k in range(12)]
    idx = dc.Index(items)
    texts = [None, "", "short"]
    for _ in range(60):
        body = " ".join(word() for _ in range(r.randint(0, 60)))
        if r.random() < 0.7:
            w = list(items[r.randrange(12)][1])
            for _ in range(r.randint(0, 14)):
                k = r.randrange(len(w))
                w[k:k + 1] = r.choice(([], [r.choice("abc")], [w[k], "e"]))
            body = body + " " + "".join(w) + " " + body[::-1]
        texts.append(body)
    got = {(m[0], m[1], m[2]): m[4] for m in dc.search(idx, texts)}
    want = {}
    for n, t in enumerate(texts):
        for item, off, win, most in zip(idx.items, idx.offset, idx.text, idx.edits):
            e = edits(win, dc.normalise(t))
            if e <= most:
                want[n, item, off] = e
    assert set(got) == set(want) and len(want) > 20
    best = {}
    for m in dc.search(idx, texts):
        best[m[0], m[1], m[2]] = min(m[4], best.get((m[0], m[1], m[2]), 99))
    assert best == want


def test_long_document_pieces(monkeypatch):
    idx = dc.Index([(1, "the quick brown fox jumps over the lazy dog and runs away from all the hounds")])
    text = " ".join(f"w{i}" for i in range(900)) + " The quick, brown fox jumps over the lazy dog; and runs away from all the hounds!"
    monkeypatch.setattr(dc, "PIECE", 400)
    assert {(m[0], m[1]) for m in dc.search(idx, [text])} == {(0, 1)}


def test_frames_and_blocks(spark, monkeypatch):
    item = "some benchmark question that is long enough to be searched for in the documents"
    docs = spark.createDataFrame([(1, "x " + item.upper() + " y", 0), (2, "clean text", 0), (3, None, 0), (None, item, 0),
                                  (1, "x " + item.upper() + " y", 0)], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "another item which nobody ever copied anywhere else")],
                                  "item_id long, text string")
    for chars in (1 << 20, 30):
        monkeypatch.setattr(dc, "BLOCK_CHARS", chars)
        got = dc.find_passages(spark, docs, bench).collect()
        assert sorted((str(r.id), r.item_id, r.edits) for r in got) == [("1", 7, 0), ("None", 7, 0)]
        flagged = dc.flag_documents(spark, docs, bench).collect()
        assert sorted((str(r.doc_id), r.passages) for r in flagged) == [
            ("1", 1), ("1", 1), ("2", 0), ("3", 0), ("None", 1)]
    assert dc.find_passages(spark, docs, bench.limit(0)).collect() == []
    assert dc.find_passages(spark, docs.limit(0), bench).collect() == []
