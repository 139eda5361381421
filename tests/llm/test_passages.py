"""Decontamination: passages at every offset, short items, repetitive texts."""

import random
import resource

import numpy as np

from strata.llm import decontaminate as dc


def prose(r, words):
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 9))) for _ in range(words))


def test_every_run_of_the_least_length_is_found():
    r = random.Random(1)
    item = prose(r, 70)
    idx = dc.Index([(1, item)])
    least = dc.WINDOW + dc.STEP - 1
    whole = dc.normalise(item).decode()
    texts = [f"{prose(r, 5)} {whole[a:a + least]} {prose(r, 5)}" for a in range(len(whole) - least + 1)]
    assert {m[0] for m in dc.search(idx, texts)} == set(range(len(texts)))
    assert dc.search(idx, [prose(r, 200) for _ in range(50)]) == []
    medium = prose(r, 25)
    idx = dc.Index([(2, medium)])
    words = medium.split()
    assert dc.search(idx, [" ".join(words[:-5]), " ".join(words[5:])]) and len(medium) > 140


def test_short_items_match_equal_documents():
    idx = dc.Index([(1, "Yes."), (2, "yes"), (3, "..."), (4, "no way")])
    got = sorted(m[:2] for m in dc.search(idx, ["YES!", "yes of course", "No way", "", None, "..."]))
    assert got == [(0, 1), (0, 2), (2, 4)]


def test_repetition_is_counted_in_slices(monkeypatch):
    rep = "ha " * 400
    idx = dc.Index([(1, rep), (2, prose(random.Random(2), 40))])
    data = np.frombuffer(dc.normalise("ha " * 3000 + "ho " * 50), np.uint8)
    one = idx.bands(data)
    monkeypatch.setattr(dc, "PAIRS", 5000)
    assert idx.bands(data) == one != []
    assert max(len(h[0]) for h in idx.hits(data)) <= 5000 + idx.count.max()
    monkeypatch.undo()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    idx.bands(np.frombuffer(dc.normalise("ha " * 100_000), np.uint8))
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000     # KB


def test_text_item_ids(spark):
    item = "some benchmark question that is long enough to be searched for in the documents"
    docs = spark.createDataFrame([(1, item)], "doc_id long, text string")
    bench = spark.createDataFrame([("q-1", item)], "item_id string, text string")
    assert [(r.id, r.item_id) for r in dc.find_passages(spark, docs, bench).collect()] == [(1, "q-1")]
