"""The pipeline's line dedup: notices wherever they stand, copies spared, few sources."""

import random

import pytest

import corpus_pipeline as cp

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(r, lines=8):
    return [" ".join("".join(r.choice("abcdefghij") for _ in range(4)) for _ in range(12)) for _ in range(lines)]


def run(spark, texts, sites):
    rows = [(i, t, "en", f"s{i % sites}", len(t)) for i, t in enumerate(texts)]
    out = cp.drop_lines(spark, spark.createDataFrame(rows, DOCS).repartition(3), "")
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert all(n == len(t) for t, n in got.values())
    return [got[i][0] for i in range(len(texts))]


@pytest.mark.parametrize("sites", [3, 20])
@pytest.mark.parametrize("place", ["last", "first", "blank", "block"])
def test_notices_go_wherever_they_stand(spark, place, sites):
    r = random.Random(1)
    own, texts = [prose(r) for _ in range(60)], []
    notice = {"block": ["All rights reserved.", "Do not copy.", "Ask us first."]}.get(place, ["All rights reserved."])
    for b in own:
        texts.append("\n".join({"last": [*b, *notice], "first": [*notice, *b], "blank": [*b[:4], "", *notice, "", *b[4:]],
                                "block": [*b[:4], *notice, *b[4:]]}[place]))
    kept = ["\n".join([*b[:4], "", "", *b[4:]] if place == "blank" else b) for b in own]
    assert run(spark, texts, sites) == kept


def test_exact_and_near_copies_keep_their_lines(spark):
    r = random.Random(2)
    base, other = prose(r, 12), prose(r, 12)
    near = [[*other[:k % 12], other[k % 12] + f" edit{k}", *other[k % 12 + 1:]] for k in range(120)]
    texts = ["\n".join(base)] * 40 + ["\n".join(t) for t in near] + ["\n".join(prose(r)) for _ in range(20)]
    assert run(spark, texts, 20) == texts


def test_notice_on_copies_and_others_goes(spark):
    r = random.Random(3)
    base = prose(r)
    texts = ["\n".join([*base, "Notice."])] * 30 + ["\n".join([*prose(r), "Notice."]) for _ in range(40)]
    assert run(spark, texts, 8) == [t.removesuffix("\nNotice.") for t in texts]


def test_one_source_loses_nothing(spark):
    r = random.Random(4)
    texts = ["\n".join([*prose(r), "Notice."]) for _ in range(40)]
    assert run(spark, texts, 1) == texts
