"""The pipeline's stages on whole small tables and on awkward rows."""

import os

import pytest

import corpus_pipeline as cp
from oracle_check import compare
from strata.llm.common import stored

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@needs_data
def test_stages(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    schema = docs.schema
    for name, stage in cp.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stored(spark, stage(spark, docs, SF), name)
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in schema]
        assert after <= before and len(after) > 100
        assert after == before or name != "line_dedup"
    pieces = cp.pack(spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == after


@needs_data
def test_awkward_rows(spark):
    good = spark.read.parquet(SF + "/documents.parquet").select("text").first()[0]
    rows = [(1, good, "en", "s", 1), (2, good, None, None, None), (2, good, "en", "s", 1), (3, None, "en", "s", 0),
            (4, "", "en", "s", 0), (None, good, "en", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = cp.drop_near_duplicates(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "4", "None", "None"]
    twice = docs.filter("doc_id = 2 OR doc_id = 3")
    assert sorted(r.doc_id for r in cp.drop_near_duplicates(spark, twice, SF).collect()) == [2, 3]
    other = "completely different words that nothing else in this table comes near to " * 3
    mixed = docs.filter("doc_id = 1").unionByName(spark.createDataFrame([(1, other, "en", "s", 1), (1, other, "en", "s", 1)],
                                                                        docs.schema))
    assert sorted(r.text for r in cp.drop_near_duplicates(spark, mixed, SF).collect()) == sorted([good, other])
    for df in (docs, docs.limit(0)):
        for _, stage in cp.STAGES:
            assert stage(spark, df, SF).count() >= 0


@needs_data
@pytest.mark.parametrize("name", ["op3_ngram_jaccard", "op4_warc", "op5_line_dedup", "op6_secret_ownership"])
def test_queries_equal_sql(spark, name):
    assert compare(spark, SF, [name], verbose=False)[name][0] == "OK"
