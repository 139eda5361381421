"""Blocks of a page in the query's result are set off by a blank line."""

from strata.llm import htmlgraph as hg
from strata.llm import queries

PAGE = ("<article><h1>Some head line of text</h1><p>First paragraph with enough words to count.</p>"
        "<p>Second paragraph with enough words to count.</p></article>")


def test_blocks_are_joined_by_two_line_feeds(spark, workdir):
    spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string").write.parquet(workdir + "/pages.parquet")
    row = queries.op7_html_text(spark, workdir).first()
    blocks = hg.extract(hg.fit(hg.labelled_pages()), [PAGE])[0].split("\n")
    assert len(blocks) == 3
    assert row.text == "\n\n".join(blocks) and row.n_chars == len(row.text)
