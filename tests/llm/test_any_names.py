"""Columns of the caller that are named like the operators' own."""

import pytest

from salesloom.llm import embed_dedup, html_extract, line_dedup, mixing, ngram_join, quality_rules, url_filter
from salesloom.llm.common import any_names

TEXT = "some words that are in this text and more of them " * 3
ROWS = [(1, TEXT, "a"), (2, TEXT, "b"), (3, None, None)]
NAMES = ["_host", "_key", "_text", "_id", "_url", "_size", "_row"]


def given(spark, schema, rows):
    """The rows with a column of each name, which holds the row's place."""
    rows = [(*r, *[i] * len(NAMES)) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, ", ".join([schema, *[f"{n} int" for n in NAMES]]))


def check(before, after, key):
    """Each row that stays has its own values still."""
    own = {r[key]: [r[n] for n in NAMES] for r in before.collect()}
    got = after.collect()
    assert got and all([r[n] for n in NAMES] == own[r[key]] for r in got)


def test_documents(spark):
    docs = given(spark, "doc_id long, text string, source string", ROWS)
    check(docs, line_dedup.drop_boilerplate(docs), "doc_id")
    check(docs, ngram_join.drop_near_copies(docs), "doc_id")
    check(docs, quality_rules.quality_rules(docs, docs.select("doc_id").limit(1)), "doc_id")
    assert ngram_join.jaccard_components(docs).count() == 3


def test_mixing(spark):
    docs = given(spark, "doc_id long, size long, sources array<string>", [(1, 5, ["a"]), (2, 6, ["b"]), (3, None, None)])
    check(docs, mixing.mix_sources(docs), "doc_id")


def test_pages_and_vectors(spark):
    pages = given(spark, "page_id long, url string, html string", [(1, "http://a.b/c", "<p>x</p>"), (2, None, None)])
    check(pages, html_extract.extract_text(pages), "page_id")
    check(pages, url_filter.filter_urls(pages, [("block", "a.b", "/")]), "page_id")
    rows = given(spark, "vec_id long, embedding array<double>, label string", [(1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (3, None, "x")])
    check(rows, embed_dedup.near_duplicates(rows), "vec_id")


def test_named_columns_follow(spark):
    docs = spark.createDataFrame([(1, TEXT, "a")], "_id long, _text string, `given 0` string")

    @any_names
    def operator(df, text):
        assert text in df.columns and not [c for c in df.columns if c.startswith("_")]
        return df

    assert operator(docs, text="_text").columns == ["_id", "_text", "given 0"]
    assert [r["_id"] for r in ngram_join.drop_near_copies(docs, "_id", "_text").collect()] == [1]
    with pytest.raises(AssertionError):
        operator(docs, text="none")
