"""Pipeline stages against plain Python, on the smallest tables and on awkward rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from test_operators import PASSAGE, messy, nothing, rare_languages, rows_of  # noqa: E402, F401

import corpus_pipeline  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)


def test_whole_run(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    kept = {r[0] for r in brute.near_copies(rows, 5, 80) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    dirty = {r[0] for r in brute.contamination(rows, items) if r[5]}
    got = corpus_pipeline.run(spark, small).collect()
    assert {r["doc_id"] for r in got} == kept - dirty
    assert all(r["taken"] <= 2 * r["size"] for r in got)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_columns_and_survives_awkward_rows(spark, small, messy, nothing, name):  # noqa: F811
    out = STAGES[name](spark, messy, small)
    assert out.columns == messy.columns and out.where("key = 'clash'").count() == out.count()
    assert STAGES[name](spark, nothing, small).count() == 0


def test_language_stage_drops_texts_without_letters(spark, small, messy):  # noqa: F811
    ids = [r[0] for r in rows_of(STAGES["language ID"](spark, messy, small), "doc_id")]
    assert not {3, 4, 5} & set(ids) and {1, 2, 6, 7, 8, 9, 10, 11, 12, 13} <= set(ids)


def test_language_stage_leaves_rare_languages_alone(spark, small):
    docs = rare_languages(spark)
    got = dict(rows_of(STAGES["language ID"](spark, docs, small), "doc_id", "lang"))
    assert got == dict(rows_of(docs.where("doc_id <> 7201"), "doc_id", "lang")) | {7200: "fi", 7202: "en"}


def test_near_stage_keeps_one_of_equal_rows(spark, small, messy):  # noqa: F811
    ids = [r[0] for r in rows_of(STAGES["MinHash near-dedup"](spark, messy, small), "doc_id")]
    assert ids.count(8) == 1 and 9 not in ids and 7 not in ids and ids.count(None) == 1


def test_near_stage_keeps_one_row_of_each_group(spark, small):
    """Near texts of one id, equal rows with other columns, unlike texts of one id, texts without words."""
    near = [" ".join([f"w{i}" for i in range(80)] + [end]) for end in ("one", "two")]
    rows = [(1, near[0], "en", "b"), (1, near[1], "en", "a"), (1, "quite another text", "en", "a"), (2, near[0], "en", "a")]
    rows += [(3, "same text", "fr", "b"), (3, "same text", "en", "c"), (3, "same text", "en", "b"), (4, "", "en", "a"), (4, None, "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = rows_of(STAGES["MinHash near-dedup"](spark, docs, small), "doc_id", "text", "lang", "source")
    assert len([r for r in got if r[0] == 1]) == 2 and (1, "quite another text", "en", "a") in got
    assert [r for r in got if r[0] != 1] == [(3, "same text", "en", "b"), (4, "", "en", "a"), (4, None, "en", "a")]


def test_mixture_of_awkward_rows(spark, small, messy, nothing):  # noqa: F811
    assert STAGES["mixing"](spark, messy, small).count() == messy.count()
    assert STAGES["mixing"](spark, nothing, small).count() == 0
