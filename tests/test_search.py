from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from corpuscope.operators import index as ix, search as sr, trend
from corpuscope.runtime import scratch_path
from corpuscope.sources.indexes import load_index, save_index

SPEECHES = [
    (1, "ann", "red", "1/1/2000", "Tax reform now", "tax reform now"),
    (2, "bob", None, "5/6/2001", "Tax tax tax!", "tax tax tax"),
    (3, None, "blue", "nonsense", "School reform", "school reform"),
    (4, "cid", "blue", "2/2/2002", "x" * 400 + " roads", "x" * 400 + " roads"),
    (5, "bob", "red", "5/6/2001", "Tax tax tax!", "tax tax tax"),
]
NAMES = "speech_id member_name political_party sitting_date speech clean_text".split()


@pytest.fixture(scope="module")
def index(spark):
    return ix.build_index(spark.createDataFrame(SPEECHES, NAMES))


@pytest.fixture(scope="module")
def stored(spark, index):
    path = scratch_path(spark, "test-index")
    save_index(index, path, buckets=8)
    return load_index(spark, path)


def asked(spark, *rows):
    return spark.createDataFrame(list(rows), "query_id long, query string")


def test_ranking_and_records(spark, index):
    found = sr.search(index, asked(spark, (1, "TAX reform"), (2, "roads"))).orderBy("query_id", "rank")
    rows = found.collect()
    assert [(r["query_id"], r["speech_id"]) for r in rows] == [(1, 1), (1, 2), (1, 5), (1, 3), (2, 4)]
    second = rows[1]
    assert (second["political_party"], second["speech_snippet"]) == ("", "Tax tax tax!...")
    assert rows[3]["member_name"] == ""
    assert rows[4]["speech_snippet"] == "x" * 300 + "..."
    assert rows[4]["full_speech"].endswith("roads")
    assert second["score"] == round(second["score"], 4)


def test_equal_scores_rank_by_id(spark, index):
    found = sr.search(index, asked(spark, (1, "tax")), top_k=2).orderBy("rank").collect()
    assert [r["speech_id"] for r in found] == [2, 5]


def test_empty_and_unknown_queries_have_no_rows(spark, index):
    assert sr.search(index, asked(spark, (1, ""), (2, None), (3, "zz yy"), (4, "t x"))).count() == 0


def test_unknown_words_do_not_change_scores(spark, index):
    found = sr.search(index, asked(spark, (1, "school"), (2, "school zz zz"))).collect()
    assert len({r["score"] for r in found}) == 1


def test_repeated_words_count(spark, index):
    found = sr.search(index, asked(spark, (1, "tax reform"), (2, "tax tax tax reform")))
    top = {r["query_id"]: r["speech_id"] for r in found.filter("rank = 1").collect()}
    assert top == {1: 1, 2: 2}


def test_threshold_is_strict(spark):
    scored = spark.createDataFrame(
        [(1, 1, 0.05), (1, 2, 0.0500001), (1, 3, 0.9)], "query_id long, speech_id long, score double"
    )
    assert [r["speech_id"] for r in sr.best_matches(scored).orderBy("rank").collect()] == [3, 2]


def test_pages(spark):
    rows = [(1, i, 1.0 - i / 100) for i in range(50)]
    scored = spark.createDataFrame(rows, "query_id long, speech_id long, score double")
    page = sr.search_page(scored, page=2, size=20).orderBy("rank").collect()
    assert [r["speech_id"] for r in page] == list(range(20, 40))
    assert sr.search_page(scored, page=3, size=20).count() == 10
    for bad in (0, -1):
        with pytest.raises(ValueError):
            sr.search_page(scored, page=bad)
        with pytest.raises(ValueError):
            sr.best_matches(scored, top_k=bad)


def test_cursors_resume(spark):
    rows = [(q, i, round(1.0 - (i // 3) / 50, 9)) for q in (1, 2) for i in range(45 if q == 1 else 7)]
    scored = spark.createDataFrame(rows, "query_id long, speech_id long, score double").repartition(4)
    whole = sorted(tuple(r) for r in sr.best_matches(scored, 100).select("query_id", "rank", "speech_id").collect())
    cursors = spark.createDataFrame([(1, None, None, None), (2, None, None, None)], "query_id long, score double, speech_id long, rank int")
    shown = []
    while not cursors.isEmpty():
        page = sr.search_after(scored, cursors, size=10)
        shown += [tuple(r) for r in page.select("query_id", "rank", "speech_id").collect()]
        cursors = spark.createDataFrame(sr.next_cursors(page).collect(), cursors.schema)
    assert sorted(shown) == whole and len(whole) == 52
    with pytest.raises(ValueError):
        sr.search_after(scored, cursors, size=0)


def test_shards_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ix, "SHARD_ROWS", 1)
    cut = ix.build_index(spark.createDataFrame(SPEECHES, NAMES))
    found = sr.search(cut, asked(spark, (1, "tax reform"))).orderBy("rank").collect()
    assert [r["speech_id"] for r in found] == [1, 2, 5, 3]


def test_stored_index_gives_the_same(spark, index, stored):
    queries = asked(spark, (1, "tax reform"), (2, "roads school"))
    here = sr.search(index, queries).orderBy("query_id", "rank").collect()
    there = sr.search(stored, queries).orderBy("query_id", "rank").collect()
    assert here == there


def test_search_reads_only_the_buckets_of_its_terms(spark, stored):
    weights = sr.query_weights(stored, asked(spark, (1, "tax")).withColumn("clean_text", F.col("query")))
    plan = sr.score_queries(stored, weights)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


@pytest.mark.parametrize("which", ["index", "stored"])
def test_trend(spark, request, which):
    built = request.getfixturevalue(which)
    rows = [(1, "tax"), (2, "zz"), (3, ""), (4, "Reform tax")]
    words = spark.createDataFrame(rows, "word_id long, word string")
    series = trend.term_trend(built, words).orderBy("word_id", "year").collect()
    first = [(r["year"], round(r["score"], 6)) for r in series if r["word_id"] == 1]
    assert [year for year, _ in first] == [2000, 2001, 2002]
    assert first[1][1] == 2.0 and first[2][1] == 0.0
    rest = {r["word_id"]: (r["token"], r["found"], r["year"]) for r in series if r["word_id"] in (2, 3)}
    assert rest == {2: ("zz", False, None), 3: (None, False, None)}
    assert {r["token"] for r in series if r["word_id"] == 4} == {"reform"}


def test_search_weighs_only_its_postings(spark):
    """Scores from counts and norms are those of the whole weight table, also for ids that come twice, without its sort by speech."""
    rows = [(i % 7, f"alpha beta{i % 3} gamma{i} " + "alpha " * i) for i in range(10)]
    index = ix.build_index(spark.createDataFrame(rows, "speech_id long, clean_text string"))
    asked = spark.createDataFrame([(1, "alpha gamma8"), (2, "beta1 beta1 gamma3")], "query_id long, clean_text string")
    weights = sr.query_weights(index, asked)
    scored = sr.score_queries(index, weights)
    whole = sr.score_queries(dataclasses.replace(index, counts=None, norms=None), weights)
    found = {(r["query_id"], r["speech_id"]): r["score"] for r in scored.collect()}
    assert found == pytest.approx({(r["query_id"], r["speech_id"]): r["score"] for r in whole.collect()})
    assert "Window" in whole._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in scored._jdf.queryExecution().executedPlan().toString()
