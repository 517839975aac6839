"""Pruned search against the scores of all matches, and how much of it is left unread."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuscope.operators import blocks as bl, index as ix, search as sr
from corpuscope.runtime import scratch_path
from corpuscope.sources.indexes import load_blocks, save_blocks


def corpus(spark, n: int):
    draw = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    share = [1 / (i + 1) for i in range(300)]
    rows = []
    for i in range(n):
        said = ["every", *draw.choices(words, share, k=draw.randint(3, 60))]
        if i % 40 == 0:
            said += ["rare"] * draw.randint(1, 9)
        if i % 3 == 0:
            said = ["copy", "of", "one", "speech", "every"]  # a third of all rows, all with the same scores
        rows.append((i, " ".join(said)))
    return spark.createDataFrame(rows, "speech_id long, clean_text string")


ASKED = [(1, "every"), (2, "every rare"), (3, "w1 w2 w3 w250"), (4, "copy speech"), (5, "rare w299 every every"), (6, "none"), (7, "w0 w0 w1")]


@pytest.fixture(scope="module")
def index(spark):
    return ix.build_index(corpus(spark, 1500))


def rows_of(matches):
    return Counter((r.query_id, r.rank, r.speech_id, round(r.score, 9)) for r in matches.collect())


@pytest.mark.parametrize("block_rows", [16, 4096])
@pytest.mark.parametrize("top_k, min_score", [(10, 0.05), (3, 0.0), (400, 0.2)])
def test_the_same_rows(spark, index, block_rows, top_k, min_score):
    asked = spark.createDataFrame(ASKED, "query_id long, clean_text string")
    weights = sr.query_weights(index, asked)
    wanted = rows_of(sr.best_matches(sr.score_queries(index, weights), top_k, min_score))
    found, read = bl.search_blocks(bl.build_blocks(index, block_rows), weights, top_k, min_score)
    assert rows_of(found) == wanted
    df = {r.term: r.df for r in index.terms.collect()}
    counted = read.collect()
    assert all(r.postings == df[r.term] and 0 <= r.read <= r.postings for r in counted)


def test_a_frequent_term_is_hardly_read(spark, index):
    asked = spark.createDataFrame(ASKED, "query_id long, clean_text string")
    weights = sr.query_weights(index, asked)
    _, read = bl.search_blocks(bl.build_blocks(index, 16), weights, 10, 0.05)
    by = {(r.query_id, r.term): r for r in read.collect()}
    assert by[2, "every"].postings == 1500 and by[2, "every"].read == 0  # only speeches with "rare" can win
    assert 10 <= by[1, "every"].read <= 600
    assert sum(r.read for r in by.values()) < 0.6 * sum(r.postings for r in by.values())


def test_shards_and_stored_blocks(spark, index, monkeypatch):
    monkeypatch.setattr(ix, "SHARD_ROWS", 100)
    cut = ix.build_index(corpus(spark, 1500))
    assert cut.weights.agg(F.max("shard")).first()[0] >= 10
    path = scratch_path(spark, "test-blocks")
    save_blocks(bl.build_blocks(cut, 16), path, buckets=8)
    asked = spark.createDataFrame(ASKED, "query_id long, clean_text string")
    weights = sr.query_weights(cut, asked)
    wanted = rows_of(sr.best_matches(sr.score_queries(index, sr.query_weights(index, asked))))
    found, _ = bl.search_blocks(load_blocks(spark, path), weights)
    assert rows_of(found) == wanted


def test_a_stored_search_reads_the_buckets_it_chose(spark, index, monkeypatch):
    path = scratch_path(spark, "test-blocks")
    save_blocks(bl.build_blocks(index, 16), path, buckets=8)
    seen = []
    read = bl._read
    monkeypatch.setattr(bl, "_read", lambda *a: seen.append(read(*a)) or seen[-1])
    asked = spark.createDataFrame([(2, "every rare")], "query_id long, clean_text string")
    bl.search_blocks(load_blocks(spark, path), sr.query_weights(index, asked))
    assert len(seen) == 2
    for df in seen:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan
        assert "In(term, [" in plan or "EqualTo(term," in plan


def test_nothing(spark):
    none = ix.build_index(spark.createDataFrame([], "speech_id long, clean_text string"))
    asked = spark.createDataFrame([(1, "a b")], "query_id long, clean_text string")
    found, read = bl.search_blocks(bl.build_blocks(none), sr.query_weights(none, asked))
    assert found.count() == 0 and read.count() == 0
    with pytest.raises(ValueError):
        bl.search_blocks(bl.build_blocks(none), sr.query_weights(none, asked), top_k=0)


def test_candidates_carry_no_queries_and_blocks_are_made_once(spark, index, monkeypatch):
    """Speeches meet the terms of the queries, so no candidate holds its whole query; vectors come from the blocks as written."""
    seen = {}
    write = bl.written
    monkeypatch.setattr(bl, "written", lambda df, name: seen.setdefault(name, df) and write(df, name))
    asked = spark.createDataFrame(ASKED, "query_id long, clean_text string")
    weights = sr.query_weights(index, asked)
    built = bl.build_blocks(index, 16)
    assert not seen
    found, _ = bl.search_blocks(built, weights)
    assert rows_of(found) == rows_of(sr.best_matches(sr.score_queries(index, weights)))
    assert seen["candidates"].columns == ["query_id", "speech_id"]
    assert "Window" not in seen["speech-vectors"]._jdf.queryExecution().executedPlan().toString()
