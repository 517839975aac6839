"""Exact sizes, uniform places, the hypergeometric numbers against their probabilities."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from corpuscope.llm import shards
from corpuscope.llm.queries import op12_exact_shards


@pytest.mark.parametrize("limit", [10**9, 0])
def test_hypergeometric(monkeypatch, limit):
    monkeypatch.setattr(shards, "NUMPY_POPULATION", limit)
    rng = np.random.default_rng(1)
    for good, bad, draws in [(6, 9, 7), (3, 0, 2), (0, 4, 3), (5, 5, 10), (40, 3, 20)]:
        seen = Counter(shards.hypergeometric(rng, good, bad, draws) for _ in range(6000))
        for k in range(draws + 1):
            p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
            assert abs(seen[k] / 6000 - p) <= 5 * math.sqrt(p * (1 - p) / 6000) + 1e-9
    big = shards.hypergeometric(rng, 30 * 10**9, 50 * 10**9, 10**6)
    assert abs(big - 375_000) < 6 * math.sqrt(10**6 * 0.375 * 0.625)


def test_margins():
    for sizes in ([5, 0, 17, 1], [0], [], [1000] * 50):
        wanted = shards.shard_sizes(sum(sizes), 7)
        assert max(wanted) - min(wanted) <= 1 and sum(wanted) == sum(sizes)
        matrix = shards.communication_matrix(sizes, wanted, 3)
        assert matrix.sum(1).tolist() == sizes and (matrix >= 0).all()
        assert matrix.sum(0).tolist() == wanted


def stored(spark, tmp_path, rows, schema, files=3):
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


def test_rows_stay_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shards, "SLICE_ROWS", 3)
    rows = [(i if i % 5 else None, ["same", "", None, "é" * 90_000, f"t{i}"][i % 5 if i < 40 else 0], i, "x") for i in range(203)]
    docs = stored(spark, tmp_path, rows, "doc_id long, text string, shard int, Slot string")
    found = shards.shuffled(docs, 4).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(r[:2] for r in rows)
    sizes = Counter(r.shard for r in found)
    assert sorted(sizes.values()) == [50, 51, 51, 51]
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(n)) for s, n in sizes.items())
    assert Counter(shards.shuffled(docs, 4).collect()) == Counter(found)
    assert Counter(shards.shuffled(docs, 4, seed=1).collect()) != Counter(found)


def test_places_are_uniform(spark, tmp_path):
    docs = stored(spark, tmp_path, [(i,) for i in range(48)], "doc_id long")
    seen: Counter = Counter()
    for seed in range(25):
        seen.update((r.doc_id // 12, 2 * r.shard + r.slot // 6) for r in shards.shuffled(docs, 4, seed).collect())
    expected = 25 * 12 * 12 // 8 / 12  # each quarter of the rows falls into eighths of the places alike
    statistic = sum((seen[q, e] - expected) ** 2 / expected for q in range(4) for e in range(8))
    assert statistic < 50  # 21 degrees of freedom


def test_nothing_and_fewer_rows_than_shards(spark, tmp_path):
    docs = stored(spark, tmp_path, [(1,), (2,), (2,)], "doc_id long")
    assert sorted((r.shard, r.slot) for r in shards.shuffled(docs, 16).collect()) == [(0, 0), (1, 0), (2, 0)]
    spark.createDataFrame([], "doc_id long").write.parquet(str(tmp_path / "none"))
    assert shards.shuffled(spark.read.parquet(str(tmp_path / "none")), 16).count() == 0


def test_other_partitions_are_an_error(spark, tmp_path, monkeypatch):
    docs = stored(spark, tmp_path, [(i,) for i in range(50)], "doc_id long")
    drawn = shards.communication_matrix

    def fewer(sizes, wanted, seed):
        matrix = drawn(sizes, wanted, seed)
        matrix[0, matrix[0].argmax()] -= 1
        return matrix

    monkeypatch.setattr(shards, "communication_matrix", fewer)
    with pytest.raises(Exception, match="more rows than"):
        shards.shuffled(docs, 16).collect()


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = op12_exact_shards(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(found) == len(texts) and {r.doc_id for r in found} == set(texts)
    for r in found:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    sizes = Counter(r.shard for r in found)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1


def test_written_shards(spark, tmp_path):
    docs = stored(spark, tmp_path, [(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    shards.write_shards(shards.shuffled(docs, 4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "shard=3")).count() == 25
