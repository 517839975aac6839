"""Vectors: links against all pairs, neighbours against a full search."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscope.llm import forest, tiles
from corpuscope.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def takes_part(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosines(vectors: list) -> np.ndarray:
    unit = np.array(vectors, float)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    return unit @ unit.T


def brute_force_links(rows: list, least: float) -> list:
    """(id, links, component, kept) of every row."""
    out = {}
    use = [(i, v) for i, v in rows if i is not None and takes_part(v)]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for n in {len(v) for _, v in use}:
        own = [(i, v) for i, v in use if len(v) == n]
        near = cosines([v for _, v in own]) >= least
        for a in range(len(own)):
            for b in range(a):
                if near[a, b]:
                    links[own[a][0]] += 1
                    links[own[b][0]] += 1
                    x, y = find(own[a][0]), find(own[b][0])
                    root[max(x, y)] = min(x, y)
    for i, _ in rows:
        out[i] = (i, links[i], find(i) if i is not None else None, i is not None and find(i) == i)
    return sorted(out.values(), key=lambda r: (r[0] is None, r[0] or 0))


def made(seed: int = 1, width: int = 12) -> list:
    r = np.random.default_rng(seed)
    base = r.standard_normal((30, width))
    rows = [base[i % 30] + r.standard_normal(width) * (0.02 + 0.3 * (i % 7 == 0)) for i in range(300)]
    rows += [base[0]] * 25 + [2 * base[0]] + [base[1] * 1e-200, base[1] * 1e200]
    out = [(int(i), [float(x) for x in v]) for i, v in enumerate(rows)]
    bad = [None, [0.0] * width, [float("nan")] * width, [None] * width, [float("inf")] + [1.0] * (width - 1), []]
    out += [(1000 + i, v) for i, v in enumerate(bad)]
    return out + [(2000, [1.0, 2.0, 3.0]), (2001, [2.0, 4.0, 6.0]), (2002, [1.0])]


@pytest.mark.parametrize("tile,block", [(8_192, 1_024), (16, 5)])
@pytest.mark.parametrize("least", [0.95, 0.6])
def test_links_are_those_of_all_pairs(spark, monkeypatch, tile, block, least):
    monkeypatch.setattr(tiles, "TILE", tile)
    monkeypatch.setattr(tiles, "BLOCK", block)
    rows = [(i, v) for i, v in made() if i not in (326, 327)]  # at the ends of doubles a plain norm is no measure
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, key string, copies int")
    found = tiles.near_vectors(table, least).collect()
    assert sorted(map(tuple, found)) == brute_force_links(rows, least)


def test_links_of_repeated_rows_null_ids_and_nothing(spark):
    v, w = [1.0, 0.0], [0.0, 1.0]
    rows = [(1, v), (1, v), (2, v), (None, v), (3, w), (None, None), (4, [3.0, 4.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = Counter(map(tuple, tiles.near_vectors(table).collect()))
    assert found == Counter([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, False), (3, 0, 3, True), (None, 0, None, False), (4, 0, 4, True)])
    assert tiles.near_vectors(table.limit(0)).count() == 0
    assert [r.component_id for r in tiles.near_vectors(table.filter("vec_id = 4")).collect()] == [4]


def test_links_at_the_threshold(spark):
    """Pairs some last digits above and below the threshold, in vectors that are turned."""
    r = np.random.default_rng(3)
    rows, expected = [], {}
    for n, gap in enumerate([-1e-9, -2e-13, -5e-14, -5e-15, 5e-15, 5e-14, 2e-13, 1e-9] * 5):
        a, b = np.linalg.qr(r.standard_normal((40, 2)))[0].T
        v = [2 * a, 3 * (0.95 * a + math.sqrt(1 - 0.95**2) * b)]
        v[1] += 3 * gap * a  # the length changes by 0.95 of the gap, the cosine by a tenth of it
        rows += [(2 * n, v[0].tolist()), (2 * n + 1, v[1].tolist())]
        units = tiles._unit(np.array(v))
        expected[n] = (units[0] * units[1]).sum() >= 0.95
    assert 10 < sum(expected.values()) < 30
    found = {r.vec_id: r for r in tiles.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    for n, linked in expected.items():
        assert [found[2 * n].n_links, found[2 * n + 1].n_links] == [int(linked)] * 2
        assert found[2 * n + 1].component_id == 2 * n + (not linked)


def test_links_where_every_pair_is_at_the_threshold(spark):
    rows = [(i, [3.0 if i == j else 1.0 for j in range(5)]) for i in range(5)] * 2
    least = 10 / 13 - 1e-15  # of any two different vectors: (3 + 3 + 1 + 1 + 1) / 13 is 9 / 13
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.n_links for r in tiles.near_vectors(table, least).collect()} == {1}
    assert {(r.n_links, r.component_id) for r in tiles.near_vectors(table, 9 / 13 - 1e-15).collect()} == {(9, 0)}


def test_links_query_on_its_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = QUERIES["op6_near_vectors"](spark, SMALL).collect()
    assert sorted(map(tuple, found)) == brute_force_links([tuple(r) for r in rows], 0.95)


def brute_force_nearest(rows: list, queries: set, k: int) -> dict:
    use = sorted({(i, tuple(v)) for i, v in rows if i is not None and takes_part(v)})
    out = {}
    for i, v in use:
        if i in queries:
            scored = [(-float(cosines([v, w])[0, 1]), j) for j, w in use if j != i and len(w) == len(v)]
            out[i] = sorted((round(s, 12), j) for s, j in scored)[:k]
    return out


def test_all_leaves_give_the_exact_neighbours(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF_SAMPLE", 8)
    monkeypatch.setattr(forest, "PART_ENTRIES", 20)
    monkeypatch.setattr(forest, "PART_QUERIES", 3)
    monkeypatch.setattr(forest, "REGIONS", 5)
    rows = [r for r in made() if r[0] not in (326, 327)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, query string")
    queries = set(range(0, 3000, 9)) | {2000, 300, 325}
    found = forest.nearest(table, F.col("vec_id").isin(list(queries)), share=100.0, trees=3).collect()
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((round(-r.score, 12), r.vec_id))
    expected = {q: n for q, n in brute_force_nearest(rows, queries, 6).items() if n}
    assert set(got) == set(expected)
    alone = 0
    for q in expected:
        scores = np.array([s for s, _ in expected[q]])
        assert np.allclose([s for s, _ in got[q]], scores[:5], atol=1e-9)
        for i, (s, j) in enumerate(expected[q][:5]):
            if (np.abs(scores - s) < 1e-9).sum() == 1:  # where no other vector is as near, it is this one
                assert got[q][i][1] == j
                alone += 1
    assert alone > 100  # not an empty comparison


def test_copies_ties_and_nothing(spark):
    rows = [(i, [1.0, 1.0]) for i in range(1, 12)] + [(20, [1.0, 0.0]), (21, None), (22, [0.0, 0.0]), (None, [1.0, 1.0]), (5, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = forest.nearest(table, F.col("vec_id") == 3).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in found] == [(1, 1), (2, 2), (3, 4), (4, 5), (5, 6)]
    assert all(abs(r.score - 1) < 1e-12 for r in found)
    assert forest.nearest(table, F.col("vec_id").isin(21, 22)).count() == 0
    assert forest.nearest(table.limit(0), F.col("vec_id") == 3).count() == 0
    few = forest.nearest(table.filter("vec_id IN (1, 20)"), F.col("vec_id") == 1).collect()
    assert [(r.rank, r.vec_id) for r in few] == [(1, 20)]


@pytest.mark.parametrize("dense", [False, True])
def test_walks_are_as_long_as_the_vectors_need(spark, monkeypatch, dense):
    """Vectors in groups need few leaves; one dense region of half the table is searched in parts."""
    lengths = []
    measure = forest._enough
    monkeypatch.setattr(forest, "_enough", lambda *given: lengths.append(measure(*given)) or lengths[-1])
    monkeypatch.setattr(forest, "PART_ENTRIES", 100)
    r = np.random.default_rng(5)
    centres = r.standard_normal((60, 24))
    groups = np.zeros(3000, int) if dense else r.integers(0, 60, 3000)
    groups[1500:] = r.integers(0, 60, 1500)
    points = centres[groups] + 0.1 * r.standard_normal((3000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = defaultdict(set)
    for row in forest.nearest(table, F.col("vec_id") % 20 == 0).collect():
        found[row.query_id].add(row.vec_id)
    scores = cosines(points.tolist())
    np.fill_diagonal(scores, -2)
    exact = {q: set(np.argsort(-scores[q])[:5].tolist()) for q in range(0, 3000, 20)}
    assert all(len(found[q]) == 5 for q in exact)
    assert sum(len(found[q] & exact[q]) for q in exact) >= 0.9 * 5 * len(exact)
    # With repeats over the trees; on vectors that point everywhere it is more than the table.
    assert lengths[0] < 3000 * (0.9 if dense else 0.25)


def test_recall_of_the_query(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect() if takes_part(r.embedding)]
    ids = np.array([i for i, _ in rows])
    scores = cosines([v for _, v in rows])
    found = defaultdict(set)
    for r in QUERIES["op2_nearest_vectors"](spark, path).collect():
        found[r.query_id].add(r.vec_id)
    hits = total = 0
    for at in np.flatnonzero(ids % 50 == 0):
        own = scores[at].copy()
        own[at] = -2
        exact = {int(ids[j]) for j in np.lexsort((ids, -np.round(own, 12)))[:5]}
        hits += len(exact & found[int(ids[at])])
        total += 5
    assert total and hits / total >= 0.9
