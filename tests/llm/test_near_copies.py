"""Jaccard join, components and the pipeline's choice against comparing everything."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from corpuscope.llm import partenum
from corpuscope.llm.components import components
from corpuscope.llm.queries import QUERIES
from corpuscope.llm.shingles import shingle_set
from corpuscope.runtime import scratch_path

SMALL = "/root/testdata/sf0.001"


def shingles(text: str | None, words: int = 5) -> frozenset:
    found = (text or "").encode().lower().split()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))) if found else frozenset()


def brute_force(texts: dict, percent: int = 80) -> dict:
    """Component of every id, by comparing all pairs."""
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(k for k in texts if sets[k])
    for n, a in enumerate(keys):
        for b in keys[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in texts}


def edited(random_: random.Random, words: list[str], edits: int) -> list[str]:
    words = list(words)
    for _ in range(edits):
        words[random_.randrange(len(words))] = f"new{random_.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def texts() -> dict:
    """Groups of copies with few to many edits, chains, passages that many share, short texts."""
    r = random.Random(3)
    make = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    out, passage = [], make(60)
    for size in (6, 20, 60, 200, 900):
        for _ in range(4):
            base = make(size)
            out += [" ".join(edited(r, base, r.randrange(1 + size // 25))) for _ in range(5)]
    chain = make(100)
    for _ in range(12):  # neighbours are alike, the ends are not
        chain = edited(r, chain, 1)
        out.append(" ".join(chain))
    out += [" ".join(make(8) + passage + make(8)) for _ in range(40)]
    out += ["a b c", "A  b\tC", "a b c d", "", " \n", None, "x", "x", "é É x y z", "é é x y z"]
    out += [" ".join(make(80))] * 30
    return dict(enumerate(out))


def stored(spark, rows, schema="doc_id long, text string"):
    path = scratch_path(spark, "documents")
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("constants", [{}, {"_BLOCK": 7, "_RUN_PART": 3, "_STAR_PART": 2, "_BATCH": 11}])
def test_components_are_those_of_all_pairs(spark, texts, monkeypatch, constants):
    for name, value in constants.items():
        monkeypatch.setattr(partenum, name, value)
    rows, links = partenum.jaccard_components(stored(spark, list(texts.items())))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows.collect()} == brute_force(texts)
    for a, b in links.collect():
        x, y = shingles(texts[a]), shingles(texts[b])
        assert x != y and 100 * len(x & y) >= 80 * len(x | y)


@pytest.mark.parametrize("percent", [50, 95])
def test_other_thresholds(spark, texts, percent):
    rows, _ = partenum.jaccard_components(stored(spark, list(texts.items())), percent=percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows.collect()} == brute_force(texts, percent)


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(0)
    for size in (4, 5, 9, 17, 40, 133, 700, 3000):
        for _ in range(20):
            a = np.unique(r.integers(0, 2**63, size).astype(np.uint64))
            drop = r.integers(0, max(1, len(a) // 5))
            b = np.unique(np.r_[a[drop:], r.integers(0, 2**63, r.integers(0, 3)).astype(np.uint64)])
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both) and len(a) + len(b) > 2 * both:
                x, y = (partenum.signatures(s, partenum.Bands(80)) for s in (a, b))
                assert np.intersect1d(x, y).size


def test_sketch_distance_is_a_lower_bound(texts):
    sets = [shingle_set(t) for t in texts.values()]
    bins = [np.frombuffer(partenum.sketch(s), np.uint8).astype(int) for s in sets]
    for i in range(0, len(sets), 3):
        for j in range(0, i, 5):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert np.abs(bins[i] - bins[j]).sum() <= len(sets[i]) + len(sets[j]) - 2 * both


def sharing(r: np.random.Generator, n: int, both: int) -> tuple[np.ndarray, np.ndarray]:
    """Two sets of ``n`` that have ``both`` in common."""
    drawn = np.unique(r.integers(0, 2**63, 2 * n - both).astype(np.uint64))
    r.shuffle(drawn)
    return np.sort(drawn[:n]), np.sort(drawn[n - both :])


def test_finer_histograms_are_a_lower_bound_that_large_sets_reach():
    r = np.random.default_rng(4)
    assert partenum.finer(sharing(r, 512, 0)[0]) is None and len(partenum.finer(sharing(r, 513, 0)[0])) == 256
    sets = [s for n in (600, 2_000, 9_000, 40_000) for b in (0, n // 2, n - 5) for s in sharing(r, n, b)]
    sets.append(np.arange(1_000, dtype=np.uint64) << np.uint64(20))  # all in one bin
    for i, x in enumerate(sets):
        for y in sets[:i]:
            far = len(x) + len(y) - 2 * len(np.intersect1d(x, y))
            assert partenum.histogram_distance(partenum.finer(x), partenum.finer(y)) <= far
    x, y = sharing(r, 20_000, 12_000)  # a similarity of 0.43
    ruled_out = [partenum.histogram_distance(f(x), f(y)) * 180 > 20 * 40_000 for f in (partenum.sketch, partenum.finer)]
    assert ruled_out == [False, True]


def test_pairs_of_large_sets_are_ruled_out_before_texts_are_read(spark):
    r = np.random.default_rng(6)
    (a, b), c, (d, _) = sharing(r, 3_000, 2_900), sharing(r, 3_000, 0)[0], sharing(r, 40, 0)
    sets = [(1, a), (2, b), (3, c), (4, d), (5, c), (5, a)]  # 5 has two sets
    schema = "id long, n long, finer binary"
    sets = spark.createDataFrame([(i, len(s), partenum.finer(s)) for i, s in sets], schema)
    pairs = spark.createDataFrame([(1, 2, 9), (1, 3, 9), (1, 4, 9), (1, 5, 9), (3, 5, 9), (2, 3, 9)], "a long, b long, size long")
    kept = partenum._near_in_detail(pairs, sets, 80)
    assert sorted(map(tuple, kept.distinct().collect())) == [(1, 2, 9), (1, 4, 9), (1, 5, 9), (3, 5, 9)]
    assert partenum._near_in_detail(pairs.limit(0), sets, 80).count() == 0


def test_nulls_repeats_and_clashing_names(spark):
    schema = "doc_id long, text string, id string, n string, digest string, component_id string"
    long = " ".join(map(str, range(30_000)))
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "A B C D E F"), (3, None), (2, long), (9, long), (8, "a b c d e f")]
    docs = stored(spark, [(*r, "x", None, "y", None) for r in rows], schema)
    found = Counter(map(tuple, partenum.jaccard_components(docs)[0].collect()))
    n = 30_000 - 4
    assert found == Counter([(5, 2, 5), (5, 2, 5), (None, 2, None), (7, 2, 5), (3, 0, 3), (2, n, 2), (9, n, 2), (8, 2, 5)])
    assert partenum.jaccard_components(docs.limit(0))[0].count() == 0


def test_query_on_its_table(spark):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op1_ngram_jaccard"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_force(texts)


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(3, 3), (None, 4), (200, 201), (201, 200)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 60)} | {200: 200, 201: 200}


def test_pipeline_keeps_one_of_each_group(spark, texts):
    docs = stored(spark, [(k, t, "en", "s", 0) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, (_, c) in brute_force(texts).items() if k == c)


def test_a_million_words_in_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(partenum, "_BUCKETS_EACH", 1)
    r = random.Random(5)
    words = [f"w{r.randrange(10**6)}" for _ in range(1_000_000)]
    near = edited(r, words, 9_000)
    texts = {1: " ".join(words), 2: " ".join(near), 3: " ".join(words[:500_000]), 4: "a few words " * 5}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found, links = partenum.jaccard_components(docs)
        assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
        assert [tuple(r) for r in links.collect()] == [(1, 2)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pairs_and_groups_of_several_buckets_are_kept_once():
    pairs = [np.array([[1, 2, 2], [1, 3, 5]]), np.array([[1, 2, 7], [4, 9, 2]])]
    groups = {(11, 0): (3, np.array([1, 2, 3])), (11, 1): (3, np.array([4]))}
    twice = [*partenum._packed(pairs, groups, 3), *partenum._packed(pairs[1:], groups, 3)]
    rows = [row for table in partenum._met_once(twice) for row in table.to_pylist()]
    assert sorted((r["a"], r["b"], r["size"]) for r in rows if r["kind"] == 0) == [(1, 2, 7), (1, 3, 5), (4, 9, 2)]
    assert sorted((r["a"], r["b"], r["size"], r["members"]) for r in rows if r["kind"] == 1) == [(11, 0, 3, [1, 2, 3]), (11, 1, 3, [4])]
    # The same pair goes to the same task, whoever finds it.
    targets = [{row["target"] for row in t.to_pylist()} for t in partenum._packed([pairs[0][:1]], {}, 50)]
    again = [{row["target"] for row in t.to_pylist()} for t in partenum._packed([pairs[1][:1]], {}, 50)]
    assert targets == again
