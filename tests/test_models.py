"""Similarity, topics, clusters, samples and numbers against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from corpuscope.operators import clusters, index as ix, numbering, sampling, similarity, topics
from corpuscope.runtime import scratch_path


def corpus(n: int, seed: int = 0) -> list[tuple[int, str]]:
    """Texts over a skewed vocabulary, with a few near copies."""
    rng = random.Random(seed)
    texts: list[str] = []
    for i in range(n):
        if i % 7 == 3:
            texts.append(texts[-1] + f" extra{i}")
            continue
        words = [f"w{min(int(rng.expovariate(0.08)), 60):02d}" for _ in range(rng.randint(5, 30))]
        texts.append(" ".join(words))
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def clean(spark):
    return spark.createDataFrame(corpus(60), ["speech_id", "clean_text"]).repartition(4)


def dense(min_df: int = 1) -> tuple[np.ndarray, list[str]]:
    bags = [Counter(text.split()) for _, text in corpus(60)]
    df = Counter(term for bag in bags for term in bag)
    terms = sorted(t for t in df if df[t] >= min_df)
    matrix = np.array([[bag[t] * (np.log(61 / (1 + df[t])) + 1) for t in terms] for bag in bags])
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True), terms


@pytest.mark.parametrize("min_sim", [0.0, 0.1, 0.5, 0.8])
@pytest.mark.parametrize("limit", [None, 5, 25])
@pytest.mark.parametrize("small", [True, False])
def test_similar_pairs(clean, monkeypatch, min_sim, limit, small):
    if not small:  # blocks, tails and a raised threshold
        monkeypatch.setattr(similarity, "BLOCK_ROWS", 7)
        monkeypatch.setattr(similarity, "FEW_ENTITIES", 10)
    matrix, _ = dense()
    cosines = matrix @ matrix.T
    pairs = [(i, j, cosines[i, j]) for i in range(60) for j in range(i + 1, 60)]
    wanted = sorted((p for p in pairs if p[2] > min_sim), key=lambda p: (-round(p[2], 9), p[0], p[1]))
    found = similarity.similar_pairs(clean, "speech_id", min_sim, limit).collect()
    found = sorted(map(tuple, found), key=lambda p: (-round(p[2], 9), p[0], p[1]))
    assert [p[:2] for p in found] == [p[:2] for p in wanted[:limit]]
    assert [p[2] for p in found] == pytest.approx([p[2] for p in wanted[:limit]])


@pytest.mark.parametrize("copies", [2, 40])
def test_pairs_of_copies_are_not_all_made(spark, monkeypatch, copies):
    """Of many equal texts only those are compared that can be among the best pairs, and these come in order."""
    monkeypatch.setattr(similarity, "FEW_ENTITIES", 10)
    texts = [text for _, text in corpus(30)]
    rows = [(i * 100 + c, text) for i, text in enumerate(texts) for c in range(copies)]
    made = []
    sums = similarity._sums
    monkeypatch.setattr(similarity, "_sums", lambda joined: made.append(sums(joined)) or made[-1])
    found = similarity.similar_pairs(spark.createDataFrame(rows, ["speech_id", "clean_text"]), "speech_id", 0.1, 6).collect()
    equal = [(a, b) for a, s in rows for b, t in rows if a < b and Counter(s.split()) == Counter(t.split())]
    assert [(r["a"], r["b"]) for r in found] == sorted(equal)[:6]
    assert [r["similarity"] for r in found] == pytest.approx([1.0] * 6)
    assert made[-1].count() < 10_000  # of the 23,400 pairs of copies alone; seven of each text are left


@pytest.mark.parametrize("broadcast", [True, False])
def test_latent_topics(clean, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(ix, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(ix, "HOT_TERMS", 3)
    matrix, terms = dense(min_df=5)
    u, s, vt = np.linalg.svd(matrix, full_matrices=False)
    found = topics.latent_topics(clean, k=3, min_df=5, passes=12)
    assert found.sigma == pytest.approx(list(s[:3]), rel=1e-6)
    loadings = {(r["topic"], r["term"]): r["loading"] for r in found.topic_terms.collect()}
    vectors = {r["speech_id"]: r["topics"] for r in found.doc_topics.collect()}
    for k in range(3):
        sign = np.sign(vt[k][np.argmax(np.abs(vt[k]))])
        got = np.array([loadings[k + 1, term] for term in terms])
        assert got == pytest.approx(sign * vt[k], abs=1e-5)
        scores = np.array([vectors[i][k] for i in range(60)])
        assert scores == pytest.approx(sign * u[:, k] * s[k], abs=1e-5)


def test_topics_of_low_rank(spark):
    rows = [(i, "aa bb" if i % 2 else "cc dd") for i in range(12)]
    found = topics.latent_topics(spark.createDataFrame(rows, ["speech_id", "clean_text"]), k=5)
    assert found.sigma == pytest.approx([6**0.5, 6**0.5])


def test_speeches_without_a_frequent_term_have_zeros(spark):
    rows = [(i, "aa bb" if i % 2 else "bb cc") for i in range(6)] + [(6, "rare words"), (7, "")]
    clean = spark.createDataFrame(rows, ["speech_id", "clean_text"])
    found = topics.latent_topics(clean, k=2, min_df=3)
    vectors = {r["speech_id"]: r["topics"] for r in found.doc_topics.collect()}
    assert sorted(vectors) == list(range(8))
    assert vectors[6] == vectors[7] == [0.0, 0.0] and any(vectors[0])
    attached = topics.attach_topics(clean, found.doc_topics, dims=2)
    assert attached.count() == 8 and {"Topic_1", "Topic_2"} <= set(attached.columns)
    grouped = clusters.cluster_topics(found.doc_topics, k=3, n_init=2)
    assert grouped.assigned.count() == 8


def points(spark, n=200, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(4, 3)) * 10
    rows = [(i, [float(x) for x in centers[i % 4] + rng.normal(size=3)]) for i in range(n)]
    return spark.createDataFrame(rows, "speech_id long, topics array<double>").repartition(4)


def test_kmeans_numbers_clusters_by_size(spark):
    df = points(spark).filter("speech_id % 4 > 0 OR speech_id < 100")
    grouped = clusters.cluster_topics(df, k=4, n_init=3)
    sizes = [tuple(r) for r in clusters.cluster_sizes(grouped.assigned).collect()]
    assert sizes == [(0, 50), (1, 50), (2, 50), (3, 25)]
    rows = grouped.assigned.collect()
    inertia = sum(
        float(np.square(np.array(r["topics"]) - grouped.centroids[r["cluster_id"]]).sum()) for r in rows
    )
    assert grouped.cost == pytest.approx(inertia, rel=1e-6)


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_assignment_in_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(clusters, "_CHUNK", chunk)
    centers, ids = [[0.0, 0.0], [2.0, 0.0], [4.0, 0.0]], [7, 3, 5]
    rows = [(0, [0.4, 0.0]), (1, [1.0, 0.0]), (2, [3.1, 5.0]), (3, [3.0, 0.0])]
    df = spark.createDataFrame(rows, "speech_id long, topics array<double>")
    found = {r["speech_id"]: r["cluster_id"] for r in clusters.assign_clusters(df, centers, ids=ids).collect()}
    assert found == {0: 7, 1: 3, 2: 5, 3: 3}  # ties go to the lower id


def test_size_report(spark):
    rows = [(c,) for c, n in enumerate([9, 4, 4, 7, 1, 2]) for _ in range(n)]
    report = clusters.cluster_size_report(spark.createDataFrame(rows, "cluster_id int"), n=2, small=5)
    got = {(r["part"], r["rank"]): (r["cluster_id"], r["n_speeches"]) for r in report.collect()}
    assert got == {
        ("largest", 1): (0, 9),
        ("largest", 2): (3, 7),
        ("smallest", 1): (4, 1),
        ("smallest", 2): (5, 2),
        ("small", 1): (None, 4),
    }


@pytest.mark.parametrize("rows_per_slice", [3, 1000])
def test_numbers_are_consecutive(spark, monkeypatch, rows_per_slice):
    monkeypatch.setattr(numbering, "_ROWS_PER_SLICE", rows_per_slice)
    ids = random.Random(5).sample(range(10_000), 50)
    df = spark.createDataFrame([(i,) for i in ids], ["id"]).repartition(5)
    numbered, total = numbering.number_rows(df, "id", "n")
    assert total == 50
    got = sorted((r["n"], r["id"]) for r in numbered.collect())
    assert got == list(enumerate(sorted(ids), start=1))


@pytest.mark.parametrize("few", [0, 10_000])
@pytest.mark.parametrize("n", [0, 1, 17, 199, 200, 201])
def test_exact_sample(spark, monkeypatch, few, n):
    monkeypatch.setattr(sampling, "_FEW_ROWS", few)
    df = spark.range(200).withColumnRenamed("id", "speech_id").repartition(3)
    got = sorted(r[0] for r in sampling.sample_exact(df, n, seed=7).collect())
    order = sorted(range(200), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())
    assert got == (sorted(order[:n]) if n <= 200 else [])


def test_sentiment_is_unchanged_by_a_second_copy(spark):
    from corpuscope.operators.sentiment import sentiment_by_year

    rows = [("1/1/2000", "ελπίδα"), ("1/2/2000", "κρίση κρίση"), ("2/2/2001", "δεν ελπίδα"),
            ("bad", "ελπίδα"), ("1/1/2000", None)]
    df = spark.createDataFrame(rows, "sitting_date string, speech string")
    once = sorted(map(tuple, sentiment_by_year(df).collect()))
    assert once == [(2000, 0.0), (2001, -1.0)]
    assert sorted(map(tuple, sentiment_by_year(df.union(df)).collect())) == once


def test_top_topics_of_clusters(spark):
    df = spark.createDataFrame([(0, 0.5, 0.05), (0, 0.5, 0.05), (1, 0.01, 0.0765)],
                               "cluster_id int, Topic_1 double, Topic_2 double")
    means = clusters.cluster_topic_means(df)
    best = sorted(map(tuple, clusters.cluster_top_topics(means).collect()))
    assert best == [(0, "Topic_1", 0.5), (1, "Topic_2", 0.076)]
    with pytest.raises(ValueError):
        clusters.cluster_topic_means(df.select("cluster_id"))
    assert df.filter(F.lit(False)).count() == 0


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_triangles_keep_small_singular_values(spark, partitions):
    """Inner products would lose a direction that is 1e-9 of the strongest."""
    rng = np.random.default_rng(3)
    left, _ = np.linalg.qr(rng.normal(size=(400, 4)))
    right, _ = np.linalg.qr(rng.normal(size=(4, 4)))
    wanted = np.array([1.0, 1e-2, 1e-5, 1e-9])
    matrix = left * wanted @ right.T
    names = topics._names(4)
    table = spark.createDataFrame(matrix.tolist(), names).repartition(partitions)
    sigma, vectors = topics._spectrum(topics._triangle(table, names))
    assert np.allclose(sigma, wanted, rtol=1e-5)
    basis = matrix @ vectors / sigma
    assert np.abs(basis.T @ basis - np.eye(4)).max() < 1e-5
    empty = topics._spectrum(topics._triangle(table.limit(0), names))
    assert len(empty[0]) == 0


def test_weights_stay_in_their_parts(clean, monkeypatch):
    """Products come from many small parts, and no pass shuffles the weights again."""
    monkeypatch.setattr(topics, "MATRIX_ROWS", 50)
    wanted, terms = dense(min_df=5)
    matrix = topics.term_matrix(ix.term_counts(clean, "speech_id"), min_df=5)
    try:
        assert matrix.rows.rdd.getNumPartitions() > 8
        block = matrix.terms.select("t", F.length("term").cast("double").alias("q0"), F.col("df").cast("double").alias("q1"))
        numbers = {r["term"]: (r["t"], len(r["term"]), r["df"]) for r in matrix.terms.collect()}
        dense_block = np.array([numbers[term][1:] for term in terms], dtype=float)
        images = {r["speech_id"]: [r["q0"], r["q1"]] for r in matrix.by_speech(block, ["q0", "q1"]).collect()}
        assert np.array([images[i] for i in range(60)]) == pytest.approx(wanted @ dense_block)
        product = matrix.back_and_forth(block, ["q0", "q1"])
        back = {r["t"]: [r["q0"], r["q1"]] for r in product.collect()}
        assert np.array([back[numbers[term][0]] for term in terms]) == pytest.approx(wanted.T @ wanted @ dense_block)
        plan = product._jdf.queryExecution().executedPlan().toString()
        cached = [line for line in plan.split("InMemoryRelation")[0].splitlines() if "Exchange" in line and "entries" in line]
        assert not cached
    finally:
        matrix.release()


def test_kmeans_starts_share_their_passes(spark, monkeypatch):
    """The passes over the vectors do not multiply with the starts, and the result is that of MLlib's own iterations."""
    df = spark.createDataFrame(
        [(i, [float(x) for x in row]) for i, row in enumerate(np.random.default_rng(5).normal(size=(400, 4)))],
        "speech_id long, topics array<double>",
    ).repartition(3)
    kept = df.select(array_to_vector("topics").alias("features")).cache()
    models = [KMeans(k=12, seed=42 + start, maxIter=300).fit(kept) for start in range(6)]
    best = min(models, key=lambda model: model.summary.trainingCost)
    passes = []
    sums = clusters._sums
    monkeypatch.setattr(clusters, "_sums", lambda packed, starts: passes.append(len(starts)) or sums(packed, starts))
    grouped = clusters.cluster_topics(df, k=12, n_init=6)
    assert grouped.cost == pytest.approx(best.summary.trainingCost, rel=1e-9)
    wanted = sorted(tuple(np.round(center, 6)) for center in best.clusterCenters())
    found = sorted(tuple(np.round(center, 6)) for center in grouped.centroids)
    assert np.array(found) == pytest.approx(np.array(wanted), abs=2e-6)
    assert len(passes) <= max(model.summary.numIter for model in models) + 1 and passes[0] == 6


def test_kmeans_passes_use_all_cores(spark, monkeypatch):
    """Vectors that come in one split, as a small table does, are dealt to all cores for the passes."""
    seen = []
    sums = clusters._sums
    monkeypatch.setattr(clusters, "_sums", lambda packed, starts: seen.append(packed.rdd.getNumPartitions()) or sums(packed, starts))
    found = clusters.cluster_topics(points(spark, 80).coalesce(1), k=4, n_init=2)
    assert min(seen) >= spark.sparkContext.defaultParallelism and found.assigned.count() == 80


def test_topics_are_made_once_and_a_part_is_small(spark, clean):
    """Clusters read the topics of speeches from a table, not from the joins again, and a task of a pass holds 64 MB of weights at most."""
    found = topics.latent_topics(clean, k=3)
    assert "Join" not in found.doc_topics._jdf.queryExecution().executedPlan().toString()
    assert found.doc_topics.count() == clean.count()
    assert topics.MATRIX_ROWS * 16 <= 64_000_000


def test_counts_go_before_pairs_are_made(spark, clean):
    """Pairs are made from the weights; their counts are not kept on disk meanwhile."""
    scratch = Path(scratch_path(spark, "x")).parent
    before = set(scratch.glob("term-counts-*"))
    pairs = similarity.similar_pairs(clean, "speech_id")
    assert set(scratch.glob("term-counts-*")) == before
    assert pairs.count() > 0


def test_weights_of_candidates_only_are_shuffled(spark, clean, monkeypatch):
    """The weights of entities that are in no candidate meet a broadcast of the others; norms need no sort of postings by speech."""
    weights = ix.tfidf(clean, "speech_id")
    assert "Window" not in weights._jdf.queryExecution().executedPlan().toString()
    banded = similarity._banded(weights, "speech_id")
    ids = sorted(row[0] for row in banded.select("entity").distinct().collect())[:2]
    one = spark.createDataFrame([(*ids, 0.0, 1.0, 0)], "a long, b long, partial double, rest double, cut int")
    found = similarity._complete(one, banded)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    vectors = {i: {r["term"]: r["weight"] for r in weights.filter(F.col("speech_id") == i).collect()} for i in ids}
    wanted = sum(x * vectors[ids[1]].get(term, 0.0) for term, x in vectors[ids[0]].items())
    assert [row["similarity"] for row in found.collect()] == [pytest.approx(wanted)]
