"""Classifiers on held-out rows, and on what gives them nothing to learn."""

from __future__ import annotations

import math
import random
import string

from pyspark.sql import functions as F

import corpus_pipeline
from corpuscope.llm import language, toxicity
from corpuscope.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    rows = QUERIES["op7_language"](spark, MEDIUM).collect()
    truth = dict(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect())
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held_out) / len(held_out) >= 0.97


def test_toxicity_of_held_out_rows(spark):
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, MEDIUM).collect()}
    truth = dict(spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "toxic").collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    held_out = [(rows[i].predicted, t) for i, t in truth.items() if rows[i].held_out]
    toxic = [p for p, t in held_out if t]
    clean = [p for p, t in held_out if not t]
    assert sum(toxic) / len(toxic) >= 0.6 and sum(clean) / len(clean) <= 0.03


def test_pipeline_rejects_what_is_in_no_learned_language(spark):
    draw = random.Random(1)
    noise = [" ".join("".join(draw.choices(string.ascii_lowercase, k=draw.randint(2, 10))) for _ in range(n)) for n in (5, 20, 100, 500) * 5]
    strange = [
        "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
        "minden emberi lény szabadon születik és egyenlő méltósága és joga van",
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
        "все люди рождаются свободными и равными в своем достоинстве и правах",
        "すべての人間は生まれながらにして自由であり",
    ]
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    added = spark.createDataFrame([(-i, t) for i, t in enumerate(noise + strange, 1)], "doc_id long, text string")
    both = docs.unionByName(added, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, both, MEDIUM).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.filter(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}


def test_pipeline_drops_what_reaches_its_own_toxicity_bound(spark, monkeypatch):
    def score(docs, model):
        given = docs.withColumn("score", F.col("text").cast("double"))
        return given.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))

    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: None)
    monkeypatch.setattr(toxicity, "score", score)
    docs = spark.createDataFrame([(0, "0.0"), (1, "0.29"), (2, "0.3"), (3, "0.5"), (4, "0.7"), (5, "1.0")], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, MEDIUM).collect()} == {0, 1}


def test_language_without_text_or_letters(spark):
    rows = [(1, "hello there my friend", "en"), (2, "guten Tag mein Freund", "de"), (3, None, "en"), (4, "", "de"), (5, "12 !? 34", "en"), (None, "ça où là", None), (6, "x" * 50_000, None), (1, "hello there my friend", "en")]
    docs = spark.createDataFrame([(*r, "s", "p") for r in rows], "doc_id long, text string, lang string, score string, _judged2 string")
    model = language.fit(docs, F.lit(True))
    found = language.predict(docs, model).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (3, 4, 5))
        if r.doc_id in (1, 2):
            assert r.lang_pred == r.lang
    nothing = language.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0
    only = language.fit(docs, F.col("doc_id") == 2)
    assert {r.lang_pred for r in language.predict(docs.filter("doc_id < 3"), only).collect()} == {"de"}


def test_families_are_told_apart_before_their_languages(spark):
    model = language.LanguageModel(["en", "de", "fr", "es", "xx"])
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    names = [(a, b) for a, b, *_ in model.pairs()]
    assert names == [("family:germanic", "family:romance"), ("family:germanic", "family:xx"), ("family:romance", "family:xx"), ("de", "en"), ("es", "fr")]


def test_features_see_density_nearness_and_disguise():
    lexicon = {"moron": 3.0, "moro-": 2.0}
    plain = toxicity.features("you are a MORON! yes", lexicon)
    assert math.isclose(plain[0], 1 / 5) and plain[3] == 3.0 and plain[4] > 0
    assert toxicity.features("m0r0n here", lexicon)[11] > 0
    assert toxicity.features(None, lexicon) == toxicity.features(" ", lexicon) == [0.0] * 12
    assert toxicity.features("moronic", lexicon)[3] == 2.0


def test_toxicity_with_few_or_no_labels(spark):
    rows = [(1, "a b"), (2, None), (3, ""), (None, "c"), (4, "word " * 40_000), (1, "a b")]
    docs = spark.createDataFrame([(*r, 5, "s") for r in rows], "doc_id long, text string, score int, _features string")
    docs = docs.withColumnRenamed("_features", "label")
    for labels in ([], [(1, 1)], [(1, 0), (2, 0), (None, 1), (3, None)], [(1, 0), (1, 1), (2, 0)]):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        found = toxicity.score(docs, toxicity.fit(docs, table)).collect()
        assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, table)).count() == 0


def test_pipeline_stages_filter_as_the_operators_say(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, docs, MEDIUM)
    assert kept.columns == docs.columns and kept.count() >= 0.97 * docs.count()
    clean = corpus_pipeline.drop_toxic(spark, docs, MEDIUM)
    labels = dict(spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "toxic").collect())
    left = {r.doc_id for r in clean.select("doc_id").collect()}
    assert clean.columns == docs.columns
    assert sum(i in left for i, t in labels.items() if not t) / sum(1 for t in labels.values() if not t) >= 0.97
    assert sum(i in left for i, t in labels.items() if t) / sum(1 for t in labels.values() if t) <= 0.4
