"""The stages one after the other, on whole small tables."""

from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline
from corpuscope.llm import mixing
from corpuscope.llm.shingles import shingle_set
from corpuscope.runtime import written

SMALL = "/root/testdata/sf0.001"


def test_each_stage_works_on_what_the_last_one_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    kept = [set(texts)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = written(stage(spark, docs, SMALL), name)
        assert docs.columns == before.columns and {r.doc_id for r in docs.collect()} <= kept[-1]
        assert all(texts[r.doc_id] == r.text for r in docs.collect())
        kept.append({r.doc_id for r in docs.collect()})
    copies = Counter(r.doc_id for r in docs.collect())
    assert copies == Counter({r.doc_id: r.copies for r in mixing.mix(before).collect() if r.copies})
    tokens = corpus_pipeline.encode_tokens(spark, docs, SMALL).collect()
    assert Counter(r.doc_id for r in tokens) == copies and all(r.n_tokens == len(r.ids) for r in tokens)
    run = corpus_pipeline.run(spark, SMALL)
    assert Counter(r.doc_id for r in run.collect()) == copies


def test_empty_documents_go_through(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), name)
        assert docs.count() == 0


def test_rows_without_an_id_and_repeated_ids(spark, tmp_path):
    """Near copies, mixture and tokens against brute force, where ids say little and columns clash."""
    draw = random.Random(2)
    words = [f"word{i}" for i in range(500)]
    own = [" ".join(draw.choices(words, k=draw.randint(6, 40))) for _ in range(30)]
    own += [" ".join(draw.choices(words, k=60_000))]
    rows = [(i % 11 if i % 3 else None, text, "ab"[i % 2] if i % 5 else None) for i, text in enumerate(own)]
    copies = [(None, own[3], "a"), (None, own[3], "a"), (4, own[4] + " more", "b"), (900, own[5].upper(), None), (0, "", "a"), (None, None, "a"), (None, None, "a")]
    table = [(i, t, "en", s, len(t or ""), "x", 1, -5) for i, t, s in rows + copies]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, size int, _key long"
    spark.createDataFrame(table, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))

    kept = written(corpus_pipeline.drop_near_copies(spark, docs, ""), "kept")
    assert kept.columns == docs.columns
    left = Counter(r.text for r in kept.collect())
    groups: dict = {}
    for _, text, *_ in table:
        found = frozenset(shingle_set(text).tolist())
        same = next((g for g in groups if found and len(g & found) >= 0.8 * len(g | found)), found)
        groups.setdefault(same, Counter())[text] += 1
    for found, texts in groups.items():
        stay = sum(left[t] for t in texts)
        assert stay == (1 if found else sum(texts.values()))  # rows without words are linked with nothing

    mixed = written(corpus_pipeline.mix_sources(spark, kept, ""), "mixed")
    assert mixed.columns == docs.columns
    keyed, key = corpus_pipeline._keyed(kept)
    assert keyed.select(key).distinct().count() == kept.count() == keyed.filter(F.col(key).isNotNull()).count()
    taken = Counter()
    for r in keyed.join(mixing.mix(keyed, id_col=key).select(key, "copies"), key).collect():
        taken[r.doc_id, r.text, r.source] += r.copies
    assert Counter((r.doc_id, r.text, r.source) for r in mixed.collect()) == +taken

    encoder = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    tokens = corpus_pipeline.encode_tokens(spark, mixed, "").collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in tokens) == Counter((r.doc_id, tuple(encoder.encode_ordinary(r.text or ""))) for r in mixed.collect())
