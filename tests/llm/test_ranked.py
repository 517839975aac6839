"""Ranked search against scoring every document with every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from corpuscope.llm import ranked
from corpuscope.llm.queries import op13_ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOWER))


def expected(docs: list[tuple], items: list[tuple], k: int = 10) -> Counter:
    """Rows (item_id, rank, doc_id, score) with the number of times each occurs."""
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(doc_id, c, sum(c.values())) for doc_id, c in counted if c]
    n, length = len(counted), sum(size for _, _, size in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out: Counter = Counter()
    for item_id, text in items:
        found = []
        for doc_id, c, size in counted:
            m = 25 + 75 * size * n // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(found)[:k], 1):
            out[(item_id, rank, None if none else doc_id, -score)] += 1
    return out


def found(spark, docs, items, **options) -> Counter:
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).selectExpr("*", "1 AS block", "'x' AS item", "2 AS score")
    items = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS doc_id", "'y' AS term")
    return Counter(tuple(r) for r in ranked.rank(docs, items, **options).collect())


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    weight = [1 / (i + 1) for i in range(400)]
    passage = " ".join(draw.choices(words, weight, k=30))
    docs = [(i, " ".join(draw.choices(words, weight, k=draw.randint(1, 120)))) for i in range(2500)]
    docs += [(3000 + i, passage) for i in range(700)]  # copies: equal scores, the smallest ids win
    docs += [(4000 + i, docs[i][1] + " " + passage) for i in range(4)]
    draw.shuffle(docs)
    items = [(i, " ".join(draw.choices(words, weight, k=draw.randint(1, 50)))) for i in range(25)]
    return docs, [*items, (99, passage), (100, "w399 w398 w399")]


def test_pipeline(spark, corpus):
    assert found(spark, *corpus) == expected(*corpus)


def test_large_vocabulary_is_joined(spark, corpus, monkeypatch):
    monkeypatch.setattr(ranked, "VOCABULARY_BYTES", 0)
    monkeypatch.setattr(ranked, "GROUP_ITEMS", 4)
    docs, items = corpus
    assert found(spark, docs[:900], items, k=3) == expected(docs[:900], items, k=3)


def test_odd_rows(spark):
    docs = [
        (1, "Él ÉL él"), (2, "el-EL_el 7up\x00b"), (None, "el"), (None, None), (3, ""), (4, None), (5, "..."),
        (6, "el"), (6, "el"), (7, "é  x x"), (8, "long " * 120_000 + "7up"), (9, "a[b`c{d"),
    ]
    items = [(1, "EL 7UP"), (1, "el 7up"), (2, None), (3, ""), (None, "él ÉL É  X"), (4, "none"), (5, "b b c long")]
    assert found(spark, docs, items) == expected(docs, items)


def test_nothing(spark):
    assert found(spark, [], [(1, "a")]) == Counter()
    assert found(spark, [(1, "a")], []) == Counter()
    assert found(spark, [(1, None)], [(1, "a")]) == Counter()
    with pytest.raises(ValueError):
        found(spark, [(1, "a")], [(1, "a")], k=0)


def test_later_owners_add_few(spark, corpus):
    """A document that cannot reach the tenth best any more is not carried on."""
    import numpy as np
    import pandas as pd

    places, parts = np.arange(5, dtype="<u2").tobytes(), np.array([9, 1, 1, 1, 5], "<i4").tobytes()
    posting = pd.DataFrame([(10, places, parts, [7], [1], [50])], columns=["weight", "places", "parts", "items", "repeats", "bars"])
    before = pd.DataFrame([(7, np.array([1], "<u2").tobytes(), np.array([45], "<i8").tobytes())], columns=["item", "places", "scores"])
    kept = ranked._stage((0, 0), before, posting, 10).iloc[0]
    assert np.frombuffer(kept["places"], "<u2").tolist() == [0, 1, 4]
    assert np.frombuffer(kept["scores"], "<i8").tolist() == [90, 55, 50]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert Counter(tuple(r) for r in op13_ranked_search(spark, sf_dir).collect()) == expected(docs, items)
