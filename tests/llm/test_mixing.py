"""Targets against the rounds of sharing as they are told, systematic sampling against a running sum."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from corpuscope.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string, rate string"


def shared(sizes: dict, weights=(5, 2, 1), cap=3.0) -> dict:
    """Rounds: share what is left by weight, stop those above their cap, until none is."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    done: dict = {}
    while True:
        left = sum(sizes.values()) - sum(done.values())
        open_ = sum(weight[s] for s in order if s not in done)
        over = [s for s in order if s not in done and left * weight[s] / open_ > cap * sizes[s]]
        if not over:
            return done | {s: left * weight[s] / open_ for s in order if s not in done}
        done |= {s: cap * sizes[s] for s in over}


@pytest.fixture(scope="module")
def rows():
    out, i = [], 0
    for source, lengths in {"a": [1, 2, 3], "b": [50] * 400 + [7], "é": range(1, 90), "B": [0, 0], None: range(20, 60), "z": [3000]}.items():
        for n in lengths:
            out.append((i, source, "w " * n if n else None, "x", None))
            i += 1
    return out


@pytest.mark.parametrize("tie_slice", [5_000, 9])
def test_mix(spark, rows, monkeypatch, tie_slice):
    monkeypatch.setattr(mixing, "TIE_SLICE", tie_slice)
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    sizes: dict = defaultdict(int)
    for _, source, text, *_ in rows:
        sizes[source] += len((text or "").split())
    targets = shared(dict(sizes))
    taken: Counter = Counter()
    by_source = defaultdict(list)
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source], abs_tol=1e-6)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
        by_source[r.source].append((r.size, r.copies))
    for source, own in by_source.items():
        rate = targets[source] / sizes[source] if sizes[source] else 0
        assert abs(sum(c for _, c in own) - rate * len(own)) < 1  # one integer after the other is crossed
        assert all(c in (math.floor(rate), math.ceil(rate)) for _, c in own)
        assert abs(taken[source] - targets[source]) <= max(s for s, _ in own)
    again = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert Counter(again) == Counter(found)


def test_repeated_ids_and_nothing(spark):
    rows = [(1, "a", "x y"), (1, "a", "x y"), (None, None, None), (None, "a", "x"), (2, None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in found) == Counter((i, s, len((t or "").split())) for i, s, t in rows)
    assert mixing.mix(docs.limit(0)).count() == 0
    empty = mixing.mix(docs.filter("size(split(text, ' ')) = 99 OR text = ''")).collect()
    assert [r.copies for r in empty] == [0]
