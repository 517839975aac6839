"""Tokens: exact round trips, the libraries' own answers, and a score computed the long way."""

from __future__ import annotations

import hashlib
import functools
import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpuscope.llm import bpe, dictionary, lattice, token_counts
from corpuscope.llm.queries import QUERIES, fold
from corpuscope.runtime import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
COUNTER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"

TEXTS = [
    (1, "Hello world, it's 12 O'Clock\n\n  again"),
    (2, None),
    (3, ""),
    (4, "  \t\n "),
    (5, "Ünïcödé ﬁ Ω≈ç 漢字かな العربية 🙂🙂 é İstanbul ΣΑΣ"),
    (6, "<|endoftext|> inside <|startoftext|>text"),
    (7, "word " * 30_000),
    (8, "x" * 20_000),
    (9, "same text"),
    (10, "same text"),
    (10, "same text"),
    (None, "no id \x01\x1c\x85\xa0 control"),
    (11, "a b c\x0bd\x0ce²³¼ ʼn ǆ"),
]
SCHEMA = "doc_id long, text string, ids string, id string, weight int, batch string"


@pytest.fixture(scope="module")
def stored(spark):
    """The texts in a table with columns whose names the operators use themselves."""
    path = scratch_path(spark, "texts")
    rows = [(i, t, "x", None, None, "y") for i, t in TEXTS]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def nothing(spark):
    path = scratch_path(spark, "nothing")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def counted(rows) -> Counter:
    return Counter(map(tuple, rows))


def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.mark.parametrize("small_batches", [False, True])
def test_ids_are_the_librarys_and_decode_to_the_text(stored, monkeypatch, small_batches):
    if small_batches:
        monkeypatch.setattr(dictionary, "WORDS_PER_BATCH", 3)
    encoding = tiktoken_encoding()
    rows = bpe.decode(bpe.encode(stored, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    found = Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in rows)
    assert found == Counter((i, tuple(encoding.encode_ordinary(t or "")), (t or "").encode()) for i, t in TEXTS)


def test_bpe_query_on_its_table(spark):
    encoding = tiktoken_encoding()
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op5_byte_bpe"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for row in rows:
        ids = encoding.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_empty_tables(spark, nothing):
    assert bpe.decode(bpe.encode(nothing, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0
    assert token_counts.count_tokens(nothing, COUNTER, scratch_path(spark, "cache")).count() == 0
    assert lattice.score_texts(nothing, nothing.doc_id > 0, PIECES).count() == 0


def test_counts_are_the_librarys(spark, stored):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(COUNTER)
    rows = token_counts.count_tokens(stored.select("doc_id", "text"), COUNTER, scratch_path(spark, "cache")).collect()
    expected = [(i, t, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS]
    assert Counter((r.doc_id, r.text, r.n_bytes, r.n_tokens) for r in rows) == Counter(expected)


def test_known_contents_are_not_encoded_again(spark, stored, monkeypatch):
    cache = scratch_path(spark, "cache")
    docs = stored.select("doc_id", "text")
    first = counted(token_counts.count_tokens(docs, COUNTER, cache).collect())
    size = spark.read.parquet(cache).count()
    assert size == spark.read.parquet(cache).select("digest").distinct().count() == len({" ".join((t or "").split(" ")) for _, t in TEXTS}) - 0
    assert counted(token_counts.count_tokens(docs, COUNTER, cache).collect()) == first
    assert spark.read.parquet(cache).count() == size


def test_lattice_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "▁ab", "bb"]
    weights = np.log(np.r_[np.array([3, 5, 2, 4, 7, 1, 6]) / 30, np.full(256, 2 / 30 / 256)])
    model = lattice.Lattice(pieces, weights)

    def paths(text: str) -> list[tuple[list[int], float]]:
        if not text:
            return [([], 1.0)]
        out = []
        for n in range(1, len(text) + 1):
            if text[:n] in pieces:
                own = pieces.index(text[:n])
                out += [([own, *rest], math.exp(weights[own]) * p) for rest, p in paths(text[n:])]
        if text[0] not in pieces:
            own = [len(pieces) + b for b in text[0].encode()]
            out += [(own + rest, math.exp(sum(weights[i] for i in own)) * p) for rest, p in paths(text[1:])]
        return out

    words = ["ab", "abb", "aabb", "b", "aéb", "bbbb", "漢a"]
    for word, total in zip(words, model.log_probability(words)):
        found = paths("▁" + word)
        assert math.isclose(total, math.log(lattice.END_OF_WORD * sum(p for _, p in found)), rel_tol=1e-12)


def test_all_words_of_a_small_alphabet_add_up_to_one():
    pieces = ["▁", "▁a", "a", "b", "ab", "▁ab", "bb"]
    raw = np.array([3, 5, 2, 4, 7, 1, 6.0])
    begins = np.array([p.startswith("▁") for p in pieces])
    weights = np.where(begins, raw / raw[begins].sum(), raw / raw[~begins].sum() * (1 - lattice.END_OF_WORD))
    model = lattice.Lattice(pieces, np.log(np.r_[weights, np.full(256, 1e-300)]))
    words = ["".join(w) for n in range(1, 15) for w in itertools.product("ab", repeat=n)]
    paths = model.log_probability(words)
    empty = lattice.END_OF_WORD * weights[0]  # the mark alone
    assert 0.95 < np.exp(paths).sum() + empty < 1
    counts = np.zeros(len(words))
    counts[[0, 3, 40]] = 5, 1, 9
    tokens, kinds, ends = 15 + 4, 3, 4
    scores = 10 ** lattice.word_scores(counts, paths, tokens, kinds)
    total = scores.sum() + (ends + 1) / (tokens + 2)
    assert 0.95 < total < 1


def test_own_weights_of_the_vocabulary():
    pieces, weights = lattice.read_pieces(PIECES)
    begins = np.array([p.startswith("▁") for p in pieces] + [False] * 256)
    assert math.isclose(np.exp(weights[begins]).sum(), 1) and math.isclose(np.exp(weights[~begins]).sum(), 1 - lattice.END_OF_WORD)


def test_the_lattice_tells_likely_from_unlikely_words(spark, stored):
    """Unseen words share one mass, and it is the lattice that spreads it."""
    rows = [(1, "the thing the"), (2, "thinking"), (3, "xqzvkjwq"), (4, "thinking " * 30_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path := scratch_path(spark, "texts"))
    docs = spark.read.parquet(path)
    found = {r.doc_id: r for r in lattice.score_texts(docs, docs.doc_id == 1, PIECES).collect()}
    assert found[2].base_score == found[3].base_score and found[2].score > found[3].score + 3
    assert math.isclose(found[4].score - found[2].score, 29_999 * (found[2].score - math.log10(2 / 6)), rel_tol=1e-9)


@functools.cache
def vocabulary() -> dict[str, float]:
    pieces, weights = lattice.read_pieces(PIECES)
    return dict(zip([*pieces, *range(256)], weights.tolist()))


def likely(word: bytes, count: int, n: int, kinds: int) -> float:
    """A word's log10 probability, its paths added up one place after the other."""
    known, text = vocabulary(), "▁" + word.decode()
    ways = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - 40), end):
            weight = known.get(text[begin:end])
            if weight is None and end - begin == 1:
                weight = sum(known[b] for b in text[begin].encode())
            if weight is not None:
                ways[end] = float(np.logaddexp(ways[end], ways[begin] + weight))
    paths = ways[-1] + math.log(lattice.END_OF_WORD)
    seen = math.log(count - lattice.DISCOUNT) if count else -math.inf
    return float(np.logaddexp(seen, math.log(lattice.DISCOUNT * kinds + 1) + paths) - math.log(n + 2)) / math.log(10)


def test_scores_the_long_way(spark, stored):
    training = stored.doc_id % 3 != 0
    rows = lattice.score_texts(stored, training, PIECES).collect()
    seen: Counter = Counter()
    for i, t in TEXTS:
        if i is not None and i % 3:
            seen.update([*(t or "").encode().lower().split(), None])
    n, kinds = sum(seen.values()), len(seen)
    expected = []
    for i, t in TEXTS:
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in tokens)
        score = sum(math.log10((seen[w] + 1) / (n + 2)) if w is None else likely(w, seen[w], n, kinds - (seen[None] > 0)) for w in tokens)
        expected.append((i, len(tokens), sum(seen[w] > 0 for w in tokens), n, round(base, 6), round(score, 6)))
    found = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rows)
    assert found == Counter(expected)


def test_nothing_to_learn_from(stored):
    rows = lattice.score_texts(stored, stored.doc_id < 0, PIECES).collect()
    assert {r.base_score for r in rows} == {0.0} and {r.n_known for r in rows} == {0}
    assert all(math.isfinite(r.score) for r in rows)


def test_held_out_text_needs_the_lattice(spark, monkeypatch):
    """With the same probability for every word in place of the lattice's, held-out texts are less likely."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = QUERIES["op10_lattice_scores"](spark, SMALL).collect()
    own = sum(r.score for r in rows if r.held_out)
    monkeypatch.setattr(lattice, "_path_weights", lambda counted, path: counted.withColumn("paths", F.transform("counts", lambda c: F.lit(-60.0).cast("double"))))
    flat = lattice.score_texts(docs, fold("doc_id", 10) != 0, PIECES)
    held_out = {r.doc_id for r in rows if r.held_out}
    assert len(held_out) > 5 and own > sum(r.score for r in flat.collect() if r.doc_id in held_out) + 100
