"""Language-model scores of texts: the marginal probability over all segmentations of their words.

A word, led by the mark of a word's begin, is a lattice whose arcs are the pieces of an existing
vocabulary (single bytes where no piece fits), weighed by the vocabulary's own scores. A forward
recursion in log space adds up all paths. The weights are those of a process that draws one piece with the mark, then pieces
without it until it ends the word, so the probabilities of all words add up to one. Training texts give the words
seen their frequencies, each less a discount; what is discounted is the mass of all other words, and the lattice
spreads it. Pieces never cross white space, so a text's probability is the product of its words' and of the end of
the text.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from corpuscope.llm.dictionary import (
    Positions,
    bucket_count,
    bucket_of,
    by_bucket,
    dictionaries,
    pack,
    unpack,
    word_positions,
)
from corpuscope.runtime import written

#: Taken from the count of every word seen, for the lattice to spread.
DISCOUNT = 0.75
#: Probability that a word ends after any of its pieces.
END_OF_WORD = 0.3
#: Weight of a byte that no piece covers, against 1 for all pieces together.
BYTE_WEIGHT = 1e-5
_MARK = "▁"
_WORDS_PER_ROW = 5_000
_CELLS = 300_000
_LEADING_BITS = 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LOADED: dict = {}


def split_words(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space."""
    return text.encode().lower().split()


def read_pieces(path: str) -> tuple[list[str], np.ndarray]:
    """Pieces and their log weights; the last 256 are single bytes.

    The weights of pieces that begin a word, and those of all others, add up to one each; the latter hold the
    probability that the word goes on, too. Vocabularies made by merges store minus the rank as a score, which is read as a weight of
    1 / (rank + 1); scores of unigram vocabularies are log probabilities already.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    whole = [i for i in range(model.get_piece_size())
             if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    pairs = [(model.id_to_piece(i), model.get_score(i)) for i in whole]
    pairs = [(p, s) for p, s in pairs if s > -1e8 and _MARK not in p[1:]]
    scores = np.array([s for _, s in pairs])
    ranked = scores.min() < -1000
    weights = 1 / (1 - scores) if ranked else np.exp(scores)
    weights = np.r_[weights / weights.sum(), np.full(256, BYTE_WEIGHT / 256)]
    begins = np.array([p.startswith(_MARK) for p, _ in pairs] + [False] * 256)
    share = np.where(begins, weights[begins].sum(), weights[~begins].sum() / (1 - END_OF_WORD))
    return [p for p, _ in pairs], np.log(weights / share)


class Lattice:
    """Pieces by the hash of their characters; words are handled in blocks of equal length."""

    def __init__(self, pieces: list[str], log_weights: np.ndarray) -> None:
        self.pieces, self.log_weights = len(pieces), log_weights
        self.longest = max(map(len, pieces))
        hashes = np.array([self._hashes(np.array([[ord(c) for c in p]], np.uint64))[0, -1] for p in pieces], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        #: Which leading bits of a hash any piece has: most spans are no piece and need no search.
        self.leading = np.zeros(1 << _LEADING_BITS, bool)
        self.leading[(hashes >> np.uint64(64 - _LEADING_BITS)).astype(np.int64)] = True

    @staticmethod
    def _hashes(codes: np.ndarray) -> np.ndarray:
        """Of every prefix of each row; a span's hash follows from two of them."""
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        for j in range(codes.shape[1]):
            out[:, j + 1] = out[:, j] * _FACTOR + codes[:, j] + np.uint64(1)
        return out

    def _spans(self, words: list[str]):
        """The characters, and per span length the log weight of the piece at each begin (none: minus infinity)."""
        joined = "".join([_MARK + w for w in words]).encode("utf-32-le")
        codes = np.frombuffer(joined, np.uint32).reshape(len(words), -1).astype(np.uint64)
        hashes = self._hashes(codes)
        scores = []
        power = np.ones(1, np.uint64)
        for n in range(1, min(self.longest, codes.shape[1]) + 1):
            power *= _FACTOR
            spans = hashes[:, n:] - hashes[:, :-n] * power
            score = np.full(spans.shape, -np.inf)
            maybe = np.flatnonzero(self.leading[(spans >> np.uint64(64 - _LEADING_BITS)).view(np.int64)].ravel())
            wanted = spans.ravel()[maybe]
            at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
            hit = self.hashes[at] == wanted
            score.ravel()[maybe[hit]] = self.log_weights[self.order[at[hit]]]
            scores.append(score)
        bare = np.isneginf(scores[0])
        for code in np.unique(codes[bare]):
            of = [self.log_weights[self.pieces + b] for b in chr(int(code)).encode()]
            scores[0][bare & (codes == code)] = sum(of)
        return codes, scores

    @staticmethod
    def _sum_paths(scores: list[np.ndarray], length: int) -> np.ndarray:
        """Log of the summed weights of all paths of each word."""
        n = scores[0].shape[0]
        total = np.full((n, length + 1), -np.inf)
        total[:, 0] = 0
        for j in range(1, length + 1):
            terms = [s[:, j - k - 1] + total[:, j - k - 1] for k, s in enumerate(scores) if j - k - 1 >= 0]
            top = terms[0]
            for term in terms[1:]:
                top = np.maximum(top, term)
            top = np.where(np.isneginf(top), 0, top)
            sums = np.zeros(n)
            for term in terms:
                # Most spans are no pieces: only rows with a path are raised to their power.
                rows = np.flatnonzero(term > top - 700)
                sums[rows] += np.exp(term[rows] - top[rows])
            with np.errstate(divide="ignore"):
                total[:, j] = top + np.log(sums)
        return total[:, -1]

    def _blocks(self, words: list[str]):
        """Indexes of words of one length, in blocks of bounded size."""
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            by_length[len(w)].append(i)
        for length, own in by_length.items():
            step = max(1, _CELLS // ((length + 1) * min(self.longest, length + 1)))
            for a in range(0, len(own), step):
                yield own[a : a + step]

    def log_probability(self, words: list[str]) -> np.ndarray:
        """Natural logs of the words' marginal probabilities."""
        out = np.zeros(len(words))
        for own in self._blocks(words):
            codes, scores = self._spans([words[i] for i in own])
            out[own] = self._sum_paths(scores, codes.shape[1]) + math.log(END_OF_WORD)
        return out


def _lattice(path: str) -> Lattice:
    """One lattice per Python process."""
    if path not in _LOADED:
        _LOADED[path] = Lattice(*read_pieces(path))
    return _LOADED[path]


def _merged(tables) -> tuple[dict[str, int], np.ndarray]:
    """Words of a task's dictionary rows and their summed counts."""
    words: dict[str, int] = {}
    places, counts = [], []
    for table in tables:
        for own, each in zip(table.column("words").to_pylist(), table.column("counts").to_pylist()):
            places.append(np.fromiter((words.setdefault(w, len(words)) for w in own), np.int64, len(own)))
            counts.append(np.asarray(each, np.int64))
    if not places:
        return words, np.zeros(0, np.int64)
    return words, np.bincount(np.concatenate(places), np.concatenate(counts), len(words)).astype(np.int64)


def _word_counts(parts: DataFrame, buckets: int) -> DataFrame:
    """Distinct words by bucket with their counts in training texts, some thousands to a row."""

    def merge(tables):
        words, counts = _merged(tables)
        names = list(words)
        owner = bucket_of(names, buckets)
        order = np.argsort(owner, kind="stable")
        ends = np.flatnonzero(np.diff(owner[order].astype(int))) + 1
        for own in np.split(order, ends) if len(order) else []:
            for a in range(0, len(own), _WORDS_PER_ROW):
                at = own[a : a + _WORDS_PER_ROW]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([owner[at[0]]], pa.int32()), pa.array([[names[i] for i in at]], pa.list_(pa.string())),
                     pa.array([counts[at]], pa.list_(pa.int64()))],
                    ["bucket", "words", "counts"],
                )

    return by_bucket(parts).mapInArrow(merge, "bucket int, words array<string>, counts array<long>")


def _path_weights(word_counts: DataFrame, vocabulary: str) -> DataFrame:
    """Add ``paths``: the natural log of each word's probability by the lattice."""

    def run(tables):
        for table in tables:
            lattice = _lattice(vocabulary)
            paths = [lattice.log_probability(words) for words in table.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([*table.columns, pa.array(paths, pa.list_(pa.float64()))], [*table.schema.names, "paths"])

    return word_counts.mapInArrow(run, "bucket int, words array<string>, counts array<long>, paths array<double>")


def word_scores(counts: np.ndarray, paths: np.ndarray, tokens: int, kinds: int) -> np.ndarray:
    """Log10 probabilities of words that the training texts hold so often, ``paths`` being those of the lattice.

    (max(count - DISCOUNT, 0) + (DISCOUNT * kinds + 1) * lattice) / (tokens + 2): with the end of a text, which has
    (ends + 1) / (tokens + 2), all add up to one. Without training the lattice alone is left.
    """
    with np.errstate(divide="ignore"):
        seen = np.log(np.maximum(counts - DISCOUNT, 0))
    return (np.logaddexp(seen, math.log(DISCOUNT * kinds + 1) + paths) - math.log(tokens + 2)) / math.log(10)


def score_texts(
    docs: DataFrame, training: Column, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Score every row of a stored table; the rows where ``training`` is true are learned from.

    Returns ``id_col, n_tokens, n_known, train_tokens, base_score, score``: tokens with the end of the
    text, those the training rows hold, all training tokens, the log10 probability of an additively
    smoothed word model (0.1 each), and the model's, see :func:`word_scores`. The base gives every unseen word the
    same floor, of which there are unboundedly many; the model's probabilities add up to one, so on texts with
    unseen words it is below the base where these are unlikely by their letters.
    A null or empty text is an end alone. Without training rows the base is 0 and the lattice scores alone.
    """
    is_training = F.coalesce(training, F.lit(False))
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), is_training.cast("int").alias("weight")
    )
    buckets = bucket_count(docs)
    parts = written(dictionaries(texts, split_words, buckets, weighed=True), "lattice-words")
    counted = written(_word_counts(parts, buckets), "lattice-counts")
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = counted.repartition(spread)
    one = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    distinct = F.size(F.filter("counts", lambda x: x > 0))
    totals = counted.agg(F.sum(one).alias("words"), F.sum(distinct).alias("kinds")).first()
    ends = docs.filter(is_training).count()
    n, kinds = (totals["words"] or 0) + ends, (totals["kinds"] or 0) + (ends > 0)
    word_kinds = totals["kinds"] or 0
    paths = written(_path_weights(counted, vocabulary), "lattice-paths")

    def base_of(counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (n + 0.1 * (kinds + 1)))

    end_base = float(base_of(np.array([ends]))[0])
    end_score = math.log10((ends + 1) / (n + 2))

    def score(tables):
        words: dict[str, int] = {}
        parts_, counts, own_paths = [], [np.zeros(0, np.int64)], [np.zeros(0)]
        for table in tables:
            if table.num_rows == 0:
                continue
            fitted = table.filter(pc.is_valid(table.column("paths")))
            for own in fitted.column("words").to_pylist():
                words.update(zip(own, range(len(words), len(words) + len(own))))
            counts.append(fitted.column("counts").flatten().to_numpy())
            own_paths.append(fitted.column("paths").flatten().to_numpy())
            parts_.append(table.filter(pc.is_null(table.column("paths"))).select(["batch", "bucket", "check", "words"]))
        counts, tables = np.concatenate(counts), parts_
        scores = word_scores(counts, np.concatenate(own_paths), n, word_kinds)
        for table in tables:
            rows = [[], []]
            for own in table.column("words").to_pylist():
                at = np.fromiter(map(words.__getitem__, own), np.int64, len(own))
                rows[0].append(pack(counts[at]))
                rows[1].append(pack(scores[at]))
            yield pa.RecordBatch.from_arrays(
                [*(table.column(c) for c in ("batch", "bucket", "check")), *(pa.array(r, pa.binary()) for r in rows)],
                ["batch", "bucket", "check", "counts", "scores"],
            )

    # The words of a bucket meet their counts and paths in the task that has the bucket.
    met = by_bucket(parts.drop("counts").unionByName(paths, allowMissingColumns=True))
    scored = met.mapInArrow(score, "batch long, bucket int, check long, counts binary, scores binary")

    def add_up(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        at = Positions(left.iloc[0])
        at.agree(right["check"])
        right = right.sort_values("bucket")
        counts = np.concatenate([np.zeros(0, np.int64), *(unpack(x, np.int64) for x in right["counts"])])[at.rank]
        scores = np.concatenate([np.zeros(0), *(unpack(x, np.float64) for x in right["scores"])])[at.rank]
        bases = base_of(counts)
        ends_at = np.cumsum(at.lengths)

        def sums(values: np.ndarray) -> np.ndarray:
            pieces = np.split(values[at.flat], ends_at[:-1])
            return np.array([math.fsum(p) for p in pieces])

        return pd.DataFrame(
            {
                "id": pd.array(at.ids, "Int64"),
                "n_tokens": at.lengths + 1,
                "n_known": sums(counts > 0).astype(np.int64) + (ends > 0),
                "train_tokens": n,
                "base_score": sums(bases) + end_base,
                "score": sums(scores) + end_score,
            }
        )

    places = word_positions(texts.select("id", "text"), split_words, buckets)
    joined = places.groupBy("batch").cogroup(scored.groupBy("batch"))
    schema = "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return joined.applyInPandas(add_up, schema).withColumnRenamed("id", id_col)
