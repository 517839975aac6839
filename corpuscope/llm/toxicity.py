"""Toxicity of texts: gradient-boosted trees over a dozen dense features, calibrated by isotonic regression.

The lexicon is learned: words, and beginnings of words, that are in far more toxic than other texts.
The trees see how dense they are, how near to second-person pronouns, and how the text is written
(capitals, punctuation, disguised words). So that nothing judges its own
rows, the lexicon is taken without a text when that text trains the trees, and texts that neither
have seen (every fifth, by a hash) calibrate. At most ``SAMPLE`` labelled texts (in expectation) are used.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from corpuscope.runtime import written

SAMPLE = 20_000
LEXICON = 20_000
STEMS = (4, 5, 6)
#: Log-likelihood ratio and ratio of rates that make a word part of the lexicon.
LEAST_EVIDENCE, LEAST_RATIO = 20.0, 8.0
NEAR = 5
TOXIC = 0.7

# Second-person pronouns of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves du dich dir dein deine deinen ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra os".split()
)
# Characters that stand for letters in disguised words.
_DISGUISE = str.maketrans("013457@$!|", "oieastasii")
_TOKEN = re.compile(r"\S+")
_WORD = re.compile(r"[^\W\d_]+")
_INSIDE = re.compile(r"[^\W\d_][\d@$!|*#._-]+[^\W\d_]")
_PUNCTUATION = re.compile(r"[^\w\s]+")
_CAPITALS = re.compile("[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]+")


def keys_of(word: str) -> list[str]:
    """A lower-case word and its beginnings, as the lexicon lists them."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)]


def features(text: str | None, lexicon: dict[str, float], known: dict[str, float] | None = None) -> list[float]:
    """The dozen numbers; all 0 for a null or empty text. ``known`` keeps words' weights for further texts."""
    text = text or ""
    words = _WORD.findall(text)
    if not text.strip():
        return [0.0] * 12
    lower = [w.lower() for w in words]
    known = {} if known is None else known
    hits, total, best = [], 0.0, 0.0
    for i, word in enumerate(lower):
        weight = known.get(word)
        if weight is None:
            weight = known[word] = max([lexicon.get(k, 0.0) for k in keys_of(word)])
        if weight:
            hits.append(i)
            total += weight
            best = max(best, weight)
    addressed = sum(1 for i in hits if any(w in SECOND_PERSON for w in lower[max(0, i - NEAR) : i + NEAR + 1]))
    disguised = disguised_hits = 0
    if _INSIDE.search(text):
        for token in _TOKEN.findall(text):
            if _INSIDE.search(token):
                disguised += 1
                plain = "".join(_WORD.findall(token.lower().translate(_DISGUISE)))
                weight = max([lexicon.get(k, 0.0) for k in keys_of(plain)])
                disguised_hits += weight > 0
                best = max(best, weight)
    n, size = max(1, len(words)), len(text)
    upper = sum(map(str.isupper, words))
    capitals = sum(map(len, _CAPITALS.findall(text)))
    return [
        len(hits) / n,
        math.log1p(len(hits)),
        total / n,
        best,
        addressed / n,
        math.log1p(addressed),
        capitals / size,
        upper / n,
        (text.count("!") + text.count("?")) / size,
        sum(map(len, _PUNCTUATION.findall(text))) / size,
        disguised / n,
        math.log1p(disguised_hits),
    ]


class Lexicon:
    """How many of the toxic and of the other texts have each key, and the weights that follow."""

    def __init__(self, counts: dict[str, tuple[int, int]], toxic: int, other: int) -> None:
        self.counts, self.toxic, self.other = counts, toxic, other

    def weights(self, less_toxic: int = 0, less_other: int = 0) -> dict[str, float]:
        """Log ratio of rates of the keys with enough evidence, with so many texts that have them left out."""
        out = {}
        for key, (t, o) in self.counts.items():
            evidence, ratio = evidence_of(t - less_toxic, o - less_other, self.toxic - less_toxic, self.other - less_other)
            if evidence >= LEAST_EVIDENCE and ratio >= LEAST_RATIO:
                out[key] = math.log(ratio)
        return out


def evidence_of(t: int, o: int, toxic: int, other: int) -> tuple[float, float]:
    """Log-likelihood ratio and smoothed ratio of rates of a key in ``t`` of ``toxic`` and ``o`` of ``other`` texts."""
    if t <= 0 or toxic <= 0 or other <= 0:
        return 0.0, 0.0
    o = max(o, 0)
    both, every = t + o, toxic + other
    evidence = t * math.log(t * every / (both * toxic)) + (o * math.log(o * every / (both * other)) if o else 0.0)
    return 2 * evidence, (t + 0.5) / (toxic + 1) / ((o + 0.5) / (other + 1))


class ToxicityModel:
    """Weights of the lexicon, trees and calibration; without both kinds of labels a constant."""

    def __init__(self, lexicon: dict[str, float], trees: GBTClassificationModel | None, curve: IsotonicRegressionModel | None, constant: float) -> None:
        self.lexicon, self.trees, self.curve, self.constant = lexicon, trees, curve, constant


def _dense(rows: DataFrame, lexicon: dict[str, float], text_col: str) -> DataFrame:
    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        known: dict[str, float] = {}
        return pd.Series([features(t, lexicon, known) for t in texts])

    return rows.withColumn("_features", array_to_vector(measure.asNondeterministic()(F.col(text_col))))


def _learn_lexicon(rows: DataFrame) -> Lexicon:
    """From ``text`` and ``toxic``: the keys with nearly enough evidence, at most ``LEXICON``."""

    def count(tables):
        toxic, other = Counter(), Counter()
        for table in tables:
            for text, label in zip(table.column("text").to_pylist(), table.column("toxic").to_pylist()):
                found = {k for w in set(_WORD.findall((text or "").lower())) for k in keys_of(w)}
                (toxic if label else other).update(found)
            if len(toxic) + len(other) > 1_000_000:
                yield from rows_of(toxic, other)
                toxic, other = Counter(), Counter()
        yield from rows_of(toxic, other)

    def rows_of(toxic, other):
        names = list(toxic.keys() | other.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[k] for k in names], pa.int64()) for c in (toxic, other))], ["key", "t", "o"]
        )

    sizes = {bool(t): n for t, n in rows.groupBy("toxic").count().collect()}
    all_t, all_o = sizes.get(True, 0), sizes.get(False, 0)
    if not all_t or not all_o:
        return Lexicon({}, all_t, all_o)
    t, o = F.col("t"), F.col("o")
    part = t + o
    expected_t, expected_o = part * all_t / (all_t + all_o), part * all_o / (all_t + all_o)
    none = F.lit(0.0)
    evidence = 2 * (F.when(t > 0, t * F.log(t / expected_t)).otherwise(none) + F.when(o > 0, o * F.log(o / expected_o)).otherwise(none))
    ratio = ((t + 0.5) / (all_t + 1)) / ((o + 0.5) / (all_o + 1))
    counts = rows.select("text", "toxic").mapInArrow(count, "key string, t long, o long")
    counts = counts.groupBy("key").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    found = counts.select("key", "t", "o", evidence.alias("evidence"), ratio.alias("ratio"))
    found = found.filter((F.col("evidence") >= 0.7 * LEAST_EVIDENCE) & (F.col("ratio") >= 0.7 * LEAST_RATIO))
    best = found.orderBy(F.desc("evidence"), "key").limit(LEXICON).collect()
    return Lexicon({r.key: (r.t, r.o) for r in best}, all_t, all_o)


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> ToxicityModel:
    """Learn from ``labels(id_col, toxic)`` and the texts of those ids; of several labels the highest counts."""
    own = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    own = own.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col("toxic") > 0).alias("toxic"))
    n = own.count()
    place = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_000_007))
    drawn = own.filter(place < int(1_000_000_007 * min(1.0, SAMPLE / max(1, n))) + 1)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(drawn), "id")  # at most about SAMPLE ids
    rows = written(rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(12)), F.lit(10))), "labelled")
    known = _learn_lexicon(rows.filter("part < 8"))
    lexicon = known.weights()
    parts = [("part < 8 AND toxic", known.weights(less_toxic=1)), ("part < 8 AND NOT toxic", known.weights(less_other=1)), ("part >= 8", lexicon)]
    dense = None
    for where, weights in parts:
        own = _dense(rows.filter(where), weights, "text")
        own = own.select("part", F.col("toxic").cast("double").alias("label"), vector_to_array("_features").alias("values"))
        dense = own if dense is None else dense.union(own)
    dense = written(dense, "toxicity-features").select("part", "label", array_to_vector("values").alias("_features"))
    counts = {label: each for label, each in dense.groupBy("label").count().collect()}
    train = dense.filter("part < 8")
    kinds = {r[0] for r in train.select("label").distinct().collect()}
    if len(kinds) < 2:
        total = sum(counts.values())
        return ToxicityModel(lexicon, None, None, counts.get(1.0, 0) / total if total else 0.0)
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3, seed=7, minInstancesPerNode=3
    ).fit(train)
    raw = trees.transform(dense.filter("part >= 8")).select("label", vector_to_array("probability")[1].alias("raw"))
    held = {r[0] for r in raw.select("label").distinct().collect()}
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(raw) if len(held) == 2 else None
    return ToxicityModel(lexicon, trees, curve, 0.0)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``TOXIC`` on) to every row; null texts count as empty.

    Existing columns of those names are replaced. A model that saw only one kind of label gives all rows
    the share of toxic ones.
    """
    kept = docs.drop("score", "predicted")
    if model.trees is None:
        out = kept.withColumn("score", F.lit(float(model.constant)))
        return out.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))
    trees = model.trees.copy().setRawPredictionCol("_raw").setProbabilityCol("_probability").setPredictionCol("_class")
    rows = trees.transform(_dense(kept, model.lexicon, text_col)).withColumn("_p", vector_to_array("_probability")[1])
    if model.curve is not None:
        rows = model.curve.copy().setFeaturesCol("_p").setPredictionCol("_score").transform(rows)
    else:
        rows = rows.withColumn("_score", F.col("_p"))
    rows = rows.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_score"))))
    return rows.withColumn("predicted", (F.col("score") >= TOXIC).cast("int")).select(*kept.columns, "score", "predicted")
