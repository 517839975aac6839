"""Language of a text in two steps: its family, then the language among those of the family.

Each step is a set of linear support vector machines, one for each pair of families or of languages
of a family, over hashed triples of bytes of the letters. They are fitted by Spark's LinearSVC on a
sample of ``PER_LANGUAGE`` labelled texts per language at most (in expectation), chosen by a hash.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from corpuscope.runtime import written

PER_LANGUAGE = 1_000
WIDTH = 2_048
UNKNOWN = "und"
#: Margin of a machine at which it is taken to be right in 95 of 100 cases.
SURE_MARGIN = 1.0

# Families of languages by their two-letter codes. Others are families of their own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tk tt uz",
    "semitic": "am ar he mt",
    "indic": "bn gu hi mr ne pa si ur",
    "dravidian": "kn ml ta te",
    "iranian": "fa ku ps tg",
    "sinitic": "yue zh",
    "malayic": "id jv ms su tl",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTERS = bytes(
    b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)  # other ASCII characters become blanks


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter."""
    if not text:
        return False
    plain = text.encode().translate(_LETTERS).replace(b" ", b"")
    return bool(plain) and (plain[0] < 128 or any(c.isalpha() for c in text))


def letter_triples(text: str | None) -> np.ndarray:
    """Roots of the counts of hashed triples of letter bytes, scaled to length one."""
    data = np.frombuffer(b" " + (text or "").encode().translate(_LETTERS) + b" ", np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(WIDTH)
    triples = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    blank = data == 32
    triples = triples[~(blank[1:-1] & (blank[:-2] | blank[2:]))]
    slots = (triples * np.uint32(2654435761)) >> np.uint32(32 - WIDTH.bit_length() + 1)
    counts = np.sqrt(np.bincount(slots, minlength=WIDTH).astype(float))
    length = np.sqrt((counts * counts).sum())
    return counts / length if length else counts


class LanguageModel:
    """Families with their languages, and the machine of each pair: a positive margin means the first."""

    def __init__(self, languages: list[str]) -> None:
        self.families: dict[str, list[str]] = {}
        for code in sorted(languages):
            self.families.setdefault(_FAMILY_OF.get(code, code), []).append(code)
        self.machines: dict[tuple[str, str], tuple[np.ndarray, float]] = {}
        #: Per language, the logarithm of how much more frequent each slot is than if all were alike.
        self.gains: np.ndarray | None = None

    def pairs(self) -> list[tuple[str, str, list[str], list[str]]]:
        """Two names and the languages on either side, for each machine there is to fit."""
        out = [(f"family:{a}", f"family:{b}", self.families[a], self.families[b]) for a, b in combinations(self.families, 2)]
        return out + [(a, b, [a], [b]) for own in self.families.values() for a, b in combinations(own, 2)]

    def _best(self, names: list[str], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row: the name that most machines are for, and how sure the least sure of these is."""
        n = len(features)
        votes, total, least = np.zeros((n, len(names))), np.zeros((n, len(names))), np.ones((n, len(names)))
        for (i, a), (j, b) in combinations(enumerate(names), 2):
            weights, shift = self.machines[a, b]
            margin = features @ weights + shift
            sure = 1 / (1 + np.exp(-np.clip(margin * math.log(19) / SURE_MARGIN, -60, 60)))
            votes[:, i] += margin > 0
            votes[:, j] += margin <= 0
            total[:, i] += margin
            total[:, j] -= margin
            least[:, i] = np.minimum(least[:, i], sure)
            least[:, j] = np.minimum(least[:, j], 1 - sure)
        best = np.lexsort((np.broadcast_to(-np.arange(len(names)), votes.shape), total, votes), axis=1)[:, -1]
        return best, least[np.arange(n), best]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score in [0, 1] of each text."""
        known = [i for i, t in enumerate(texts) if self.families and has_letter(t)]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for start in range(0, len(known), 512):
            rows = known[start : start + 512]
            features = np.stack([letter_triples(texts[i]) for i in rows])
            families = list(self.families)
            family, sure = self._best([f"family:{f}" for f in families], features)
            for f, code in enumerate(families):
                own = np.flatnonzero(family == f)
                if len(own):
                    best, within = self._best(self.families[code], features[own])
                    for at, which, p in zip(own, best, within * sure[own]):
                        names[rows[at]], scores[rows[at]] = self.families[code][which], p
        return names, scores


    def familiarity(self, texts: list[str | None]) -> np.ndarray:
        """The mean gain of a text's triples in the language they are most frequent in; 0 is no better than chance.

        It does not compare languages, so it also tells that a text is in none of them.
        """
        out = np.zeros(len(texts))
        for start in range(0, len(texts) if self.gains is not None else 0, 512):
            shares = np.stack([letter_triples(t) for t in texts[start : start + 512]]) ** 2
            out[start : start + 512] = (shares @ self.gains.T).max(axis=1)
        return out


def fit(
    docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", familiar: bool = False
) -> LanguageModel:
    """Learn from the rows where ``training`` is true, whose language is known and whose text has a letter.

    ``familiar``: learn as well what :func:`predict` needs to say how familiar a text is.
    """
    rows = docs.filter(training & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = {lang: n for lang, n in rows.groupBy("lang").count().collect()}  # one row per language
    model = LanguageModel(list(counts))
    pairs = model.pairs()
    if not pairs and not (familiar and counts):
        return model
    drawn = F.lit(False)
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000_007))
    for lang, n in counts.items():
        drawn = drawn | ((F.col("lang") == lang) & (place < int(1_000_000_007 * min(1.0, PER_LANGUAGE / n)) + 1))

    def features(tables):
        for table in tables:
            found = [letter_triples(t) for t in table.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([table.column("lang"), pa.array(found, pa.list_(pa.float64()))], ["lang", "values"])

    sample = rows.filter(drawn).select("lang", "text").mapInArrow(features, "lang string, values array<double>")
    sample = written(sample, "language-sample").select("lang", array_to_vector("values").alias("features"))
    if familiar:
        # One row per language; squares of the features are shares of the triples.
        summary = Summarizer.metrics("normL2", "count").summary(F.col("features")).alias("s")
        sums = sample.groupBy("lang").agg(summary).select("s.normL2", "s.count").collect()
        model.gains = np.log(0.1 + 0.9 * WIDTH * np.stack([norm.toArray() ** 2 / n for norm, n in sums])) if sums else None
    for a, b, first, second in pairs:
        own = sample.filter(F.col("lang").isin(first + second)).withColumn("label", F.col("lang").isin(first).cast("double"))
        fitted = LinearSVC(maxIter=30, regParam=1e-4, standardization=False).fit(own)
        model.machines[a, b] = (fitted.coefficients.toArray(), float(fitted.intercept))
    return model


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row.

    ``und`` with score 0 if the text is null or has no letter, or nothing could be learned; if only one
    language could, it is that. Existing columns of those names are replaced. Ties between languages
    go to the first code in order. If the model was fitted with ``familiar``, ``familiarity`` is added, too.
    """
    familiar = model.gains is not None

    @F.pandas_udf("lang_pred string, score double" + (", familiarity double" if familiar else ""))
    def judge(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.predict(list(texts))
        found = {"lang_pred": names, "score": scores}
        return pd.DataFrame(found | {"familiarity": model.familiarity(list(texts))} if familiar else found)

    added = ["lang_pred", "score", *(["familiarity"] if familiar else [])]
    judged = docs.drop(*added).withColumn("_judged", judge.asNondeterministic()(F.col(text_col)))
    return judged.withColumns({name: F.col(f"_judged.{name}") for name in added}).drop("_judged")
