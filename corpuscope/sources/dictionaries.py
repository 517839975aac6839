"""Stop-stem dictionaries: text files with one stem per line."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuscope.functions.text import Stemmer
from corpuscope.operators.cleaning import stem_vocabulary
from corpuscope.schema import STEMS, require_columns

_STORED = "term string, stem string, version string"

# A dictionary up to this size is compiled into the cleaning expression as a hash set.
LITERAL_LIMIT = 100_000


def write_stopwords(stems: DataFrame, path: str) -> None:
    """Write the distinct stems in ascending order, one per line."""
    stems.select("stem").distinct().orderBy("stem").write.mode("overwrite").text(path)


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """``stem`` rows: trimmed, lower-cased, distinct, without blanks.

    A missing file gives an empty dictionary and a warning.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        warnings.warn(f"{path} not found, going on without stop words", stacklevel=2)
        return spark.createDataFrame([], STEMS)
    stem = F.lower(F.regexp_replace("value", r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return lines.select(stem.alias("stem")).filter(F.length("stem") > 0).distinct()


def stop_list(stems: DataFrame, limit: int = LITERAL_LIMIT) -> list[str]:
    """The dictionary as a list for :func:`clean_speeches`, refused when it is too long for that.

    A longer one belongs into :func:`remove_stopwords_join`.
    """
    rows = stems.select("stem").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} stop stems; use remove_stopwords_join")
    return sorted(row["stem"] for row in rows)


class StemDictionary:
    """Stems on disk, by word and version of the stemmer, so that a word is stemmed once.

    ``version`` names the stemmer's rules; stems of other versions stay in the folder and are not read.
    """

    def __init__(self, spark: SparkSession, path: str, stemmer: Stemmer, version: str):
        self.spark, self.path, self.stemmer, self.version = spark, path, stemmer, version
        spark.createDataFrame([], _STORED).write.mode("append").partitionBy("version").parquet(path)

    def known(self) -> DataFrame:
        """``(term, stem)`` of every word so far; the stem of a rejected word is null."""
        rows = self.spark.read.schema(_STORED).parquet(self.path).filter(F.col("version") == self.version)
        # Two writers may have added a word, with the same stem.
        return rows.groupBy("term").agg(F.max("stem").alias("stem"))

    def update(self, terms: DataFrame, column: str = "term") -> int:
        """Stem and append the words that are not known yet; returns their number."""
        require_columns(terms, [column])
        words = terms.select(F.col(column).alias("term")).filter("term IS NOT NULL").distinct()
        new = stem_vocabulary(words.join(self.known(), "term", "left_anti"), self.stemmer)
        before = self.known().count()
        rows = new.select("term", "stem", F.lit(self.version).alias("version"))
        rows.write.mode("append").partitionBy("version").parquet(self.path)
        return self.known().count() - before

    def stems(self, terms: DataFrame, column: str = "term") -> DataFrame:
        """``(term, stem)`` of the words of a table, new ones added first; for :func:`apply_stems`."""
        self.update(terms, column)
        words = terms.select(F.col(column).alias("term")).distinct()
        return words.join(self.known(), "term")
