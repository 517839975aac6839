"""Cleaning of speeches and queries, stop words and stems."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from corpuscope.functions.text import Stemmer, clean_text
from corpuscope.schema import require_columns


def clean_speeches(
    df: DataFrame,
    stops: Sequence[str] = (),
    stemmer: Stemmer | None = None,
    min_chars: int = 50,
) -> DataFrame:
    """Add ``clean_text`` to every speech and keep those of at least ``min_chars`` characters.

    Original and cleaned text stay on one row, so nothing has to be aligned later. Empty and
    null speeches are dropped.
    """
    require_columns(df, ["speech"])
    cleaned = clean_text(F.col("speech"), stops, stemmer)
    # Exploding an array of none or one text filters on the cleaned text without computing it
    # twice, as a filter would once the optimizer has pushed it below the projection.
    kept = F.filter(F.array(cleaned), lambda text: F.length(text) >= min_chars)
    spoken = df.filter(F.col("speech").isNotNull() & (F.col("speech") != ""))
    return spoken.select("*", F.explode(kept).alias("clean_text"))


def clean_queries(
    df: DataFrame,
    column: str = "query",
    stops: Sequence[str] = (),
    stemmer: Stemmer | None = None,
) -> DataFrame:
    """Add ``clean_text`` to every query; as for speeches, but words of one character go too.

    A query that is null or cleans to nothing keeps its row with an empty text.
    """
    require_columns(df, [column])
    cleaned = clean_text(F.col(column), stops, stemmer, min_word=2)
    return df.withColumn("clean_text", F.coalesce(cleaned, F.lit("")))


def remove_stopwords_join(tokens: DataFrame, stops: DataFrame, column: str = "term") -> DataFrame:
    """Rows of ``tokens`` whose ``column`` is not a stop stem, for lists too long for a literal.

    The planner broadcasts the list only if its measured size allows it.
    """
    return tokens.join(stops.select(F.col("stem").alias(column)), column, "left_anti")


def stem_vocabulary(terms: DataFrame, stemmer: Stemmer, column: str = "term") -> DataFrame:
    """``(term, stem)`` for each distinct term; each is stemmed once and in lower case."""
    distinct = terms.select(F.col(column).alias("term")).distinct()
    return distinct.withColumn("stem", F.lower(stemmer(F.upper("term"))))


def apply_stems(tokens: DataFrame, stems: DataFrame, column: str = "term") -> DataFrame:
    """Replace each token by its stem; tokens without a stem (rejected) are dropped.

    Repeated tokens must be counted before, so that the join sees each term of an entity once.
    """
    stems = stems.filter(F.col("stem").isNotNull()).select(F.col("term").alias(column), "stem")
    return tokens.join(stems, column).drop(column).withColumnRenamed("stem", column)


def build_stopwords(words: DataFrame, stemmer: Stemmer, column: str = "word") -> DataFrame:
    """The stop-stem dictionary of a word list: distinct stems in ascending order."""
    stems = stem_vocabulary(words, stemmer, column).select("stem")
    return stems.filter(F.col("stem").isNotNull()).distinct().orderBy("stem")
