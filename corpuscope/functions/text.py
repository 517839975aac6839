"""Row-level text expressions. All of them are built-in Column expressions (no Python UDF)."""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

Stemmer = Callable[[Column], Column]

# Fixed value: the characters that cleaning turns into spaces.
PUNCTUATION = string.punctuation + "΄‘’“”«»…–"

# Whitespace in the sense of Unicode, which java.util.regex's \s alone does not cover.
_BLANKS = r"[\s\p{Z}\x1c-\x1f\x85]+"
_WORD = r"[\p{L}\p{N}_]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def join_numbers(text: Column) -> Column:
    """Delete a point or comma between two digits: ``1.234,5`` becomes ``12345``."""
    # The mark comes first in the pattern, so that no other character is looked at twice.
    return F.regexp_replace(text, r"[.,](?<=\d[.,])(?=\d)", "")


def strip_punct(text: Column) -> Column:
    """Replace every punctuation character by a space."""
    return F.translate(text, PUNCTUATION, " " * len(PUNCTUATION))


def split_words(text: Column) -> Column:
    """Words between runs of whitespace, without empty ones."""
    return F.filter(F.split(text, _BLANKS), lambda word: word != "")


def remove_stopwords(words: Column, stops: Sequence[str]) -> Column:
    """Drop stop words from a word array; repeated other words stay."""
    if not stops:
        return words
    return F.filter(words, lambda word: ~word.isin(list(stops)))


def tokens(text: Column) -> Column:
    """Index tokens: lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD + "{2,}"), F.lit(0))


def words(text: Column) -> Column:
    """All lower-cased runs of word characters, single characters included."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD + "+"), F.lit(0))


def clean_words(
    text: Column, stops: Sequence[str], stemmer: Stemmer | None, min_word: int = 1
) -> Column:
    """Upper-cased stems of a text: number joining, punctuation, stop words, stemming.

    Stop words are taken out twice, by surface form and again by stem. A stemmer may return
    null for a word it rejects; an empty stem stays an empty token.
    """
    stops = sorted({stop.upper() for stop in stops})

    def kept(word: Column) -> Column:
        keep = F.length(word) >= max(min_word, 1)
        return keep & ~word.isin(stops) if stops else keep

    surface = F.split(strip_punct(join_numbers(F.upper(text))), _BLANKS)
    surface = F.filter(surface, kept)
    if stemmer is None:
        return surface

    def accepted(stem: Column) -> Column:
        return stem.isNotNull() & ~stem.isin(stops) if stops else stem.isNotNull()

    return F.filter(F.transform(surface, lambda word: stemmer(word)), accepted)


def clean_text(
    text: Column, stops: Sequence[str], stemmer: Stemmer | None, min_word: int = 1
) -> Column:
    """The cleaned words joined by one space, in lower case."""
    return F.lower(F.array_join(clean_words(text, stops, stemmer, min_word), " "))


def count_terms(terms: Column) -> Column:
    """The distinct terms of an array with their number, as ``array<struct<term, tf>>``.

    Counting inside the row needs no shuffle: sort, then measure the runs of equal terms.
    """

    def runs(ordered: Column) -> Column:
        def start(term: Column, at: Column) -> Column:
            return F.when((at == 0) | (F.get(ordered, at - 1) != term), at)

        def measured(first: Column) -> Column:
            def run(begin: Column, at: Column) -> Column:
                end = F.coalesce(F.get(first, at + 1), F.size(ordered))
                return F.struct(
                    F.get(ordered, begin).alias("term"), (end - begin).cast("bigint").alias("tf")
                )

            return F.transform(first, run)

        return let(F.array_compact(F.transform(ordered, start)), measured)

    return let(F.sort_array(terms), runs)


def snippet(text: Column, chars: int = 300) -> Column:
    """The first characters of a text, always followed by three points."""
    return F.concat(F.substring(text, 1, chars), F.lit("..."))


def fold(text: Column) -> Column:
    """A text that compares without regard to case and accents."""
    return F.collate(text, "UNICODE_CI_AI")


def contains_all(text: Column, terms: str) -> Column:
    """True when every blank-separated term occurs in ``text``, case and accents aside.

    Blank input matches nothing, and neither does a null text.
    """
    parts = terms.split()
    if not parts:
        return F.lit(False)
    found = [F.contains(fold(text), F.lit(part)) for part in parts]
    return F.coalesce(reduce(lambda left, right: left & right, found), F.lit(False))


def drop_bad_bytes(text: Column) -> Column:
    """Remove the replacement character that the readers put for undecodable bytes."""
    return F.replace(text, F.lit("�"), F.lit(""))
