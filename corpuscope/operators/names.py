"""Finding names by parts of their words, for a whole table of needles, by an index of their letters in threes.

A name holds a needle only if it holds all its runs of three letters. Their postings are intersected first, and
the exact test (:func:`contains_all`, case and accents aside) only sees what is left.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from corpuscope.functions.text import fold, split_words
from corpuscope.operators.search import scan_of
from corpuscope.runtime import written
from corpuscope.schema import require_columns
from corpuscope.sources.layout import with_bucket

GRAM = 3
#: The postings of a gram are dealt to so many shards, as some grams are in most names.
SHARDS = 8
#: Postings of names with letters whose comparison is not known here: they are always tested.
ODD = "*odd*"
#: Postings of all names, for needles without a letter that is known here.
ANY = "*any*"

# Accents that the comparison passes over; other marks may count as letters.
_MARKS = frozenset(map(chr, (*range(0x300, 0x305), *range(0x306, 0x30D), 0x313, 0x314, 0x327, 0x328, 0x342)))
_LETTER = r"[ -~α-ω]"
_KNOWN = r"[^ -~α-ω]+"


@cache
def _plain() -> tuple[str, str]:
    """Letters and what they compare as: one letter of the Latin or Greek alphabet; marks fall away."""
    source, target = [], []
    for code in range(0x41, min(sys.maxunicode, 0x2000)):
        base, *marks = unicodedata.normalize("NFD", chr(code))
        plain = base.lower().replace("ς", "σ")
        known = len(plain) == 1 and ("a" <= plain <= "z" or "α" <= plain <= "ω")
        if known and plain != chr(code) and _MARKS.issuperset(marks):
            source.append(chr(code))
            target.append(plain)
    return "".join(source) + "".join(sorted(_MARKS)), "".join(target)


def plain_letters(text: Column) -> Column:
    """A text in plain lower-case letters, as far as their comparison is known; other letters stay."""
    return F.translate(text, *_plain())


def _stretches(text: Column) -> Column:
    """The parts of a text between letters that are not known."""
    return F.filter(F.split(plain_letters(text), _KNOWN), lambda part: part != "")


def _runs(part: Column, letters: int) -> Column:
    """All runs of so many letters of a part of a needle; a shorter part is one itself."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(part) - (letters - 1), F.lit(1)))
    return F.transform(starts, lambda at: F.substring(part, at, letters))


def _all_runs(text: Column) -> Column:
    """The different runs of one to three known letters of a whole text.

    Each length takes one walk through the text; cutting them out by position would walk to each position anew.
    """
    plain = plain_letters(text)
    runs = [F.regexp_extract_all(plain, F.lit(f"(?=({_LETTER}{{{n}}}))"), F.lit(1)) for n in range(1, GRAM + 1)]
    return F.array_distinct(F.concat(*[F.array_distinct(run) for run in runs]))


@dataclass(frozen=True)
class Names:
    """``names(name_id, name)``, ``postings(gram, shard, name_id)``; ``buckets`` for a stored index."""

    names: DataFrame
    postings: DataFrame
    buckets: int | None = None


def build_names(rows: DataFrame, name: str, name_id: str) -> Names:
    """The index of a column of names; null names are found by nothing. Written tables."""
    require_columns(rows, [name, name_id])
    names = written(rows.select(F.col(name_id).alias("name_id"), F.col(name).alias("name")).filter("name IS NOT NULL"), "names")
    grams = _all_runs(F.col("name"))
    odd = plain_letters(F.col("name")).rlike(_KNOWN)
    marked = F.concat(grams, F.array(F.lit(ANY)), F.when(odd, F.array(F.lit(ODD))).otherwise(F.array().cast("array<string>")))
    shard = F.pmod(F.xxhash64("name_id"), F.lit(SHARDS)).cast("int").alias("shard")
    return Names(names, written(names.select("name_id", shard, F.explode(marked).alias("gram")), "name-postings"))


def find_names(index: Names, needles: DataFrame) -> DataFrame:
    """``(needle_id, name_id, name)``: the names that contain every blank-separated word of ``needles(needle_id, needle)``.

    The same as :func:`contains_all` of each name and needle; blank and null needles find nothing. A needle
    that repeats an id is one more needle of that id. A needle without any letter of the Latin or Greek
    alphabet, digit or ASCII sign is tested against all names.
    """
    words = F.array_distinct(split_words(F.coalesce("needle", F.lit(""))))
    asked = needles.select("needle_id", words.alias("words")).filter(F.size("words") > 0)
    asked = written(asked.withColumn("ask", F.monotonically_increasing_id()), "needles")

    parts = F.flatten(F.transform("words", lambda word: _stretches(word)))
    grams = F.array_distinct(F.flatten(F.transform(parts, lambda part: _runs(part, GRAM))))
    grams = F.when(F.size(grams) > 0, grams).otherwise(F.array(F.lit(ANY)))
    wanted = asked.select("ask", F.explode(F.array_append(grams, F.lit(ODD))).alias("gram"), F.size(grams).alias("all"))
    wanted = wanted.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(SHARDS - 1))))
    wanted = written(wanted, "wanted-grams")

    placed, keys = with_bucket(wanted, ["gram", "shard"], index.buckets)
    met = placed.join(scan_of(index.postings, wanted, "gram", index.buckets), keys)
    hits = met.groupBy("ask", "name_id").agg(
        F.count_if(F.col("gram") != ODD).alias("hits"), F.bool_or(F.col("gram") == ODD).alias("odd"), F.first("all").alias("all")
    )
    left = written(hits.filter("odd OR hits = all").select("ask", "name_id"), "possible-names")
    possible, keys = with_bucket(left, ["name_id"], index.buckets)
    found = possible.join(scan_of(index.names, left, "name_id", index.buckets), keys).join(asked, "ask")
    exact = F.forall("words", lambda word: F.contains(fold(F.col("name")), fold(word)))
    return found.filter(exact).select("needle_id", "name_id", "name")
