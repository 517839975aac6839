from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from corpuscope.functions import dates, greek, text
from corpuscope.functions.greek import greek_stem
from corpuscope.functions.sentiment import Lexicon, sentiment


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "given_, wanted",
    [("1.234,5", "12345"), ("1.2.3.4", "1234"), ("a.1 ,2", "a.1 ,2"), ("1. 2", "1. 2")],
)
def test_join_numbers(spark, given_, wanted):
    assert value(spark, text.join_numbers(F.lit(given_))) == wanted


def test_punctuation_becomes_spaces(spark):
    assert len(text.PUNCTUATION) == 41
    stripped = value(spark, text.strip_punct(F.lit("«α»…b’c–d΄[e]\\f")))
    assert stripped == " α  b c d  e  f"


def test_split_on_unicode_blanks(spark):
    spoken = "a b c\x1cd\x85e \t\nf"
    assert value(spark, text.split_words(F.lit(spoken))) == spoken.split()
    assert value(spark, text.split_words(F.lit("  "))) == []


def test_stop_words_keep_duplicates_of_others(spark):
    words = F.array(*[F.lit(w) for w in "a b a c b".split()])
    assert value(spark, text.remove_stopwords(words, ["b"])) == ["a", "a", "c"]
    assert value(spark, text.remove_stopwords(words, [])) == list("abacb")


def test_tokens_and_words(spark):
    spoken = "Η x_1 Ένα-δύο ½½ a, Straße"
    assert value(spark, text.tokens(F.lit(spoken))) == re.findall(r"\b\w\w+\b", spoken.lower())
    assert value(spark, text.words(F.lit(spoken))) == re.findall(r"\w+", spoken.lower())


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.sampled_from("aa bb cc dd".split()), max_size=12))
def test_count_terms_counts(spark, terms):
    counted = value(spark, text.count_terms(F.lit(terms).cast("array<string>")))
    assert {row["term"]: row["tf"] for row in counted} == {t: terms.count(t) for t in terms}


def test_clean_text(spark):
    clean = text.clean_text(F.lit("The CAT, sat; on 1.000 (the) mats."), ["the", "on"], None)
    assert value(spark, clean) == "cat sat 1000 mats"


def test_clean_text_drops_stop_stems_and_rejected_words(spark):
    def stemmer(word):
        return F.when(word != "BAD", F.regexp_replace(word, "S$", ""))

    clean = text.clean_text(F.lit("cats bad s dogs owl"), ["dog"], stemmer)
    assert value(spark, clean) == "cat  owl"  # the empty stem of "s" stays as an empty token


def test_greek_final_sigma_and_sharp_s(spark):
    assert value(spark, text.clean_text(F.lit("ΝΌΜΟΣ Straße"), [], None)) == "νόμος strasse"


@pytest.mark.parametrize(
    "day, year", [("31/12/1999", 1999), ("1/2/2020", 2020), ("31/02/2020", None), ("n/a", None),
                  ("2020-01-02", None), ("1/2/20", None), (None, None)]
)
def test_years(spark, day, year):
    assert value(spark, dates.year_of(F.lit(day).cast("string"))) == year
    assert value(spark, dates.year_or_zero(F.lit(day).cast("string"))) == (year or 0)


def test_snippet_always_ends_in_points(spark):
    assert value(spark, text.snippet(F.lit("abc"))) == "abc..."
    assert value(spark, text.snippet(F.lit("ä" * 400))) == "ä" * 300 + "..."


@pytest.mark.parametrize(
    "terms, hit", [("ανδρεα", True), ("παπ ΑΝΔΡ", True), ("παπ γεωρ", False), ("  ", False)]
)
def test_contains_all(spark, terms, hit):
    assert value(spark, text.contains_all(F.lit("Ανδρέας Παπανδρέου"), terms)) is hit
    assert value(spark, text.contains_all(F.lit(None).cast("string"), terms)) is False


@pytest.mark.parametrize(
    "spoken, score",
    [
        ("δεν υπάρχει ελπίδα", -1.0),
        ("κρίση και ελπίδα", 0.0),
        ("ΕΛΠΊΔΑ, ανάπτυξη: κρίση!", 1 / 3),
        ("μην δεν κρίση", 1.0),
        ("δεν το είχε ελπίδα", 1.0),
        ("καλημέρα σας", 0.0),
        ("", 0.0),
        (None, 0.0),
    ],
)
def test_greek_sentiment(spark, spoken, score):
    found = value(spark, sentiment(F.lit(spoken).cast("string")))
    assert found == pytest.approx(score)


def naive_sentiment(spoken: str, lexicon: Lexicon) -> float:
    words, values = re.findall(r"\w+", spoken.lower()), []
    for at, word in enumerate(words):
        size = (word in lexicon.positive) - (word in lexicon.negative)
        if size:
            before = words[max(0, at - 2) : at]
            values.append(-size if set(before) & set(lexicon.negations) else size)
    return sum(values) / len(values) if values else 0.0


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.sampled_from("good bad not so".split()), max_size=10))
def test_sentiment_against_plain_python(spark, words):
    lexicon = Lexicon(["good"], ["bad"], ["not"])
    spoken = " ".join(words)
    found = value(spark, sentiment(F.lit(spoken), lexicon))
    assert found == pytest.approx(naive_sentiment(spoken, lexicon))


@pytest.mark.parametrize(
    "word, stem",
    [
        ("υπουργός", "υπουργ"),
        ("υπουργέ", "υπουργ"),
        ("κυβέρνησης", "κυβερνης"),
        ("τους", "τους"),
        ("του", "του"),
        ("έχουμε", "εχ"),
        ("έχουν", "εχ"),
        ("είναι", "εινα"),
        ("κύριοι", "κυρι"),
        ("συγκεκριμένα", "συγκεκρι"),
            ("από", "απο"),
            ("όχι", "οχι"),
            ("θέμα", "θεμ"),
        ("η", "η"),
        ("1991", "1991"),
        ("the", "the"),
    ],
)
def test_greek_stem(spark, word, stem):
    assert value(spark, F.lower(greek_stem(F.upper(F.lit(word))))) == stem


@pytest.mark.parametrize(
    "forms",
    [
        "πρόβλημα προβλήματα προβλημάτων προβλήματος",
        "κυβέρνηση κυβέρνησης κυβερνήσεις κυβερνήσεων κυβερνήσεως",
        "τάξη τάξης τάξεις τάξεων",
        "ψηφίζω ψηφίζει ψηφίζουμε ψηφίζετε ψηφίζουν ψηφίζοντας",
        "έρχομαι έρχεται έρχονται ερχόμαστε ερχόσαστε",
        "υπουργός υπουργού υπουργέ υπουργοί υπουργών υπουργούς υπουργό",
        "πολιτική πολιτικής πολιτικές πολιτικών πολιτικά",
        "χώρα χώρας χώρες χωρών",
    ],
)
def test_forms_of_a_word_share_a_stem(spark, forms):
    words = spark.createDataFrame([(w,) for w in forms.split()], "word string")
    stems = {r[0] for r in words.select(greek_stem(F.upper("word"))).collect()}
    assert len(stems) == 1 and min(map(len, stems)) >= 2


def test_words_that_are_not_inflected_can_be_kept(spark):
    assert value(spark, greek_stem(F.upper(F.lit("από")), keep=["ΑΠΟ"])) == "ΑΠΟ"


def test_the_stem_by_last_letter_is_that_of_the_whole_pattern(spark):
    """One regular expression for the endings of a word's last letter, and each step of a word written once."""
    rests = ["", "Κ", "ΚΡ", "ΓΡΑΜ", "ΠΟΛ", "ΛΕΞ", "ΑΠΟΦΑΣ", "ΒΑ", "ΜΑ"]
    endings = [ending for _, listed in greek._RULES for ending in listed.split()] + ["", "Τ", "ΟΥΤ"]
    words = [(rest + ending,) for rest in rests for ending in endings] + [("CAT",), ("ΚΑΤA",), (None,)]
    groups = "".join(f"${i}" for i in range(1, greek.GROUPS + 1))
    whole = F.when(F.col("w").rlike("^[Α-Ω]+$"), F.regexp_replace("w", greek.PATTERN, groups)).otherwise(F.col("w"))
    stems = spark.createDataFrame(words, "w string").select("w", greek.greek_stem(F.col("w"), ()).alias("stem"), whole.alias("whole"))
    assert stems.filter("NOT (stem <=> whole)").collect() == []
    assert stems.filter("stem <> w").count() > 300
    assert str(greek.greek_stem(F.col("w"))._jc).count("translate") == 1
