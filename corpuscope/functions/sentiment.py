"""Lexicon sentiment of one text as a Column expression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from corpuscope.functions.text import let, words

# The default Greek lexicons.
POSITIVE = """
    καλό καλή επιτυχία ανάπτυξη πρόοδος θετικό ελπίδα λύση εξαιρετική δίκαιο σωστό συμφωνώ
    στήριξη δημοκρατία ελευθερία ασφάλεια σταθερότητα ευημερία κέρδος άριστα μπράβο
    συγχαρητήρια δικαιοσύνη όραμα εμπιστοσύνη αξιοπρέπεια αλληλεγγύη
""".split()
NEGATIVE = """
    κακό λάθος αποτυχία κρίση ύφεση καταστροφή ντροπή αίσχος πρόβλημα ανεργία φτώχεια σκάνδαλο
    έγκλημα κίνδυνος απειλή ανικανότητα ψέμα απάτη βία χρέος μνημόνιο δυστυχία αντίθετος
    διαφθορά υποκρισία κατάρρευση εξαθλίωση πανικός
""".split()
NEGATIONS = "δεν μη μην όχι κανείς ποτέ ουδέποτε ούτε".split()


@dataclass(frozen=True)
class Lexicon:
    """Words that count +1, words that count -1, and words that flip the sign."""

    positive: Sequence[str] = tuple(POSITIVE)
    negative: Sequence[str] = tuple(NEGATIVE)
    negations: Sequence[str] = tuple(NEGATIONS)


def polarities(spoken: Column, lexicon: Lexicon) -> Column:
    """+1, -1 or 0 for each word; a negation one or two words before flips it (once)."""
    positive, negative = list(lexicon.positive), list(lexicon.negative)
    negations = list(lexicon.negations)

    def signed(word: Column, at: Column) -> Column:
        # Before the first word ``get`` is null, which counts as "no negation".
        one_back = F.get(spoken, at - 1).isin(negations)
        two_back = F.get(spoken, at - 2).isin(negations)
        flip = F.when(one_back | two_back, -1).otherwise(1)
        return F.when(word.isin(positive), flip).when(word.isin(negative), -flip).otherwise(0)

    return F.transform(spoken, signed)


def mean_polarity(values: Column) -> Column:
    """Mean of the non-zero polarities; 0.0 when there are none."""
    mean = let(
        F.filter(values, lambda value: value != 0),
        lambda hits: F.try_divide(
            F.aggregate(hits, F.lit(0), lambda left, right: left + right).cast("double"),
            F.size(hits),
        ),
    )
    return F.coalesce(mean, F.lit(0.0))


def sentiment(text: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """Sentiment of a text in [-1, 1]; 0.0 for a null text or one without lexicon words."""
    return mean_polarity(let(words(text), lambda spoken: polarities(spoken, lexicon)))
