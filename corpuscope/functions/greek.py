"""A light stemmer for Greek as a Column expression.

Greek stemming by suffix removal is described by Ntais (Stockholm, 2006) and Saroukos (Tampere,
2008). This one removes inflectional endings by rule, the longest that leaves enough of a word. It
needs no Python worker and no lookup, so it runs inside the cleaning projection; its patterns use
nothing that other engines' regular expressions lack, so SQL can repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from corpuscope.functions.text import let

ACCENTED, PLAIN = "ΆΈΉΊΌΎΏΪΫ", "ΑΕΗΙΟΥΩΙΥ"
COMBINING = "̀́̈͂"

# Words that have no endings, by class, upper-cased and without accents: taken whole, as removing what looks
# like an ending would leave one or two letters or make them meet other words.
UNINFLECTED = tuple(
    (
        # prepositions
        "ΑΝΤΙ ΑΠΟ ΓΙΑ ΔΙΑ ΕΠΙ ΚΑΤΑ ΜΕΣΩ ΜΕΤΑ ΜΕΧΡΙ ΠΑΡΑ ΠΕΡΙ ΠΡΟΣ ΥΠΟ ΧΩΡΙΣ ΩΣ "
        # conjunctions and particles
        "ΑΛΛΑ ΑΡΑ ΓΙΑΤΙ ΔΗΛΑΔΗ ΔΙΟΤΙ ΕΠΕΙΔΗ Η ΙΣΩΣ ΛΟΙΠΟΝ ΜΟΛΟΝΟΤΙ ΝΑ ΟΤΙ ΟΥΤΕ ΟΧΙ ΠΙΑ ΩΣΤΕ ΩΣΤΟΣΟ "
        # adverbs
        "ΑΚΟΜΑ ΑΚΟΜΗ ΑΥΡΙΟ ΕΔΩ ΕΚΕΙ ΕΞΗΣ ΕΤΣΙ ΕΞΩ ΗΔΗ ΚΑΤΩ ΜΑΛΙΣΤΑ ΜΕΣΑ ΠΑΛΙ ΠΑΝΤΑ ΠΑΝΩ ΠΕΡΥΣΙ ΠΟΛΥ ΠΟΤΕ ΣΗΜΕΡΑ "
        "ΤΟΤΕ ΤΩΡΑ ΦΕΤΟΣ ΧΘΕΣ "
        # numerals and pronouns
        "ΔΕΚΑ ΔΥΟ ΕΓΩ ΕΞΙ ΕΠΤΑ ΕΣΥ ΚΑΘΕΤΙ ΟΚΤΩ ΠΕΝΤΕ"
    ).split()
)

# Endings, tried in this order, by what has to remain before them.
_RULES = (
    # Neuters in -μα and feminines in -ση, -ξη, -ψη keep their theme in all cases.
    (r".+?Μ", "ΑΤΑ ΑΤΩΝ ΑΤΟΣ ΑΤΙ"),
    (r"..+?[ΣΞΨ]", "ΕΩΣ ΕΩΝ ΕΙΣ"),
    # Verbs in the active and the passive voice, participles.
    (
        r"..+?",
        "ΟΜΑΣΤΑΝ ΟΣΑΣΤΑΝ ΟΜΑΣΤΕ ΟΣΑΣΤΕ ΟΥΜΑΣΤΕ ΟΥΝΤΑΙ ΟΥΝΤΑΝ ΟΝΤΑΙ ΟΝΤΑΝ ΟΜΑΙ ΕΣΑΙ ΕΤΑΙ ΕΣΤΕ "
        "ΟΥΣΑΜΕ ΟΥΣΑΤΕ ΟΥΣΑΝ ΟΥΣΕΣ ΟΥΣΑ ΟΥΣΕ ΟΥΜΕ ΟΥΝΕ ΑΜΕ ΑΤΕ ΑΝΕ ΟΜΕ ΕΤΕ ΟΝΤΑΣ ΩΝΤΑΣ",
    ),
    (r"...+?", "ΜΕΝΟΣ ΜΕΝΟΥ ΜΕΝΟΝ ΜΕΝΟΥΣ ΜΕΝΟΙ ΜΕΝΩΝ ΜΕΝΟ ΜΕΝΗ ΜΕΝΗΣ ΜΕΝΕΣ ΜΕΝΑ"),
    # Nouns and adjectives.
    (r"..+?", "ΟΥΣ ΟΥΝ ΕΙΣ ΟΥ"),
    (r".+?", "ΟΣ ΟΝ ΟΙ ΗΣ ΑΣ ΑΝ ΕΣ ΕΙ ΩΝ ΙΣ"),
    (r".+?", "Α Ε Η Ι Ο Ω"),
)

#: Matches a word with an ending; the rest is in whichever group matched.
PATTERN = "|".join(f"^({rest})(?:{'|'.join(endings.split())})$" for rest, endings in _RULES)
GROUPS = len(_RULES)


def _branches(endings: Sequence[str]) -> str:
    """The endings as one expression that writes what they begin with alike only once."""
    tails: dict[str, list[str]] = {}
    for ending in endings:
        tails.setdefault(ending[:1], []).append(ending[1:])
    parts = [head + (_branches(rest) if any(rest) else "") for head, rest in tails.items()]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def _by_last_letter() -> list[tuple[str, str, str]]:
    """``(letter, pattern, replacement)``: what is left of PATTERN for words that end in a letter.

    All other endings fail on such a word, after a try at each of its letters.
    """
    rules = [(rest, endings.split()) for rest, endings in _RULES]
    found = []
    for letter in sorted({ending[-1] for _, endings in rules for ending in endings}):
        own = [(rest, [ending for ending in endings if ending[-1] == letter]) for rest, endings in rules]
        parts = [f"^({rest}){_branches(endings)}$" for rest, endings in own if endings]
        found.append((letter, "|".join(parts), "".join(f"${i}" for i in range(1, len(parts) + 1))))
    return found


_LETTERS = "^[Α-Ω]+$"
_MARKED = f"^[Α-Ω{ACCENTED}{COMBINING}]+$"


def greek_stem(word: Column, keep: Sequence[str] = UNINFLECTED) -> Column:
    """The stem of an upper-cased word, without accents; words in other scripts stay as they are.

    First words without endings are set aside (``keep``, upper-cased and without accents), then the first rule that fits
    removes one ending and leaves the letters it asks for.
    """

    def stemmed(plain: Column) -> Column:
        stem = plain
        for letter, pattern, rest in _by_last_letter():
            stem = F.when(plain.endswith(letter), F.regexp_replace(plain, pattern, rest)).otherwise(stem)
        return F.when(plain.isin(list(keep)), plain).otherwise(stem) if keep else stem

    # Most words have no accent to take away.
    plain = F.translate(word, ACCENTED + COMBINING, PLAIN)
    marked = let(plain, lambda plain: F.when(plain.rlike(_LETTERS), stemmed(plain)).otherwise(word))
    return F.when(word.rlike(_LETTERS), stemmed(word)).when(word.rlike(_MARKED), marked).otherwise(word)
