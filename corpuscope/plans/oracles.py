"""Plain SQL, for DuckDB, that says what the queries of the catalog compute."""

from __future__ import annotations

from corpuscope.functions.greek import ACCENTED, COMBINING, GROUPS, PATTERN, PLAIN, UNINFLECTED
from corpuscope.functions.text import PUNCTUATION
from corpuscope.plans.views import GREEK_SPEECHES_SQL, GREEK_STOPS, LEXICON, SPEECHES_SQL, STOPS

_BLANKS = r"[\s\p{Z}]+"


def sql_list(words) -> str:
    return "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in words) + "]"


def listed(columns: list[str]) -> str:
    """The values of a row as one text, each with its length in bytes."""
    return " || ',' || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns)


def digits_joined(text: str) -> str:
    """There is no look-behind in RE2, but joining twice gives the same."""
    once = rf"regexp_replace({text}, '(\d)[.,](\d)', '\1\2', 'g')"
    return rf"regexp_replace({once}, '(\d)[.,](\d)', '\1\2', 'g')"


def unpunctuated(text: str) -> str:
    punctuation = PUNCTUATION.replace("'", "''")
    return f"translate({text}, '{punctuation}', '{' ' * len(PUNCTUATION)}')"


def cleaned(text: str, min_word: int = 1) -> str:
    lowered = f"replace(lower({text}), 'ß', 'ss')"
    words = f"string_split_regex({unpunctuated(digits_joined(lowered))}, '{_BLANKS}')"
    keep = f"length(w) >= {min_word} AND NOT list_contains({sql_list(STOPS)}, w)"
    return f"array_to_string(list_filter({words}, lambda w: {keep}), ' ')"


def greek_stemmed(word: str) -> str:
    """The stem of an upper-cased word."""
    plain = f"translate({word}, '{ACCENTED}{COMBINING}', '{PLAIN}')"
    groups = "".join(f"\\{i}" for i in range(1, GROUPS + 1))
    stem = f"regexp_replace({plain}, '{PATTERN}', '{groups}')"
    return f"""CASE WHEN list_contains({sql_list(UNINFLECTED)}, {plain}) THEN {plain}
    WHEN regexp_full_match({plain}, '[Α-Ω]+') THEN {stem} ELSE {word} END"""


def cleaned_greek(text: str, min_word: int = 1, longest: int = 14) -> str:
    """As ``cleaned``, with stems; stems of more than ``longest`` letters are rejected.

    The final sigma is written as any other, since engines differ in lower-casing it.
    """
    stops = sql_list([stop.upper() for stop in GREEK_STOPS])
    upper = f"upper(replace(lower({text}), 'ß', 'ss'))"
    words = f"string_split_regex({unpunctuated(digits_joined(upper))}, '{_BLANKS}')"
    words = f"list_filter({words}, lambda w: length(w) >= {min_word} AND NOT list_contains({stops}, w))"
    stems = f"list_transform({words}, lambda w: {greek_stemmed('w')})"
    stems = f"list_filter({stems}, lambda w: length(w) <= {longest} AND NOT list_contains({stops}, w))"
    return f"replace(lower(array_to_string({stems}, ' ')), 'ς', 'σ')"


def tokenized(text: str, least: int = 2) -> str:
    return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{{least},}}')"


YEAR = "year(try_strptime(sitting_date, '%d/%m/%Y'))"

CLEAN = f"""{SPEECHES_SQL},
cleaned AS (
  SELECT *, {cleaned('speech')} AS clean_text FROM speeches WHERE speech <> ''
),
clean AS (SELECT *, {YEAR} AS year FROM cleaned WHERE length(clean_text) >= 50)"""

CLEAN_GREEK = CLEAN.replace(SPEECHES_SQL, GREEK_SPEECHES_SQL).replace(cleaned("speech"), cleaned_greek("speech"))


def weights(key: str, min_df: int = 1, clean: str = CLEAN) -> str:
    """CTEs ending in ``weights(key, term, tf, df, idf, raw, weight)``."""
    return f"""{clean},
counts AS (
  SELECT {key}, term, count(*) AS tf
  FROM (SELECT {key}, unnest({tokenized('clean_text')}) AS term FROM clean
        WHERE {key} IS NOT NULL)
  GROUP BY ALL
),
n AS (SELECT count(DISTINCT {key}) AS n FROM clean),
terms AS (
  SELECT term, count(*) AS df, ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0 AS idf
  FROM counts, n GROUP BY term HAVING count(*) >= {min_df}
),
raws AS (SELECT c.*, df, idf, tf * idf AS raw FROM counts c JOIN terms USING (term)),
weights AS (
  SELECT w.*, raw / norm AS weight
  FROM raws w JOIN (SELECT {key}, sqrt(sum(raw * raw)) AS norm FROM raws GROUP BY ALL)
  USING ({key})
)"""


def keywords(key: str, n: int = 20) -> str:
    """CTEs ending in ``report(key, top_keywords)``."""
    return f"""{weights(key)},
ranked AS (
  SELECT {key}, term, row_number() OVER (PARTITION BY {key} ORDER BY raw DESC, term) AS rn
  FROM weights
),
report AS (
  SELECT e.{key}, coalesce(string_agg(term, ', ' ORDER BY rn), '') AS top_keywords
  FROM (SELECT DISTINCT {key} FROM clean WHERE {key} IS NOT NULL) e
  LEFT JOIN (SELECT * FROM ranked WHERE rn <= {n}) r ON e.{key} = r.{key}
  GROUP BY ALL
)"""


def values(rows, columns: str) -> str:
    def literal(value) -> str:
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    key = columns.split(",")[0]
    return f"(SELECT * REPLACE (CAST({key} AS BIGINT) AS {key}) FROM (VALUES {body}) AS t({columns}))"


def scores(queries: str, clean: str = CLEAN, clean_query: str = cleaned("query", 2)) -> str:
    """CTEs ending in ``matches`` for the relation ``queries(query_id, query)``."""
    return f"""{weights('speech_id', clean=clean)},
queries AS (
  SELECT query_id, coalesce({clean_query}, '') AS clean_text
  FROM {queries}
),
query_counts AS (
  SELECT query_id, term, count(*) AS tf
  FROM (SELECT query_id, unnest({tokenized('clean_text')}) AS term FROM queries) GROUP BY ALL
),
query_raws AS (SELECT query_id, term, tf * idf AS raw FROM query_counts JOIN terms USING (term)),
query_weights AS (
  SELECT q.query_id, term, raw / norm AS query_weight
  FROM query_raws q
  JOIN (SELECT query_id, sqrt(sum(raw * raw)) AS norm FROM query_raws GROUP BY ALL)
  USING (query_id)
),
scored AS (
  SELECT query_id, speech_id, sum(query_weight * weight) AS score
  FROM query_weights JOIN weights USING (term) GROUP BY ALL
),
matches AS (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY round(score, 9) DESC, speech_id) AS rank
  FROM scored
)"""


RESULT = """
SELECT query_id, rank, m.speech_id,
       coalesce(member_name, '') AS member_name, coalesce(sitting_date, '') AS sitting_date,
       coalesce(political_party, '') AS political_party,
       left(speech, 300) || '...' AS speech_snippet, speech AS full_speech,
       round_even(score, 4) AS score
FROM matches m JOIN clean USING (speech_id)"""


def similar(key: str, limit: int) -> str:
    return f"""WITH {weights(key)}
SELECT a.{key} AS a, b.{key} AS b, round(sum(a.weight * b.weight), 6) AS similarity
FROM weights a JOIN weights b ON a.term = b.term AND a.{key} < b.{key}
GROUP BY ALL HAVING sum(a.weight * b.weight) > 0.1
ORDER BY round(sum(a.weight * b.weight), 9) DESC, 1, 2 LIMIT {limit}"""


def sentiments(table: str) -> str:
    """CTEs ending in ``scores(speech_id, sitting_date, value)`` over a table of speeches."""
    positive, negative = sql_list(LEXICON.positive), sql_list(LEXICON.negative)
    negations = sql_list(LEXICON.negations)
    return f"""
heard AS (
  SELECT speech_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos
  FROM (SELECT speech_id, {tokenized('speech', 1)} AS words FROM {table})
),
looked AS (
  SELECT *, lag(word, 1) OVER w AS one, lag(word, 2) OVER w AS two
  FROM heard WINDOW w AS (PARTITION BY speech_id ORDER BY pos)
),
signed AS (
  SELECT speech_id,
         CASE WHEN list_contains({positive}, word) THEN 1
              WHEN list_contains({negative}, word) THEN -1 ELSE 0 END
         * CASE WHEN list_contains({negations}, coalesce(one, ''))
                  OR list_contains({negations}, coalesce(two, '')) THEN -1 ELSE 1 END AS value
  FROM looked
),
scores AS (
  SELECT t.speech_id, t.sitting_date, coalesce(value, 0.0) AS value
  FROM {table} t
  LEFT JOIN (SELECT speech_id, sum(value)::DOUBLE / count(*) AS value
             FROM signed WHERE value <> 0 GROUP BY ALL) s ON t.speech_id = s.speech_id
)"""


def leading_topic(rounds: int = 30, n: int = 15) -> str:
    """The first topic by power iteration on two vectors, written out round by round.

    The two largest singular values are close, so the last step solves for both at once: the
    larger eigenvalue of [[aa, ab], [ab, bb]], the products of the two images.
    """
    steps = ["v0 AS (SELECT term, 1.0 AS a, CASE WHEN df % 2 = 0 THEN 1.0 ELSE -1.0 END AS b FROM terms)"]
    for i in range(rounds):
        steps += [
            f"""u{i} AS MATERIALIZED (
  SELECT speech_id, sum(weight * a) AS a, sum(weight * b) AS b
  FROM weights JOIN v{i} USING (term) GROUP BY ALL
)""",
            f"""w{i} AS MATERIALIZED (
  SELECT term, sum(weight * a) AS a, sum(weight * b) AS b
  FROM weights JOIN u{i} USING (speech_id) GROUP BY ALL
)""",
            f"""o{i} AS MATERIALIZED (
  SELECT term, a, b - a * (SELECT sum(a * b) / sum(a * a) FROM w{i}) AS b FROM w{i}
)""",
            f"""v{i + 1} AS MATERIALIZED (
  SELECT term, a / (SELECT sqrt(sum(a * a)) FROM o{i}) AS a,
         b / (SELECT sqrt(sum(b * b)) FROM o{i}) AS b
  FROM o{i}
)""",
        ]
    chain = ",\n".join(steps)
    heads = weights("speech_id", 5).replace("weights AS (", "weights AS MATERIALIZED (")
    return f"""WITH {heads},
{chain},
u AS MATERIALIZED (
  SELECT speech_id, sum(weight * a) AS a, sum(weight * b) AS b
  FROM weights JOIN v{rounds} USING (term) GROUP BY ALL
),
g AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb FROM u),
top AS (SELECT *, (aa + bb) / 2 + sqrt((aa - bb) * (aa - bb) / 4 + ab * ab) AS l FROM g),
loaded AS (
  SELECT term, l, (ab * a + (l - aa) * b) / sqrt(ab * ab + (l - aa) * (l - aa)) AS v
  FROM v{rounds}, top
),
signed AS (
  SELECT term, l, v * (SELECT sign(arg_max(v, abs(v))) FROM loaded) AS v FROM loaded
)
SELECT CAST(row_number() OVER (ORDER BY round(v, 9) DESC, term) AS BIGINT) AS rank, term,
       round(v, 6) AS loading, round(sqrt(l), 6) AS sigma
FROM signed ORDER BY rank LIMIT {n}"""


VECTORS = """points AS (
  SELECT vec_id, CAST(label AS BIGINT) AS label, unnest(embedding)::DOUBLE AS x,
         generate_subscripts(embedding, 1) AS pos
  FROM embeddings
),
centroids AS (SELECT label, pos, avg(x) AS c FROM points GROUP BY ALL)"""

EMBEDDED = "(SELECT s.*, label FROM speeches s JOIN embeddings ON vec_id = speech_id)"
