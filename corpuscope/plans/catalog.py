"""Named queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from corpuscope.functions import dates, text
from corpuscope.functions.greek import greek_stem
from corpuscope.functions.sentiment import sentiment
from corpuscope.operators import blocks, cleaning, clusters, index as ix, keywords, sampling, search as sr
from corpuscope.operators import names, sentiment as opinion, similarity, topics, trend
from corpuscope.plans import oracles as sql
from corpuscope.plans.views import GREEK_STOPS, LEXICON, STOPS, greek_speeches, speeches, table
from corpuscope.runtime import scratch_path, written
from corpuscope.schema import NEEDLE, QUERIES, SPEECH_COLUMNS, SPEECH_ID, STEMS, WORDS
from corpuscope.sources import dictionaries, ids, indexes, reports, segments, speeches as stored

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    oracle: str | None = None


CATALOG: dict[str, Query] = {}
GROUPS = (SPEECH_ID, "political_party", "year", "member_name")


def query(oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a function of (spark, sf_dir) under its own name."""

    def register(run: Run) -> Run:
        CATALOG[run.__name__] = Query(run, oracle)
        return run

    return register


SEARCHES = [
    (1, "the and thention"),
    (2, "die"),
    (3, "zzzz"),
    (4, ""),
    (5, "tionand tionand haed, 1.5 Eauouon"),
    (6, "ing ou eraux"),
    (7, "Zzzz erandre RE an"),
]
ASKED = sql.values(SEARCHES, "query_id, query")
TRENDS = [(1, "an"), (2, "enaux"), (3, "zzzz"), (4, "re zzzz"), (5, ""), (6, "The and")]


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_speeches(speeches(spark, sf_dir), STOPS)


def built_index(spark: SparkSession, sf_dir: str) -> ix.Index:
    """The index over the cleaned speeches, which are a written table as they are in use."""
    return ix.build_index(written(clean(spark, sf_dir), "clean"))


def selective_stem(word):
    """The Greek stem, or null (rejected) if it is longer than 14 letters."""
    return text.let(greek_stem(word), lambda stem: F.when(F.length(stem) <= 14, stem))


def clean_greek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Greek speeches, cleaned and stemmed, with one form of sigma (see the oracle)."""
    kept = cleaning.clean_speeches(greek_speeches(spark, sf_dir), GREEK_STOPS, selective_stem)
    return kept.withColumn("clean_text", F.translate("clean_text", "ς", "σ"))


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as a relation whose size the planner knows."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def search_table(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SEARCHES, QUERIES)


# Rounding a small negative number gives 0.0 in Spark and -0.0 in DuckDB: hence ``+ 0.0`` below.

# --- text -------------------------------------------------------------------------------------


@query(f"""WITH {sql.SPEECHES_SQL}
SELECT speech_id, {sql.digits_joined('lower(speech)')} AS joined,
       {sql.unpunctuated('lower(speech)')} AS stripped,
       left(speech, 300) || '...' AS snippet
FROM speeches""")
def text_steps(spark, sf_dir):
    lowered = F.lower("speech")
    return speeches(spark, sf_dir).select(
        SPEECH_ID,
        text.join_numbers(lowered).alias("joined"),
        text.strip_punct(lowered).alias("stripped"),
        text.snippet(F.col("speech")).alias("snippet"),
    )


@query(f"""WITH {sql.SPEECHES_SQL}
SELECT speech_id, array_to_string({sql.tokenized('speech', 2)}, ' ') AS index_tokens,
       array_to_string({sql.tokenized('speech', 1)}, ' ') AS words,
       array_to_string(list_filter(string_split_regex(lower(speech), '{sql._BLANKS}'),
                       lambda w: w <> ''), ' ') AS split_words
FROM speeches""")
def tokenizers(spark, sf_dir):
    speech = F.col("speech")
    return speeches(spark, sf_dir).select(
        SPEECH_ID,
        F.array_join(text.tokens(speech), " ").alias("index_tokens"),
        F.array_join(text.words(speech), " ").alias("words"),
        F.array_join(text.split_words(F.lower(speech)), " ").alias("split_words"),
    )


@query(f"""WITH {sql.SPEECHES_SQL}
SELECT speech_id, CAST({sql.YEAR} AS BIGINT) AS year,
       CAST(coalesce({sql.YEAR}, 0) AS BIGINT) AS year_or_zero,
       strftime(try_strptime(sitting_date, '%d/%m/%Y'), '%Y-%m-%d') AS day
FROM speeches""")
def parse_dates(spark, sf_dir):
    day = F.col("sitting_date")
    return speeches(spark, sf_dir).select(
        SPEECH_ID,
        dates.year_of(day).cast("bigint").alias("year"),
        dates.year_or_zero(day).cast("bigint").alias("year_or_zero"),
        dates.parse_date(day).cast("string").alias("day"),
    )


@query(f"""WITH {sql.CLEAN}
SELECT speech_id, member_name, political_party, sitting_date, clean_text,
       CAST(length(speech) AS BIGINT) AS n_chars
FROM clean""")
def clean_speeches(spark, sf_dir):
    return clean(spark, sf_dir).select(
        SPEECH_ID,
        "member_name",
        "political_party",
        "sitting_date",
        "clean_text",
        F.length("speech").cast("bigint").alias("n_chars"),
    )


@query(f"""WITH {sql.SPEECHES_SQL}
SELECT speech_id, coalesce({sql.cleaned('speech', 2)}, '') AS clean_text FROM speeches""")
def clean_queries(spark, sf_dir):
    asked = speeches(spark, sf_dir).select(SPEECH_ID, "speech")
    return cleaning.clean_queries(asked, "speech", STOPS).drop("speech")


@query(f"""WITH {sql.SPEECHES_SQL}
SELECT word AS term, count(*) AS n
FROM (SELECT unnest({sql.tokenized('speech', 1)}) AS word FROM speeches)
WHERE NOT list_contains({sql.sql_list(STOPS)}, word) GROUP BY ALL""")
def stopwords_antijoin(spark, sf_dir):
    spoken = speeches(spark, sf_dir).select(F.explode(text.words(F.col("speech"))).alias("term"))
    stops = literal_table(spark, [(stop,) for stop in STOPS], STEMS)
    counted = spoken.groupBy("term").agg(F.count("*").alias("n"))
    return cleaning.remove_stopwords_join(counted, stops)


@query(f"""WITH {sql.CLEAN_GREEK} SELECT speech_id, clean_text FROM clean""")
def clean_speeches_greek(spark, sf_dir):
    return clean_greek(spark, sf_dir).select(SPEECH_ID, "clean_text")


@query(f"""WITH {sql.GREEK_SPEECHES_SQL},
words AS (SELECT DISTINCT unnest({sql.tokenized('speech', 1)}) AS word FROM speeches),
stems AS (SELECT {sql.greek_stemmed("upper(replace(word, 'ß', 'ss'))")} AS stem FROM words)
SELECT replace(lower(stem), 'ς', 'σ') AS stem, count(*) AS words FROM stems GROUP BY ALL""")
def stem_vocabulary_greek(spark, sf_dir):
    """How many words of the vocabulary share each stem."""
    spoken = greek_speeches(spark, sf_dir).select(F.explode(text.words(F.col("speech"))).alias("term"))
    # One form of sigma before the words are made distinct, as SQL lower-cases them.
    stems = cleaning.stem_vocabulary(spoken.select(F.translate("term", "ς", "σ").alias("term")), greek_stem)
    return stems.groupBy(F.translate("stem", "ς", "σ").alias("stem")).agg(F.count("*").alias("words"))


@query(f"""WITH {sql.GREEK_SPEECHES_SQL},
words AS (SELECT unnest({sql.tokenized('speech', 1)}) AS word FROM speeches),
stems AS (SELECT replace(lower({sql.greek_stemmed("upper(replace(word, 'ß', 'ss'))")}), 'ς', 'σ') AS stem FROM words)
SELECT stem, count(*) AS n FROM stems GROUP BY ALL""")
def stems_from_dictionary(spark, sf_dir):
    """How often each stem is said, by a stored dictionary that learned the words in two parts."""
    spoken = greek_speeches(spark, sf_dir).select(SPEECH_ID, F.explode(text.words(F.col("speech"))).alias("term"))
    spoken = written(spoken.withColumn("term", F.translate("term", "ς", "σ")), "spoken")
    known = dictionaries.StemDictionary(spark, scratch_path(spark, "stem-dictionary"), greek_stem, "1")
    known.update(spoken.filter(F.pmod(SPEECH_ID, F.lit(2)) == 0))
    counted = spoken.groupBy("term").agg(F.count("*").alias("n"))
    merged = cleaning.apply_stems(counted, known.stems(spoken))
    return merged.groupBy(F.translate("term", "ς", "σ").alias("stem")).agg(F.sum("n").alias("n"))


# --- index ------------------------------------------------------------------------------------


@query(f"""WITH {sql.weights('political_party')}
SELECT political_party, term, tf FROM counts""")
def token_counts(spark, sf_dir):
    return ix.term_counts(clean(spark, sf_dir), "political_party").filter(F.col("tf") > 0)


@query(f"""WITH {sql.weights('speech_id')}
SELECT term, df, round(idf, 6) AS idf FROM terms""")
def document_frequencies(spark, sf_dir):
    counts = ix.term_counts(clean(spark, sf_dir), SPEECH_ID)
    return ix.term_stats(counts, SPEECH_ID).select("term", "df", F.round("idf", 6).alias("idf"))


@query(f"""WITH {sql.weights('speech_id', 5)}
SELECT speech_id, term, tf, df, round(weight, 6) AS weight FROM weights""")
def tfidf_min_df(spark, sf_dir):
    weights = ix.tfidf(clean(spark, sf_dir), SPEECH_ID, min_df=5)
    return weights.select(SPEECH_ID, "term", "tf", "df", F.round("weight", 6).alias("weight"))


# --- keywords ---------------------------------------------------------------------------------


@query(f"WITH {sql.keywords('political_party')} SELECT * FROM report")
def keywords_by_party(spark, sf_dir):
    return keywords.keywords_by(clean(spark, sf_dir), "political_party")


@query(f"WITH {sql.keywords('member_name')} SELECT * FROM report")
def keywords_by_member(spark, sf_dir):
    return keywords.keywords_by(clean(spark, sf_dir), "member_name")


@query(f"""WITH {sql.keywords('year')}
SELECT CAST(year AS BIGINT) AS year, top_keywords FROM report""")
def keywords_by_year(spark, sf_dir):
    report = keywords.keywords_by(clean(spark, sf_dir), "year")
    return report.select(F.col("year").cast("bigint").alias("year"), "top_keywords")


@query(f"WITH {sql.keywords('speech_id')} SELECT * FROM report")
def keywords_by_speech(spark, sf_dir):
    return keywords.keywords_by(clean(spark, sf_dir), SPEECH_ID)


@query(" UNION ALL ".join(
    f"""SELECT '{key}' AS grouping, CAST({key} AS VARCHAR) AS entity, top_keywords
FROM (WITH {sql.keywords(key)} SELECT * FROM report)"""
    for key in GROUPS
))
def keywords_in_one_pass(spark, sf_dir):
    """The four reports from one tokenization."""
    dated = keywords.with_year(clean(spark, sf_dir))
    reports_by = [
        report.select(F.lit(key).alias("grouping"), F.col(key).cast("string").alias("entity"), "top_keywords")
        for key, report in keywords.keyword_reports(dated, GROUPS).items()
    ]
    return reduce(DataFrame.unionByName, reports_by)


@query(f"""WITH {sql.keywords('member_name')}
SELECT * FROM report
WHERE contains(strip_accents(lower(member_name)), 'src')
  AND contains(strip_accents(lower(member_name)), '1')""")
def find_member_keywords(spark, sf_dir):
    report = keywords.keywords_by(clean(spark, sf_dir), "member_name")
    return keywords.find_keywords(report, " SRC  1 ")


@query("""SELECT doc_id, source FROM documents
WHERE contains(strip_accents(lower(text)), 'eau') AND contains(strip_accents(lower(text)), 'cion')""")
def accent_insensitive_filter(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return keywords.filter_names(documents, "text", "EAU ción").select("doc_id", "source")


@query("""SELECT doc_id, source FROM documents
WHERE contains(strip_accents(lower(text)), 'eau') AND contains(strip_accents(lower(text)), 'ree')""")
def accented_needles(spark, sf_dir):
    """Needles with accents and capitals find words written with other ones."""
    documents = table(spark, sf_dir, "documents")
    return keywords.filter_names(documents, "text", "ÉaU rÉé").select("doc_id", "source")


NEEDLES = [
    (1, " SRC  1 "), (2, "sŕc"), (3, "rc1 Src"), (4, "7"), (5, "zzz"), (6, ""), (7, "c1 c2"), (8, "SRC19"), (9, None),
]
_FOUND = """SELECT needle_id, {columns} FROM {table}, {needles}
WHERE trim(coalesce(needle, '')) <> ''
  AND len(list_filter(string_split_regex(trim(strip_accents(lower(needle))), ' +'),
                      lambda w: NOT contains(strip_accents(lower({name})), w))) = 0"""


@query(f"""WITH {sql.keywords('member_name')} """ + _FOUND.format(
    columns="member_name, top_keywords", table="report", name="member_name",
    needles=sql.values(NEEDLES, "needle_id, needle"),
))
def find_members_by_needles(spark, sf_dir):
    """The keyword report for a table of needles, by an index of the names' letters."""
    report = written(keywords.keywords_by(clean(spark, sf_dir), "member_name"), "report")
    index = names.build_names(report.select("member_name"), "member_name", "member_name")
    asked = literal_table(spark, NEEDLES, NEEDLE)
    found = names.find_names(index, asked).select("needle_id", F.col("name").alias("member_name"))
    return found.join(report, "member_name")


TEXT_NEEDLES = [(1, "EAU ción"), (2, "ÉaU rÉé"), (3, "ing the"), (4, "q"), (6, "thention OU"), (7, "eau")]


@query(_FOUND.format(
    columns="doc_id, source", table="documents", name="text", needles=sql.values(TEXT_NEEDLES, "needle_id, needle")
))
def find_texts_by_needles(spark, sf_dir):
    """Needles in whole texts, by a stored index of which a lookup reads the buckets of its letters."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    path = scratch_path(spark, "names")
    indexes.save_names(names.build_names(documents, "text", "doc_id"), path, buckets=16)
    found = names.find_names(indexes.load_names(spark, path), literal_table(spark, TEXT_NEEDLES, NEEDLE))
    found = written(found.select("needle_id", F.col("name_id").alias("doc_id")), "found")
    return found.join(documents.drop("text"), "doc_id")


@query(f"WITH {sql.keywords('member_name')} SELECT * FROM report WHERE member_name = 'src7'")
def keywords_of_member(spark, sf_dir):
    return keywords.keywords_by(clean(spark, sf_dir), "member_name", entity="src7")


# --- search and trend -------------------------------------------------------------------------


@query(f"WITH {sql.scores(ASKED)}{sql.RESULT} WHERE rank <= 10 AND score > 0.05")
def search_ranked(spark, sf_dir):
    built = built_index(spark, sf_dir)
    found = sr.search(built, search_table(spark), STOPS)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


GREEK_SEARCHES = [(1, "Ανδ τηοντιον"), (2, "ερεν ινγοσ ΑΝΔΡΕΣ"), (3, "ζζζζ"), (4, "τιοναντα"), (5, None)]


@query(f"""WITH {sql.scores(sql.values(GREEK_SEARCHES, 'query_id, query'), sql.CLEAN_GREEK, sql.cleaned_greek('query', 2))}
SELECT query_id, CAST(rank AS BIGINT) AS rank, speech_id, round_even(score, 4) AS score
FROM matches WHERE rank <= 10 AND score > 0.05""")
def search_greek(spark, sf_dir):
    built = ix.build_index(written(clean_greek(spark, sf_dir), "clean"))
    asked = literal_table(spark, GREEK_SEARCHES, QUERIES)
    found = sr.search(built, asked, GREEK_STOPS, selective_stem)
    return found.select("query_id", F.col("rank").cast("bigint").alias("rank"), SPEECH_ID, "score")


@query(f"""WITH {sql.scores("(SELECT item_id AS query_id, text AS query FROM benchmark)")}
SELECT query_id, CAST(rank AS BIGINT) AS rank, speech_id, round_even(score, 4) AS score
FROM matches WHERE rank <= 10 AND score > 0.05""")
def search_benchmark(spark, sf_dir):
    """A table of queries: every text of ``benchmark``."""
    built = built_index(spark, sf_dir)
    asked = table(spark, sf_dir, "benchmark").selectExpr("item_id AS query_id", "text AS query")
    found = sr.search(built, asked, STOPS)
    return found.select("query_id", F.col("rank").cast("bigint").alias("rank"), SPEECH_ID, "score")


@query(f"""WITH {sql.scores(ASKED)}{sql.RESULT}
WHERE rank > 20 AND rank <= 40 AND score > 0.05""")
def search_page_two(spark, sf_dir):
    built = built_index(spark, sf_dir)
    asked = cleaning.clean_queries(search_table(spark), "query", STOPS)
    scored = sr.score_queries(built, sr.query_weights(built, asked))
    found = sr.records(built, sr.search_page(scored, page=2))
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query(f"""WITH {sql.scores("(SELECT item_id AS query_id, text AS query FROM benchmark)")}
SELECT query_id, CAST(rank AS BIGINT) AS rank, speech_id, round_even(score, 4) AS score
FROM matches WHERE rank <= 10 AND score > 0.05""")
def search_blocks(spark, sf_dir):
    """``search_benchmark`` without reading the blocks that cannot matter."""
    built = built_index(spark, sf_dir)
    path = scratch_path(spark, "blocks")
    indexes.save_blocks(blocks.build_blocks(built, rows=64), path)
    asked = table(spark, sf_dir, "benchmark").selectExpr("item_id AS query_id", "text AS query")
    weights = sr.query_weights(built, cleaning.clean_queries(asked, "query", STOPS))
    found, _ = blocks.search_blocks(indexes.load_blocks(spark, path), weights)
    score = F.bround("score", 4).alias("score")
    return found.select("query_id", F.col("rank").cast("bigint").alias("rank"), SPEECH_ID, score)


@query(f"""WITH {sql.scores("(SELECT item_id AS query_id, text AS query FROM benchmark)")}
SELECT query_id, term, count(*) AS postings, true AS none_twice
FROM query_weights JOIN weights USING (term) GROUP BY ALL""")
def search_blocks_read(spark, sf_dir):
    """The postings of every query's terms, none of which is read twice."""
    built = built_index(spark, sf_dir)
    asked = table(spark, sf_dir, "benchmark").selectExpr("item_id AS query_id", "text AS query")
    weights = sr.query_weights(built, cleaning.clean_queries(asked, "query", STOPS))
    _, read = blocks.search_blocks(blocks.build_blocks(built, rows=64), weights)
    return read.select("query_id", "term", "postings", (F.col("read") <= F.col("postings")).alias("none_twice"))


@query(f"""WITH {sql.scores(ASKED)}
SELECT query_id, CAST(rank AS BIGINT) AS rank, speech_id, round(score, 6) AS score
FROM matches WHERE rank <= 60 AND score > 0.05""")
def search_by_cursor(spark, sf_dir):
    """Three pages, each behind the last row of the one before."""
    built = built_index(spark, sf_dir)
    asked = cleaning.clean_queries(search_table(spark), "query", STOPS)
    scored = written(sr.score_queries(built, sr.query_weights(built, asked)), "scored")
    start = "CAST(NULL AS DOUBLE) AS score", f"CAST(NULL AS BIGINT) AS {SPEECH_ID}", "0 AS rank"
    cursors, pages = asked.selectExpr("query_id", *start), []
    for _ in range(3):
        pages.append(written(sr.search_after(scored, cursors, 20), "page"))
        cursors = sr.next_cursors(pages[-1])
    shown = reduce(DataFrame.unionByName, pages)
    return shown.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), SPEECH_ID, F.round("score", 6).alias("score")
    )


@query(f"""WITH {sql.scores(ASKED)}
SELECT q.query_id, clean_text, count(m.speech_id) AS results
FROM queries q LEFT JOIN (SELECT * FROM matches WHERE rank <= 10 AND score > 0.05) m USING (query_id)
GROUP BY ALL""")
def search_empty_and_unknown(spark, sf_dir):
    built = built_index(spark, sf_dir)
    asked = cleaning.clean_queries(search_table(spark), "query", STOPS)
    scored = sr.score_queries(built, sr.query_weights(built, asked))
    best = sr.best_matches(scored).groupBy("query_id").agg(F.count("*").alias("results"))
    joined = asked.join(best, "query_id", "left").na.fill(0, ["results"])
    return joined.select("query_id", "clean_text", "results")


@query(f"""WITH {sql.scores(ASKED)}
SELECT query_id, speech_id, round(score, 6) AS score FROM scored""")
def search_scores(spark, sf_dir):
    built = built_index(spark, sf_dir)
    asked = cleaning.clean_queries(search_table(spark), "query", STOPS)
    scored = sr.score_queries(built, sr.query_weights(built, asked))
    return scored.select("query_id", SPEECH_ID, F.round("score", 6).alias("score"))


_TREND = f"""WITH {sql.weights('speech_id')},
asked AS (
  SELECT word_id, nullif(split_part(coalesce({sql.cleaned('word', 2)}, ''), ' ', 1), '') AS token
  FROM {sql.values(TRENDS, 'word_id, word')}
),
known AS (SELECT word_id, token, df IS NOT NULL AS found FROM asked LEFT JOIN terms ON token = term),
years AS (SELECT DISTINCT year FROM clean WHERE year > 0),
sums AS (
  SELECT word_id, year, sum(weight) AS score
  FROM known JOIN weights w ON token = term JOIN clean USING (speech_id) GROUP BY ALL
)
SELECT word_id, token, found, CAST(k.year AS BIGINT) AS year,
       CASE WHEN k.year IS NOT NULL THEN round(coalesce(score, 0.0), 6) END AS score
FROM (SELECT * FROM known LEFT JOIN years ON found) k LEFT JOIN sums USING (word_id, year)"""


@query(_TREND)
def term_trend(spark, sf_dir):
    built = built_index(spark, sf_dir)
    words = literal_table(spark, TRENDS, WORDS)
    series = trend.term_trend(built, words, STOPS)
    return series.select(
        "word_id",
        "token",
        "found",
        F.col("year").cast("bigint").alias("year"),
        F.round("score", 6).alias("score"),
    )


@query(_TREND)
def stored_term_trend(spark, sf_dir):
    """The trend from a stored index, without its speeches."""
    path = scratch_path(spark, "index")
    indexes.save_index(built_index(spark, sf_dir), path)
    index = indexes.load_index(spark, path)
    series = trend.term_trend(index, literal_table(spark, TRENDS, WORDS), STOPS)
    return series.select(
        "word_id",
        "token",
        "found",
        F.col("year").cast("bigint").alias("year"),
        F.round("score", 6).alias("score"),
    )


# --- similarity -------------------------------------------------------------------------------


@query(sql.similar("member_name", 100))
def similar_members(spark, sf_dir):
    pairs = similarity.similar_pairs(clean(spark, sf_dir), "member_name")
    return pairs.select("a", "b", F.round("similarity", 6).alias("similarity"))


@query(sql.similar("speech_id", 100))
def similar_speeches(spark, sf_dir):
    """Pairs among hundreds of entities, which are compared block by block."""
    pairs = similarity.similar_pairs(clean(spark, sf_dir), SPEECH_ID)
    return pairs.select("a", "b", F.round("similarity", 6).alias("similarity"))


@query(sql.similar("political_party", 100))
def similar_parties(spark, sf_dir):
    pairs = similarity.similar_pairs(clean(spark, sf_dir), "political_party")
    return pairs.select("a", "b", F.round("similarity", 6).alias("similarity"))


# --- sentiment --------------------------------------------------------------------------------


@query(f"""WITH {sql.SPEECHES_SQL}, {sql.sentiments('speeches')}
SELECT speech_id, round(value, 6) AS sentiment FROM scores""")
def sentiment_scores(spark, sf_dir):
    return speeches(spark, sf_dir).select(
        SPEECH_ID, F.round(sentiment(F.col("speech"), LEXICON), 6).alias("sentiment")
    )


@query(f"""WITH {sql.CLEAN}, {sql.sentiments('clean')}
SELECT CAST({sql.YEAR} AS BIGINT) AS year, round_even(avg(value), 4) + 0.0 AS sentiment
FROM scores WHERE {sql.YEAR} IS NOT NULL GROUP BY ALL""")
def sentiment_by_year(spark, sf_dir):
    series = opinion.sentiment_by_year(clean(spark, sf_dir), LEXICON)
    return series.select(F.col("year").cast("bigint").alias("year"), "sentiment")


# --- samples ----------------------------------------------------------------------------------


@query("""SELECT doc_id, source, lang FROM documents
ORDER BY md5('42:' || doc_id) LIMIT 137""")
def sample_exact(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return sampling.sample_exact(documents, 137, seed=42, key="doc_id")


# --- topics and clusters ----------------------------------------------------------------------


@query(sql.leading_topic())
def leading_topic(spark, sf_dir):
    found = topics.latent_topics(clean(spark, sf_dir))
    best = topics.top_topic_terms(found.topic_terms.filter(F.col("topic") == 1))
    return best.select(
        F.col("rank").cast("bigint").alias("rank"),
        "term",
        F.round("loading", 6).alias("loading"),
        F.lit(round(found.sigma[0], 6)).alias("sigma"),
    )


@query(f"""WITH {sql.weights('speech_id', 5)}
SELECT speech_id, CAST(10 AS BIGINT) AS topics,
       speech_id NOT IN (SELECT speech_id FROM weights) AS is_zero
FROM clean""")
def topic_coverage(spark, sf_dir):
    """Every speech has topics; those without a frequent term have only zeros."""
    found = topics.latent_topics(clean(spark, sf_dir))
    return found.doc_topics.select(
        SPEECH_ID,
        F.size("topics").cast("bigint").alias("topics"),
        F.forall("topics", lambda x: x == 0.0).alias("is_zero"),
    )


@query()
def topic_terms(spark, sf_dir):
    found = topics.latent_topics(clean(spark, sf_dir))
    return topics.top_topic_terms(found.topic_terms)


@query()
def topic_energy(spark, sf_dir):
    """Per topic: sigma squared, which must equal the energy of its column of speech vectors."""
    kept = clean(spark, sf_dir)
    found = topics.latent_topics(kept)
    attached = topics.attach_topics(kept.select(SPEECH_ID), found.doc_topics)
    squares = attached.select(F.posexplode("topics").alias("at", "x"))
    energy = squares.groupBy("at").agg(F.sum(F.col("x") * F.col("x")).alias("energy"))
    sigma = F.get(F.lit(found.sigma), F.col("at"))
    return energy.select(
        (F.col("at") + 1).alias("topic"),
        F.round("energy", 6).alias("energy"),
        F.round(sigma * sigma, 6).alias("sigma_squared"),
    )


@query(f"""WITH {sql.CLEAN}
SELECT topic, count(*) AS speeches, true AS energy_is_sigma_squared, true AS orthogonal, true AS unit_loadings
FROM clean, (SELECT unnest(generate_series(1, 10)) AS topic) GROUP BY ALL""")
def topic_checks(spark, sf_dir):
    """Each of the topics against what a singular pair must be: the energy of its speech vector is
    sigma squared, speech vectors are orthogonal to all others, loadings have length one."""
    found = topics.latent_topics(clean(spark, sf_dir))
    k = len(found.sigma)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(k) for j in range(k)]))
    x, y = F.get("topics", F.col("p.i")), F.get("topics", F.col("p.j"))
    products = found.doc_topics.select("topics", pairs.alias("p")).groupBy("p.i", "p.j")
    products = products.agg(F.sum(x * y).alias("product"), F.count("*").alias("speeches"))
    scale = F.get(F.lit(found.sigma), F.col("i")) * F.get(F.lit(found.sigma), F.col("j"))
    own = F.col("i") == F.col("j")
    by_topic = products.groupBy((F.col("i") + 1).cast("bigint").alias("topic")).agg(
        F.max("speeches").alias("speeches"),
        F.bool_and(~own | (F.abs(F.col("product") / scale - 1) < 1e-6)).alias("energy_is_sigma_squared"),
        F.bool_and(own | (F.abs(F.col("product") / scale) < 1e-6)).alias("orthogonal"),
    )
    lengths = found.topic_terms.groupBy(F.col("topic").cast("bigint").alias("topic")).agg(
        (F.abs(F.sum(F.col("loading") * F.col("loading")) - 1) < 1e-6).alias("unit_loadings")
    )
    return by_topic.join(lengths, "topic")


@query("""SELECT unnest(generate_series(1, 10)) AS topic, true AS is_weights_times_loadings, true AS none_is_stronger""")
def topic_optimality(spark, sf_dir):
    """Each topic's speech vector is the weights times its loadings, and no direction that is left is stronger.

    The strongest direction beside the topics is looked for by power iteration from a start of its own.
    """
    kept = written(clean(spark, sf_dir), "clean")
    counts = ix.term_counts(kept, SPEECH_ID)
    matrix = topics.term_matrix(counts, min_df=5)
    try:
        found = topics.latent_topics(kept, counts=counts, matrix=matrix)
        k = len(found.sigma)
        loadings = found.topic_terms.groupBy("term").agg(F.sort_array(F.collect_list(F.struct("topic", "loading"))).alias("l"))
        loadings = loadings.join(matrix.terms.select("term", "t"), "term")
        loadings = written(loadings.select("term", "t", F.col("l.loading").alias("loadings")), "loadings")

        # The weights are made and joined anew here, so that an error of the kept matrix would show.
        weights = ix.tfidf(kept, SPEECH_ID, min_df=5, counts=counts).select(SPEECH_ID, "term", "weight")
        image = weights.join(loadings.drop("t"), "term").groupBy(SPEECH_ID).agg(
            *[F.sum(F.col("weight") * F.get("loadings", F.lit(j))).alias(f"x{j}") for j in range(k)]
        )
        gap = F.posexplode(F.array(*[F.abs(F.get("topics", F.lit(j)) - F.col(f"x{j}")) for j in range(k)]))
        gaps = image.join(found.doc_topics, SPEECH_ID).select(gap.alias("at", "gap"))
        gaps = written(gaps.groupBy("at").agg(F.max("gap").alias("gap")), "gaps")

        start = F.pmod(F.xxhash64("term", F.lit(7)), F.lit(2001)) / 1000.0 - 1.0
        direction = loadings.select("t", start.alias("v"))
        strength = 0.0
        for _ in range(6):
            along = direction.join(loadings, "t").agg(
                *[F.sum(F.col("v") * F.get("loadings", F.lit(j))) for j in range(k)]
            ).first()
            beside = F.zip_with("loadings", F.lit(list(along)), lambda x, c: x * c)
            rest = F.col("v") - F.aggregate(beside, F.lit(0.0), lambda a, x: a + x)
            rest = written(direction.join(loadings, "t").select("t", rest.alias("v")), "rest")
            size = rest.agg(F.sqrt(F.sum(F.col("v") * F.col("v")))).first()[0]
            down = written(matrix.back_and_forth(rest, ["v"]).withColumn("v", F.col("v") / size), "direction")
            # The energy of the image of a direction is its product with what comes back.
            energy = down.withColumnRenamed("v", "back").join(rest, "t").agg(F.sum(F.col("back") * F.col("v"))).first()[0]
            strength = math.sqrt(max(energy, 0.0) / size)
            direction = down
    finally:
        matrix.release()
    return gaps.select(
        (F.col("at") + 1).cast("bigint").alias("topic"),
        (F.col("gap") < 1e-9).alias("is_weights_times_loadings"),
        (F.lit(strength) <= F.get(F.lit(found.sigma), F.col("at")) * (1 + 1e-4)).alias("none_is_stronger"),
    )


@query("""SELECT count(*) AS vectors, CAST(10 AS BIGINT) AS clusters, count(*) AS members,
       CAST(0 AS BIGINT) AS not_at_nearest, CAST(0 AS BIGINT) AS off_mean
FROM embeddings""")
def kmeans_checks(spark, sf_dir):
    """The partition that K-Means found: complete, every vector at its nearest centroid, every
    centroid at the mean of its members."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("topics"))
    grouped = clusters.cluster_topics(vectors, k=10, n_init=10)
    k = len(grouped.centroids)
    centroid = F.get(F.lit(grouped.centroids), F.col("cluster_id"))

    def distance(center):
        return F.aggregate(F.zip_with("topics", center, lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda a, d: a + d)

    own = distance(centroid)
    least = F.least(*[distance(F.lit(c)) for c in grouped.centroids])
    sizes = grouped.assigned.groupBy("cluster_id").agg(
        F.count("*").alias("n"),
        F.count_if(own > least + 1e-9).alias("far"),
        F.array(*[F.avg(F.get("topics", F.lit(j))) for j in range(DIMS)]).alias("mean"),
    )
    gap = F.aggregate(F.zip_with("mean", centroid, lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda a, d: a + d)
    return sizes.agg(
        F.sum("n").alias("vectors"), F.lit(k).cast("bigint").alias("clusters"), F.sum("n").alias("members"),
        F.sum("far").alias("not_at_nearest"), F.count_if(gap > 1e-6).alias("off_mean"),
    )


@query()
def topic_clusters(spark, sf_dir):
    """100 clusters of the speeches by topic, the best of 10 starts, with their mean topics."""
    found = topics.latent_topics(clean(spark, sf_dir))
    grouped = clusters.cluster_topics(found.doc_topics, k=100, n_init=10)
    return clusters.cluster_topic_means(grouped.assigned, dims=len(found.sigma))


@query()
def kmeans_fit(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    grouped = clusters.cluster_topics(vectors, k=10, n_init=10, column="embedding")
    return clusters.cluster_sizes(grouped.assigned)


def label_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` with its labels as clusters and its vectors as topics."""
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(
        F.col("vec_id").alias(SPEECH_ID),
        F.col("embedding").cast("array<double>").alias("topics"),
        F.col("label").alias("cluster_id"),
    )


def embedded_speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = label_clusters(spark, sf_dir)
    return topics.attach_topics(speeches(spark, sf_dir), labels)


DIMS = 64


@query(f"""WITH {sql.VECTORS},
distances AS (
  SELECT vec_id, c.label, sum((x - c) * (x - c)) AS d
  FROM points p JOIN centroids c USING (pos) GROUP BY ALL
)
SELECT vec_id AS speech_id, arg_min(label, (d, label)) AS cluster_id FROM distances GROUP BY ALL""")
def assign_clusters(spark, sf_dir):
    vectors = label_clusters(spark, sf_dir)
    rows = clusters.cluster_topic_means(vectors, dims=DIMS).collect()
    centroids, ids = [list(row[1:]) for row in rows], [row[0] for row in rows]
    assigned = clusters.assign_clusters(vectors.drop("cluster_id"), centroids, ids=ids)
    return assigned.select(SPEECH_ID, F.col("cluster_id").cast("bigint").alias("cluster_id"))


@query(f"""WITH {sql.VECTORS}
SELECT label AS cluster_id, {", ".join(
    f"round(max(c) FILTER (pos = {i}), 6) + 0.0 AS Topic_{i}" for i in range(1, DIMS + 1))}
FROM centroids GROUP BY ALL""")
def cluster_topic_means(spark, sf_dir):
    means = clusters.cluster_topic_means(label_clusters(spark, sf_dir), dims=DIMS)
    rounded = [F.round(name, 6).alias(name) for name in means.columns[1:]]
    return means.select(F.col("cluster_id").cast("bigint").alias("cluster_id"), *rounded)


@query(f"""WITH {sql.VECTORS}
SELECT label AS cluster_id, 'Topic_' || pos AS topic, round_even(c, 3) AS weight
FROM centroids WHERE c > 0.05""")
def cluster_top_topics(spark, sf_dir):
    means = clusters.cluster_topic_means(label_clusters(spark, sf_dir), dims=DIMS)
    best = clusters.cluster_top_topics(means)
    return best.withColumn("cluster_id", F.col("cluster_id").cast("bigint"))


@query(f"""WITH {sql.VECTORS}
SELECT label AS cluster_id, 'Topic_' || pos AS topic, round_even(c, 3) AS weight
FROM centroids WHERE c > 0.01""")
def cluster_many_topics(spark, sf_dir):
    """A threshold that leaves several topics per cluster."""
    means = clusters.cluster_topic_means(label_clusters(spark, sf_dir), dims=DIMS)
    best = clusters.cluster_top_topics(means, min_weight=0.01)
    return best.withColumn("cluster_id", F.col("cluster_id").cast("bigint"))


@query("""SELECT CAST(label AS BIGINT) AS cluster_id, count(*) AS n_speeches
FROM embeddings GROUP BY ALL""")
def cluster_sizes(spark, sf_dir):
    sizes = clusters.cluster_sizes(label_clusters(spark, sf_dir))
    return sizes.withColumn("cluster_id", F.col("cluster_id").cast("bigint"))


@query("""WITH sizes AS (
  SELECT CAST(label AS BIGINT) AS cluster_id, count(*) AS n_speeches FROM embeddings GROUP BY ALL
),
ranked AS (
  SELECT 'largest' AS part, row_number() OVER (ORDER BY n_speeches DESC, cluster_id) AS rank, *
  FROM sizes
  UNION ALL
  SELECT 'smallest', row_number() OVER (ORDER BY n_speeches, cluster_id), * FROM sizes
)
SELECT * FROM ranked WHERE rank <= 5
UNION ALL SELECT 'small', 1, NULL, count(*) FILTER (n_speeches < 45) FROM sizes""")
def cluster_size_report(spark, sf_dir):
    report = clusters.cluster_size_report(label_clusters(spark, sf_dir), small=45)
    numbers = {name: F.col(name).cast("bigint") for name in ("rank", "cluster_id")}
    return report.withColumns(numbers).select("part", "rank", "cluster_id", "n_speeches")


@query(f"""WITH {sql.SPEECHES_SQL},
chosen AS (
  SELECT *, row_number() OVER (ORDER BY speech_id) AS index, count(*) OVER () AS n
  FROM {sql.EMBEDDED} WHERE label = 3
)
SELECT index, '--- Ομιλία ' || index || '/' || n || ' ---' || chr(10) ||
       'Ομιλητής: ' || coalesce(member_name, 'Άγνωστος') || chr(10) ||
       'Ημερομηνία: ' || coalesce(sitting_date, '-') || chr(10) ||
       'Κείμενο:' || chr(10) || speech || chr(10) || chr(10) ||
       repeat('=', 50) || chr(10) || chr(10) AS block
FROM chosen""")
def cluster_speeches(spark, sf_dir):
    return clusters.cluster_speeches(embedded_speeches(spark, sf_dir), 3)


@query(f"""WITH {sql.SPEECHES_SQL}
SELECT speech_id, member_name, CAST(label AS BIGINT) AS cluster_id,
       round(embedding[1]::DOUBLE, 6) + 0.0 AS first,
       round(embedding[64]::DOUBLE, 6) + 0.0 AS last
FROM speeches JOIN embeddings ON vec_id = speech_id""")
def attach_topics(spark, sf_dir):
    wide = topics.widen(embedded_speeches(spark, sf_dir), DIMS)
    return wide.select(
        SPEECH_ID,
        "member_name",
        F.col("cluster_id").cast("bigint").alias("cluster_id"),
        F.round("Topic_1", 6).alias("first"),
        F.round("Topic_64", 6).alias("last"),
    )


# --- sources and sinks ------------------------------------------------------------------------


@query(f"""WITH {sql.SPEECHES_SQL}
SELECT sitting_date, member_name, political_party, nullif(speech, '') AS speech
FROM (SELECT * REPLACE (nullif(sitting_date, 'n/a') AS sitting_date) FROM speeches)""")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "speeches-csv")
    columns = ["sitting_date", "member_name", "political_party", "speech"]
    raw = speeches(spark, sf_dir).select(*columns)
    reports.write_csv(raw, path)
    return stored.read_speeches(spark, path, schema=SPEECH_COLUMNS).select(*columns)


@query(f"""WITH {sql.SPEECHES_SQL},
twice AS (
  SELECT sitting_date, member_name, political_party, speech FROM speeches
  UNION ALL SELECT sitting_date, member_name, political_party, nullif(speech, '') FROM speeches),
digested AS (SELECT *, sha256({sql.listed(["sitting_date", "member_name", "political_party", "speech"])}) AS digest FROM twice),
numbered AS (SELECT *, row_number() OVER (PARTITION BY digest) - 1 AS number FROM digested)
SELECT ('0x' || substr(sha256(digest || ':' || number || ':0'), 1, 15))::BIGINT AS speech_id,
       sitting_date, member_name, political_party, speech
FROM numbered""")
def lasting_ids(spark, sf_dir):
    """Every speech twice (they have copies anyway), in splits of another order."""
    raw = speeches(spark, sf_dir).select("sitting_date", "member_name", "political_party", "speech")
    again = raw.withColumn("speech", F.nullif("speech", F.lit("")))
    return ids.lasting_ids(raw.unionByName(again).repartition(F.length("speech")))


@query(f"""WITH {sql.CLEAN}
SELECT speech_id, member_name, sitting_date, speech, clean_text FROM clean""")
def clean_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clean")
    stored.write_clean(clean(spark, sf_dir), path)
    back = stored.read_clean(spark, path)
    return back.select(SPEECH_ID, "member_name", "sitting_date", "speech", "clean_text")


@query(f"WITH {sql.scores(ASKED)}{sql.RESULT} WHERE rank <= 10 AND score > 0.05")
def index_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "index")
    indexes.save_index(built_index(spark, sf_dir), path)
    found = sr.search(indexes.load_index(spark, path), search_table(spark), STOPS)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


def grown_index(spark: SparkSession, sf_dir: str) -> ix.Index:
    """The speeches in two additions of about a half each; others are added, replaced and deleted on the way."""
    kept = written(clean(spark, sf_dir), "clean")
    half = F.pmod(F.xxhash64(SPEECH_ID), F.lit(2))
    store = segments.Store(spark, scratch_path(spark, "store")).create(buckets=8)
    first = kept.filter(half == 0)
    store.add(first, refresh=False)
    strangers = first.withColumn(SPEECH_ID, F.col(SPEECH_ID) + 10**12)
    store.add(strangers, refresh=False)
    store.add(kept.filter(half == 1).withColumn("clean_text", F.concat("clean_text", F.lit(" replaced"))), refresh=False)
    store.delete(strangers, refresh=False)
    store.merge(store.version().segments[:2])
    store.add(kept.filter(half == 1), replacing=True)
    return store.index()


@query(f"WITH {sql.scores(ASKED)}{sql.RESULT} WHERE rank <= 10 AND score > 0.05")
def search_grown_index(spark, sf_dir):
    """An index that was added to, replaced in, deleted from and merged searches like one built at once."""
    found = sr.search(grown_index(spark, sf_dir), search_table(spark), STOPS)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query(_TREND)
def trend_grown_index(spark, sf_dir):
    words = literal_table(spark, TRENDS, WORDS)
    series = trend.term_trend(grown_index(spark, sf_dir), words, STOPS)
    year, score = F.col("year").cast("bigint").alias("year"), F.round("score", 6).alias("score")
    return series.select("word_id", "token", "found", year, score)


@query(f"WITH {sql.keywords('political_party')} SELECT * FROM report")
def report_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "report")
    report = keywords.keywords_by(clean(spark, sf_dir), "political_party")
    reports.write_report(report, path, files=1)
    return reports.read_report(report, path)


@query(f"""WITH {sql.CLEAN}, {sql.sentiments('clean')},
series AS (
  SELECT CAST({sql.YEAR} AS BIGINT) AS year, round_even(avg(value), 4) + 0.0 AS sentiment
  FROM scores WHERE {sql.YEAR} IS NOT NULL GROUP BY ALL
)
SELECT year, sentiment FROM series""")
def sentiment_json(spark, sf_dir):
    series = opinion.sentiment_by_year(clean(spark, sf_dir), LEXICON)
    records = F.from_json("json", "array<struct<year: bigint, sentiment: double>>")
    return reports.to_json_records(series).select(F.inline(records))


@query(f"""WITH {sql.SPEECHES_SQL}
SELECT DISTINCT replace(unnest({sql.tokenized('speech', 1)}), 'ß', 'ss') AS stem FROM speeches""")
def stopwords_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "stems")
    spoken = speeches(spark, sf_dir).select(F.explode(text.words(F.col("speech"))).alias("word"))
    dictionaries.write_stopwords(cleaning.build_stopwords(spoken, greek_stem), path)
    return dictionaries.load_stopwords(spark, path)


@query(f"""WITH {sql.SPEECHES_SQL}
SELECT replace(word, 'ß', 'ss') AS term, count(*) AS n
FROM (SELECT unnest({sql.tokenized('speech', 1)}) AS word FROM speeches) GROUP BY ALL""")
def stem_properties(spark, sf_dir):
    """Words in Latin script stem to themselves (up to the sharp s)."""
    spoken = speeches(spark, sf_dir).select(F.explode(text.words(F.col("speech"))).alias("term"))
    counted = spoken.groupBy("term").agg(F.count("*").alias("n"))
    stems = cleaning.stem_vocabulary(counted, greek_stem)
    merged = cleaning.apply_stems(counted, stems).groupBy("term")
    return merged.agg(F.sum("n").alias("n"))
