"""Ranked search: a whole table of queries against the index at once.

The small side of every join (query terms, query weights, matches) is written first. The planner
then knows its size: it broadcasts a small one, which also prunes the buckets of a stored index,
and shuffles a large one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from corpuscope.functions.text import Stemmer, count_terms, snippet, tokens
from corpuscope.operators.cleaning import clean_queries
from corpuscope.operators.index import Index, fits_broadcast
from corpuscope.runtime import top_per_group, written
from corpuscope.schema import SPEECH_ID, require_columns
from corpuscope.sources.layout import BUCKET, with_bucket

# Up to so many different terms or speeches are named in the scan of a stored table, whose sorted
# files can then skip row groups; more of them are only met by the join.
NAMED_IN_SCAN = 200

_RECORD = ["member_name", "sitting_date", "political_party"]


def query_weights(index: Index, queries: DataFrame) -> DataFrame:
    """``(query_id, term, shards, query_weight)`` for queries with a ``clean_text``.

    Repeated words count; words outside the vocabulary are ignored, also in the norm.
    """
    counted = queries.select("query_id", F.inline(count_terms(tokens(F.col("clean_text")))))
    counted, keys = with_bucket(written(counted, "query-terms"), ["term"], index.buckets)
    raw = counted.join(index.terms, keys).select(
        "query_id", "term", "shards", (F.col("tf") * F.col("idf")).alias("raw")
    )
    # A window over one query holds no more rows than that query has words.
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("query_id")))
    weighted = raw.select("*", (F.col("raw") / length).alias("query_weight"))
    return written(weighted.drop("raw"), "query-weights")


def scan_of(table: DataFrame, wanted: DataFrame, key: str, buckets: int | None) -> DataFrame:
    """A stored table, read only where the few keys of ``wanted`` (a written table) can be."""
    return table if buckets is None else few_of(table, wanted, key)


def few_of(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Only the rows of a table with one of the keys of ``wanted``, if these are few; else all rows."""
    keys = [row[0] for row in wanted.select(key).distinct().limit(NAMED_IN_SCAN + 1).collect()]
    return table if len(keys) > NAMED_IN_SCAN else table.filter(F.col(key).isin(keys))


def postings_of(index: Index, terms: DataFrame) -> DataFrame:
    """Join rows with ``term`` and ``shards`` (a written table) to the postings of their terms.

    A frequent term is met shard by shard, so its postings never sit in one task; on a stored
    index only the buckets of the wanted terms are read. In a segmented index counts become weights here.
    """
    if index.parts:
        return _postings_of_parts(index, terms)
    if index.counts is not None and fits_broadcast(terms):
        return _postings_of_counts(index, terms)
    wanted = terms.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    wanted, keys = with_bucket(wanted.drop("shards"), ["term", "shard"], index.buckets)
    return wanted.join(scan_of(index.weights, terms, "term", index.buckets), keys)


def _postings_of_counts(index: Index, terms: DataFrame) -> DataFrame:
    """As :func:`postings_of`, from counts and norms: only the postings of the terms are weighted and shuffled."""
    known = few_of(index.terms, terms, "term").select("term", "idf")
    wanted = F.broadcast(written(terms.drop("shards").join(known, "term"), "wanted-terms"))
    met = few_of(index.counts, terms, "term").join(wanted, "term").join(index.norms, SPEECH_ID)
    return met.withColumn("weight", F.col("tf") * F.col("idf") / F.col("norm")).drop("norm")


def _postings_of_parts(index: Index, terms: DataFrame) -> DataFrame:
    """As :func:`postings_of`, from the counts of each segment, the frequencies of all and the norms."""
    wanted, keys = with_bucket(terms.drop("shards"), ["term"], index.buckets)
    known = scan_of(index.terms, terms, "term", index.buckets).drop("shards")
    wanted = written(wanted.join(known, keys).drop(BUCKET), "wanted-terms")
    found = []
    for part in index.parts:
        # How a term is cut into shards is the segment's own.
        own, keys = with_bucket(wanted, ["term"], index.buckets)
        own = own.join(scan_of(part.terms, wanted, "term", index.buckets).drop("df"), keys).drop(BUCKET)
        own = own.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
        own, keys = with_bucket(written(own, "part-terms"), ["term", "shard"], index.buckets)
        counts = scan_of(part.counts, wanted, "term", index.buckets)
        found.append(own.join(counts, keys).drop(BUCKET, "shard"))
    matched, keys = with_bucket(reduce(DataFrame.unionByName, found), [SPEECH_ID], index.buckets)
    weight = F.col("tf") * F.col("idf") / F.col("norm")
    return matched.join(index.norms, keys).withColumn("weight", weight).drop(BUCKET, "norm")


def score_queries(index: Index, weights: DataFrame) -> DataFrame:
    """``(query_id, speech_id, score)``: the cosine of each query with each matching speech."""
    product = F.col("query_weight") * F.col("weight")
    return (
        postings_of(index, weights)
        .groupBy("query_id", SPEECH_ID)
        .agg(F.sum(product).alias("score"))
    )


def best_matches(scored: DataFrame, top_k: int = 10, min_score: float = 0.05) -> DataFrame:
    """Per query the ``top_k`` best speeches above ``min_score``, with their ``rank``.

    Equal scores (to 9 places) rank by speech id. Filtering first gives the same rows as
    filtering last and leaves less to sort.
    """
    if top_k < 1:
        raise ValueError("top_k must be at least 1")
    order = [F.round("score", 9).desc(), F.col(SPEECH_ID)]
    relevant = scored.filter(F.col("score") > min_score)
    return top_per_group(relevant, "query_id", order, top_k, "rank", slice_by=SPEECH_ID)


def search_page(scored: DataFrame, page: int, size: int = 20, min_score: float = 0.05) -> DataFrame:
    """One page (from 1) of the ranking of each query."""
    if page < 1:
        raise ValueError("pages are counted from 1")
    return best_matches(scored, page * size, min_score).filter(F.col("rank") > (page - 1) * size)


def search_after(
    scored: DataFrame, cursors: DataFrame, size: int = 20, min_score: float = 0.05
) -> DataFrame:
    """The next ``size`` matches of each query behind its cursor, with their ``rank`` in the whole ranking.

    ``cursors(query_id, score, speech_id, rank)`` names the last row seen, as :func:`next_cursors` gives it; a
    query with nulls starts at the top, one without a row is not asked for. What was shown
    before is not ranked again: the rows up to the cursor are dropped before any sorting.
    """
    if size < 1:
        raise ValueError("a page has at least 1 row")
    last = cursors.select(
        "query_id", F.col("score").alias("_score"), F.col(SPEECH_ID).alias("_id"),
        F.coalesce("rank", F.lit(0)).alias("_rank"),
    )
    at = F.round("score", 9)
    behind = F.col("_id").isNull() | (at < F.col("_score")) | ((at == F.col("_score")) & (F.col(SPEECH_ID) > F.col("_id")))
    left = scored.filter(F.col("score") > min_score).join(last, "query_id").filter(behind)
    order = [at.desc(), F.col(SPEECH_ID)]
    page = top_per_group(left, "query_id", order, size, "_place", slice_by=SPEECH_ID)
    rank = (F.col("_rank") + F.col("_place")).cast("int").alias("rank")
    return page.select(*scored.columns, rank)


def next_cursors(page: DataFrame) -> DataFrame:
    """The cursor behind each query's last row; a query whose page is empty has none and is done."""
    end = F.max_by(F.struct(F.round("score", 9).alias("score"), SPEECH_ID, "rank"), "rank")
    return page.groupBy("query_id").agg(end.alias("end")).select("query_id", "end.*")


def records(index: Index, matches: DataFrame) -> DataFrame:
    """Turn matches into result records; null fields become empty text."""
    require_columns(index.speeches, [SPEECH_ID, "speech", *_RECORD])
    stored = written(matches, "matches")
    speeches = scan_of(index.speeches, stored, SPEECH_ID, index.buckets)
    matches, keys = with_bucket(stored, [SPEECH_ID], index.buckets)
    found = matches.join(speeches, keys).na.fill("", ["speech", *_RECORD])
    return found.select(
        "query_id",
        "rank",
        SPEECH_ID,
        *_RECORD,
        snippet(F.col("speech")).alias("speech_snippet"),
        F.col("speech").alias("full_speech"),
        F.bround("score", 4).alias("score"),
    )


def search(
    index: Index,
    queries: DataFrame,
    stops: Sequence[str] = (),
    stemmer: Stemmer | None = None,
    top_k: int = 10,
    min_score: float = 0.05,
) -> DataFrame:
    """The best speeches for each row of ``queries(query_id, query)``.

    A query that cleans to nothing, or has no known word, gives no rows.
    """
    weights = query_weights(index, clean_queries(queries, "query", stops, stemmer))
    return records(index, best_matches(score_queries(index, weights), top_k, min_score))
