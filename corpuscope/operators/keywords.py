"""Keyword reports: the terms that set an entity apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from corpuscope.functions.dates import year_of
from corpuscope.functions.text import contains_all
from corpuscope.operators.index import (
    by_group,
    counted_speeches,
    entity_count,
    group_sums,
    hottest,
    idf,
    join_terms,
    raw_weights,
    term_counts,
    term_stats,
)
from corpuscope.runtime import top_per_group, written
from corpuscope.schema import SPEECH_ID, require_columns

# The reports of several groupings look at so many of the most frequent terms first.
FIRST_TERMS = 10_000
# What the rounding of weights may make of a bound.
_SLACK = 1 + 1e-9


def top_terms(weights: DataFrame, key: str, n: int = 20, weight: str = "weight") -> DataFrame:
    """``(key, top_keywords)``: the ``n`` heaviest terms, ties by term, joined by ``", "``."""
    return listed_terms(ranked_terms(weights, key, n, weight), key)


def ranked_terms(weights: DataFrame, key: str, n: int, weight: str) -> DataFrame:
    """The ``n`` heaviest terms of each ``key`` with their ``rank``, ties by term."""
    order = [F.col(weight).desc_nulls_last(), F.col("term")]
    return top_per_group(weights, key, order, n, "rank", slice_by="term")


def listed_terms(ranked: DataFrame, key: str) -> DataFrame:
    """``(key, top_keywords)`` of ranked terms; null terms are not shown."""
    listed = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return (
        ranked.groupBy(key)
        .agg(listed.alias("listed"))
        .select(key, F.array_join(F.col("listed")["term"], ", ").alias("top_keywords"))
    )


def with_year(clean: DataFrame) -> DataFrame:
    """Add ``year``; speeches without a valid date have none and so belong to no year group."""
    require_columns(clean, ["sitting_date"])
    return clean.withColumn("year", year_of(F.col("sitting_date")))


def keywords_by(
    clean: DataFrame,
    key: str,
    n: int = 20,
    entity: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The keyword report by ``speech_id``, ``political_party``, ``member_name``, ``year``, ...

    Entities without any term keep a row with empty keywords. ``entity`` selects one of them;
    frequencies are those of the whole corpus all the same. ``counts`` saves counting again.
    """
    if key == "year" and key not in clean.columns:
        clean = with_year(clean)
    counts = counts if counts is not None else term_counts(clean, key)
    weighted = raw_weights(counts, term_stats(counts, key)).select(key, "term", "raw")
    rows = weighted.unionByName(_without_terms(counts.filter(F.col("tf") == 0), key))
    if entity is not None:
        rows = rows.filter(F.col(key).cast("string") == str(entity))
    return top_terms(rows, key, n, "raw")


def _without_terms(entities: DataFrame, key: str) -> DataFrame:
    """Rows that keep an entity in its report even if it has no term."""
    return entities.select(
        key, F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("raw")
    )


def keyword_reports(clean: DataFrame, keys: Sequence[str], n: int = 20) -> dict[str, DataFrame]:
    """:func:`keywords_by` for each of several keys, from one reading and tokenizing of the texts.

    Groups are looked at with the ``FIRST_TERMS`` most frequent terms only, whose sums are few. Their report is final if
    no other term can weigh as much as the last one listed of any entity, even if all its occurrences fell to that entity.
    Other groupings are summed up again over all terms that could; if an entity lists fewer than ``n``, that is every term.
    """
    groups = [key for key in keys if key != SPEECH_ID]
    require_columns(clean, [SPEECH_ID, *groups])
    # A row a speech: its keys are stored and read once, not with each of its terms.
    speeches = written(counted_speeches(clean, groups), "counted-speeches")
    counts = speeches.select(SPEECH_ID, *groups, F.inline("postings"))
    totals = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    size = entity_count(speeches, SPEECH_ID)
    terms = written(totals.select("*", idf(size).alias("idf")), "terms")
    found = {}
    if SPEECH_ID in keys:
        weighted = raw_weights(counts.select(SPEECH_ID, "term", "tf"), terms).select(SPEECH_ID, "term", "raw")
        bare = speeches.filter(F.coalesce(F.size("postings"), F.lit(0)) <= 0)
        found[SPEECH_ID] = top_terms(weighted.unionByName(_without_terms(bare, SPEECH_ID)), SPEECH_ID, n, "raw")
    if groups:
        entities = written(by_group(speeches, groups).distinct(), "entities")
        first = F.broadcast(hottest(terms, FIRST_TERMS, "total").select("term"))
        ranked = _ranked_in_groups(counts.join(first, "term", "left_semi"), groups, entities, n)
        unseen = terms.join(first, "term", "left_anti").agg(F.max("total")).first()[0] or 0
        bounds = _bounds(ranked, entities, n)
        rest = [key for key in groups if 0 < unseen and bounds.get(key, unseen + 1) <= unseen]
        if rest:
            ranked = ranked.filter(~F.col("grouping").isin(rest))
            least = min(bounds[key] for key in rest)
            needed = join_terms(counts, terms.filter(F.col("total") >= least)) if least > 1 else counts
            ranked = ranked.unionByName(_ranked_in_groups(needed, rest, entities, n))
        bare = entities.select("*", F.lit(None).alias("term"), F.lit(None).alias("rank"))
        listed = ranked.drop("raw").unionByName(bare)
        for key in groups:
            entity = F.col("entity").cast(clean.schema[key].dataType).alias(key)
            found[key] = listed_terms(listed.filter(F.col("grouping") == key).select(entity, "term", "rank"), key)
    return {key: found[key] for key in keys}


def _ranked_in_groups(counts: DataFrame, groups: Sequence[str], entities: DataFrame, n: int) -> DataFrame:
    """``(grouping, entity, term, rank, raw)``: the ``n`` heaviest terms of every entity among those of ``counts``."""
    sums = written(group_sums(counts, groups), "grouped-counts")
    sizes = entities.groupBy("grouping").agg(F.count("*").alias("n"))
    used = sums.groupBy("grouping", "term").agg(F.count("*").alias("df")).join(F.broadcast(sizes), "grouping")
    weighted = sums.join(used, ["grouping", "term"]).select(
        F.struct("grouping", "entity").alias("of"), "term", (F.col("tf") * idf(F.col("n"))).alias("raw")
    )
    ranked = ranked_terms(weighted, "of", n, "raw")
    return written(ranked.select("of.*", "term", "rank", "raw"), "ranked")


def _bounds(ranked: DataFrame, entities: DataFrame, n: int) -> dict[str, float]:
    """How often a term must occur, by grouping, to be among the ``n`` heaviest of an entity if it is not ranked yet."""
    last = ranked.filter(F.col("rank") == n).select("grouping", "entity", "raw")
    least = entities.join(last, ["grouping", "entity"], "left").groupBy("grouping").agg(
        F.min(F.coalesce("raw", F.lit(0.0))).alias("least"), F.count("*").alias("n"), F.lit(1).alias("df")
    )
    return {row[0]: row[1] for row in least.select("grouping", F.col("least") / (idf(F.col("n")) * _SLACK)).collect()}


def find_keywords(report: DataFrame, text: str, column: str = "member_name") -> DataFrame:
    """Rows of a keyword report whose name contains every word of ``text``."""
    return filter_names(report, column, text)


def filter_names(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose name contains every blank-separated word, case and accents aside."""
    require_columns(df, [column])
    return df.filter(contains_all(F.col(column), text))
