"""Term counts and TF-IDF weights as plain tables.

A weight table has one row per (entity, term). An entity is a speech, or a group of speeches by
any key: the bag of words of a group is the sum of the bags of its speeches, so texts are never
concatenated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuscope.functions.dates import year_of
from corpuscope.functions.text import count_terms, tokens
from corpuscope.runtime import written
from corpuscope.schema import SPEECH_ID, require_columns

# A vocabulary of at most this many bytes is joined by broadcast as a whole. Of a larger one only
# the most frequent terms are, all others by shuffle. Both sides of that split are bounded: the
# broadcast has at most HOT_TERMS rows of short strings, and a term outside it holds at most
# 1.05 / HOT_TERMS of all postings (see `hottest`), so no shuffle key is hot.
BROADCAST_BYTES = 64 << 20
HOT_TERMS = 100_000
HOT_TERM_CHARS = 64
# Id, norm and year of a speech.
NORM_BYTES = 20

# Postings of one term are cut into shards of about this many entities.
SHARD_ROWS = 100_000


@dataclass(frozen=True)
class Part:
    """One segment of a growing index: ``terms(term, df, shards)`` of its own and its
    ``counts(speech_id, term, shard, tf, year)``."""

    terms: DataFrame
    counts: DataFrame


@dataclass(frozen=True)
class Index:
    """A searchable corpus: ``speeches`` (one row per kept speech), ``terms``, ``weights`` (with the
    ``year`` of the speech, null without a valid date) and the distinct ``years``.

    ``yearly`` has the sum of a term's weights in each year it is used, as trends show it.
    ``buckets`` is set for a stored index, see :mod:`corpuscope.sources.layout`. An index in segments has
    ``parts`` and ``norms(speech_id, norm)`` in place of weights, see :mod:`corpuscope.sources.segments`. An index that
    is not stored has ``counts(speech_id, term, tf)`` and ``norms(speech_id, norm, year)`` beside its weights, so that a search
    or a trend makes the weights of its own postings only.
    """

    speeches: DataFrame
    terms: DataFrame
    weights: DataFrame | None
    years: DataFrame
    buckets: int | None = None
    yearly: DataFrame | None = None
    parts: tuple[Part, ...] = ()
    norms: DataFrame | None = None
    counts: DataFrame | None = None


def term_counts(clean: DataFrame, key: str, carried: Sequence[str] = ()) -> DataFrame:
    """``(key, term, tf)`` for each entity; an entity without terms has one row of ``''`` and 0.

    Rows with a null key are dropped. For speeches the counting happens inside the row, without
    a shuffle; for groups only partial sums are shuffled. The result is used several times (for
    frequencies, weights and norms), so it is written once and texts are tokenized once.
    ``carried`` names further columns of a speech to keep beside its counts.
    """
    require_columns(clean, [key, "clean_text"])
    if key == SPEECH_ID:
        counts = unnested(counted_speeches(clean, carried), key, *carried)
    else:
        counts = (
            clean.filter(F.col(key).isNotNull())
            .select(key, F.explode_outer(tokens(F.col("clean_text"))).alias("term"))
            .groupBy(key, F.coalesce("term", F.lit("")).alias("term"))
            .agg(F.count("term").alias("tf"))
        )
    return written(counts, "term-counts")


def counted_speeches(clean: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """``(speech_id, *carried, postings)``: one row a speech, its terms and their counts in an array."""
    require_columns(clean, [SPEECH_ID, "clean_text"])
    postings = count_terms(tokens(F.col("clean_text"))).alias("postings")
    return clean.filter(F.col(SPEECH_ID).isNotNull()).select(SPEECH_ID, *carried, postings)


def unnested(counted: DataFrame, *columns: str) -> DataFrame:
    """``(*columns, term, tf)``: a row for each posting; a speech without any has one of ``''`` and 0."""
    posting = F.col("posting")
    return counted.select(*columns, F.explode_outer("postings").alias("posting")).select(
        *columns,
        F.coalesce(posting["term"], F.lit("")).alias("term"),
        F.coalesce(posting["tf"], F.lit(0)).alias("tf"),
    )


def grouped_counts(clean: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """:func:`term_counts` for each of several keys, from one reading and tokenizing of the texts.

    The counts of a speech carry its keys, so a group's counts are a roll-up of theirs: each count is
    added to all its groups in one aggregation, whose shuffle moves partial sums only.
    """
    groups = [key for key in keys if key != SPEECH_ID]
    require_columns(clean, [SPEECH_ID, *groups])
    counts = term_counts(clean, SPEECH_ID, groups)
    found = {SPEECH_ID: counts.select(SPEECH_ID, "term", "tf")}
    if groups:
        sums = written(group_sums(counts, groups), "grouped-counts", by="grouping")
        for key in groups:
            entity = F.col("entity").cast(clean.schema[key].dataType).alias(key)
            found[key] = sums.filter(F.col("grouping") == key).select(entity, "term", "tf")
    return {key: found[key] for key in keys}


def by_group(counts: DataFrame, groups: Sequence[str], *columns: str) -> DataFrame:
    """``(grouping, entity, *columns)``: each row once for each of its groups; null keys have none."""
    entities = F.array(*[
        F.struct(F.lit(key).alias("grouping"), F.col(key).cast("string").alias("entity"))
        for key in groups
    ])
    return counts.select(F.inline(entities), *columns).filter("entity IS NOT NULL")


def group_sums(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``(grouping, entity, term, tf)``: the counts of speeches, which carry their keys, added up by group."""
    rows = by_group(counts, groups, "term", "tf")
    return rows.groupBy("grouping", "entity", "term").agg(F.sum("tf").alias("tf"))


def entity_count(counts: DataFrame, key: str) -> Column:
    """The number of entities, those without terms included, as a scalar subquery."""
    return counts.agg(F.count_distinct(F.col(key)).alias("n")).scalar()


def idf(n: Column) -> Column:
    """``ln((1 + n) / (1 + df)) + 1`` for ``n`` entities."""
    return F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0


def term_stats(counts: DataFrame, key: str, min_df: int = 1) -> DataFrame:
    """``(term, df, idf, shards)``: document frequency and :func:`idf`."""
    n = entity_count(counts, key)
    frequent = counts.filter(F.col("tf") > 0).groupBy("term").agg(F.count("*").alias("df"))
    stats = frequent.filter(F.col("df") >= min_df).select(
        "term",
        "df",
        idf(n).alias("idf"),
        F.ceil(F.col("df") / SHARD_ROWS).cast("int").alias("shards"),
    )
    return written(stats, "terms")


def fits_broadcast(terms: DataFrame, row_bytes: int = 64) -> bool:
    """Whether a (written) table of terms, with ``row_bytes`` beside each term, may be broadcast."""
    size = terms.agg(
        (F.count("*") * row_bytes + F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).alias("n")
    )
    return size.first()["n"] <= BROADCAST_BYTES


def small_side(table: DataFrame, row_bytes: int) -> DataFrame:
    """A (written) table of rows of so many bytes, broadcast in a join if it may be."""
    return F.broadcast(table) if fits_rows(table, row_bytes) else table


def fits_rows(table: DataFrame, row_bytes: int) -> bool:
    """Whether a (written) table of rows of so many bytes may be broadcast."""
    return table.count() * row_bytes <= BROADCAST_BYTES


def hottest(terms: DataFrame, most: int | None = None, by: str = "df") -> DataFrame:
    """At most ``most`` (HOT_TERMS) terms, the most frequent of those short enough to broadcast.

    A histogram with steps of a sixteenth of a power of two finds the least frequency: all terms of a step are in or
    out, and no task has to gather and sort the candidates of all others.
    """
    left = HOT_TERMS if most is None else most
    short = terms.filter(F.length("term") <= HOT_TERM_CHARS)
    step = F.floor(F.log2(by) * 16)
    least = None
    for row in short.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        left -= row["count"]
        if left < 0:
            break
        least = row["step"]
    return short.filter(step >= least if least is not None else F.lit(False))


def join_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Inner join on ``term``, without a hot key; ``terms`` is a written table with ``df``."""
    if fits_broadcast(terms):
        return postings.join(F.broadcast(terms), "term")
    hot = hottest(terms)
    names = F.broadcast(hot.select("term"))
    rare_postings = postings.join(names, "term", "left_anti")
    rare_terms = terms.join(names, "term", "left_anti")
    frequent = postings.join(F.broadcast(hot), "term")
    return frequent.unionByName(rare_postings.join(rare_terms, "term"))


def raw_weights(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """``(key, term, tf, df, idf, shards, raw)`` with ``raw = tf * idf``.

    The ranking inside one entity needs no norm, so keyword reports stop here.
    """
    found = join_terms(counts.filter(F.col("tf") > 0), terms)
    return found.withColumn("raw", F.col("tf") * F.col("idf"))


def unit_weights(counts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """``(key, term, shard, tf, df, idf, weight)``: weights of unit length per entity.

    ``shard`` numbers the slices of a long posting list (see SHARD_ROWS).
    """
    raw = raw_weights(counts, terms)
    squares = F.sum(F.col("raw") * F.col("raw"))
    norms = raw.groupBy(key).agg(F.sqrt(squares).alias("norm"))
    if key == SPEECH_ID:
        # Nearly one row of partial sums a speech is shuffled for the norms, which then meet the postings by broadcast.
        norms = small_side(written(norms, "norms"), NORM_BYTES)
    normed = raw.join(norms, key)
    shard = F.pmod(F.xxhash64(F.col(key)), F.col("shards")).cast("int")
    weight = F.col("raw") / F.col("norm")
    return normed.select(
        key, "term", shard.alias("shard"), "tf", "df", "idf", weight.alias("weight")
    )


def tfidf(
    clean: DataFrame, key: str, min_df: int = 1, counts: DataFrame | None = None
) -> DataFrame:
    """TF-IDF weights of every entity, see :func:`unit_weights`.

    Terms in fewer than ``min_df`` entities are left out before the norm is taken. ``counts``
    saves counting again what :func:`term_counts` gave for the same key.
    """
    counts = counts if counts is not None else term_counts(clean, key)
    return unit_weights(counts, term_stats(counts, key, min_df), key)


def build_index(clean: DataFrame, counts: DataFrame | None = None) -> Index:
    """The index that searches and trends run on, with a speech as the entity.

    Speeches without a ``sitting_date`` column have no years.
    """
    counts = counts if counts is not None else term_counts(clean, SPEECH_ID)
    terms = term_stats(counts, SPEECH_ID)
    dated = "sitting_date" in clean.columns
    year = year_of(F.col("sitting_date")) if dated else F.lit(None)
    spoken = clean.select(SPEECH_ID, year.cast("int").alias("year"))
    years = spoken.select("year").filter("year > 0").distinct()
    used = counts.filter("tf > 0")
    # A repeated speech id has its postings once more for each of its rows.
    norms = written(speech_norms(used, terms).join(spoken, SPEECH_ID, "left"), "norms")
    shard = F.pmod(F.xxhash64(SPEECH_ID), F.col("shards")).cast("int")
    weights = raw_weights(used, terms).join(small_side(norms, NORM_BYTES), SPEECH_ID)
    weights = weights.withColumns({"shard": shard, "weight": F.col("raw") / F.col("norm")})
    weights = weights.select(SPEECH_ID, "term", "shard", "tf", "weight", "year")
    return Index(clean, terms, weights, years, yearly=yearly_sums(weights), norms=norms, counts=used)


def speech_norms(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """``(speech_id, norm)``: the length of each speech's raw vector.

    The counts of a speech lie side by side, so nearly one row of partial sums a speech is shuffled.
    """
    raw = raw_weights(counts, terms)
    return raw.groupBy(SPEECH_ID).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))


def yearly_sums(weights: DataFrame) -> DataFrame:
    """``(term, year, score)``: the sum of a term's weights in the speeches of each year."""
    used = weights.filter("year > 0").groupBy("term", "year")
    return used.agg(F.sum("weight").alias("score"))
