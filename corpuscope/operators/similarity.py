"""Pairs of entities with similar vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpuscope.operators.index import small_side, term_counts, tfidf
from corpuscope.runtime import discard, top_per_group, written

# Postings of one term are compared block by block of about this many entities.
BLOCK_ROWS = 512

# With at most this many entities raising the threshold first costs more than it saves.
FEW_ENTITIES = 1_000

# Terms in at most this many entities propose the pairs that raise the threshold.
SEED_DF = 32

# The name of an entity.
ENTITY_BYTES = 64

# Covers the rounding of the ranking and of sums of floats in any bound below.
_SLACK = 1e-8


def _term_pairs(postings: DataFrame, entities: int) -> DataFrame:
    """Sum of weight products by pair ``a < b`` over ``postings(entity, term, df, weight, ...)``.

    The postings of a frequent term are cut into blocks, and each pair of blocks is its own join
    key, so no task compares more than two blocks of one term. ``rest`` and ``cut`` ride along.
    """
    if entities <= BLOCK_ROWS:
        a, b = postings.alias("a"), postings.alias("b")
        same = (F.col("a.term") == F.col("b.term")) & (F.col("a.entity") < F.col("b.entity"))
        return _sums(a.join(b, same))
    blocks = F.ceil(F.col("df") / BLOCK_ROWS)
    block = F.pmod(F.xxhash64("entity"), blocks)
    cells = postings.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    )
    cells = cells.select(
        "entity",
        "term",
        "weight",
        "rest",
        "cut",
        "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )
    a, b = cells.alias("a"), cells.alias("b")
    # Two entities of one block share many cells; only the cell of that block itself counts.
    once = (F.col("a.low") == F.col("a.high")) | (F.col("a.block") != F.col("b.block"))
    joined = a.join(
        b,
        (F.col("a.term") == F.col("b.term"))
        & (F.col("a.low") == F.col("b.low"))
        & (F.col("a.high") == F.col("b.high"))
        & (F.col("a.entity") < F.col("b.entity"))
        & once,
    )
    return _sums(joined)


def _sums(joined: DataFrame) -> DataFrame:
    return joined.groupBy(F.col("a.entity").alias("a"), F.col("b.entity").alias("b")).agg(
        F.sum(F.col("a.weight") * F.col("b.weight")).alias("partial"),
        # Of the entity whose tail starts lower, see _pairs_above.
        F.max(F.when(F.col("a.cut") <= F.col("b.cut"), F.col("a.rest")).otherwise(F.col("b.rest"))).alias("rest"),
        F.max(F.least("a.cut", "b.cut")).alias("cut"),
    )


def _light_tails(weights: DataFrame, min_sim: float) -> DataFrame:
    """``(entity, cut, rest)``: from band ``cut`` up, the terms weigh ``rest <= min_sim`` together.

    Bands group terms by the power of two of their frequency. The most frequent bands that
    together have a norm of at most ``min_sim`` cannot make a similar pair on their own.
    """
    mass = weights.groupBy("entity", "band").agg(F.sum(F.col("weight") ** 2).alias("mass"))
    # An entity has at most 64 bands, so the window is small.
    downwards = Window.partitionBy("entity").orderBy(F.desc("band"))
    tail = mass.withColumn("tail", F.sum("mass").over(downwards))
    light = F.col("tail") <= min_sim * min_sim
    return tail.groupBy("entity").agg(
        F.coalesce(F.min(F.when(light, F.col("band"))), F.lit(64)).alias("cut"),
        F.sqrt(F.coalesce(F.max(F.when(light, F.col("tail"))), F.lit(0.0))).alias("rest"),
    )


def _complete(candidates: DataFrame, weights: DataFrame) -> DataFrame:
    """Add the products of the shared terms from band ``cut`` up to the ``partial`` sums.

    Few candidates need the weights of few entities, so only these are shuffled.
    """
    candidates = written(candidates, "candidates")
    named = candidates.filter(F.col("rest") > 0).select(F.explode(F.array("a", "b")).alias("entity")).distinct()
    weights = weights.join(small_side(written(named, "candidate-entities"), ENTITY_BYTES), "entity", "left_semi")
    left = weights.select(
        F.col("entity").alias("a"), "term", "band", F.col("weight").alias("weight_a")
    )
    right = weights.select(F.col("entity").alias("b"), "term", F.col("weight").alias("weight_b"))
    extra = (
        candidates.filter(F.col("rest") > 0)
        .join(left, "a")
        .filter(F.col("band") >= F.col("cut"))
        .join(right, ["b", "term"])
        .groupBy("a", "b")
        .agg(F.sum(F.col("weight_a") * F.col("weight_b")).alias("extra"))
    )
    similarity = F.col("partial") + F.coalesce("extra", F.lit(0.0))
    return candidates.join(extra, ["a", "b"], "left").select(
        "a", "b", similarity.alias("similarity")
    )


def _banded(weights: DataFrame, key: str) -> DataFrame:
    band = F.floor(F.log2("df")).cast("int")
    # Equal counts tell equal vectors; weights may differ in the last place.
    mark = F.col("tf" if "tf" in weights.columns else "weight")
    entity = F.col(key).alias("entity")
    return weights.select(entity, "term", "df", "weight", band.alias("band"), F.xxhash64("term", mark).alias("mark"))


def _first_of_copies(weights: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The entities that can be in the ``limit`` best pairs, and how many of them have a smaller copy.

    Entities with equal vectors are equally similar to any other. A pair with the n-th of them by name comes after
    those with the n - 1 before it, so the first ``limit + 1`` are enough.
    """
    again = F.xxhash64("mark", F.lit(1)).cast("decimal(38,0)")
    prints = weights.groupBy("entity").agg(
        F.struct(F.count(F.lit(1)), F.sum(F.col("mark").cast("decimal(38,0)")), F.sum(again)).alias("print")
    )
    first = top_per_group(prints, "print", [F.col("entity")], limit + 1, "place", slice_by="entity")
    first = written(first.select("entity", "place"), "first-of-copies")
    return first.select("entity"), first.filter("place > 1").count()


def _pairs_above(weights: DataFrame, min_sim: float, entities: int) -> DataFrame:
    """All pairs ``(a, b, similarity)`` with ``a < b`` above ``min_sim`` (exact).

    Order the terms by band. Let S be the light tail of the entity whose tail starts lower. A
    shared term outside S lies below both tails, so it is in the partial sum of the pair; the
    terms of S add at most the norm of S times what the other entity has left: its norm outside S is the partial sum, over the
    norm that the first has there, at least. Pairs that cannot pass even so are dropped, and the exact rest is added to the others.
    """
    tails = _light_tails(weights, min_sim)
    below = weights.join(tails, "entity").filter(F.col("band") < F.col("cut"))
    below = written(below.select("entity", "term", "weight", "rest", "cut"), "below-tails")
    # Blocks follow from the entities that are left to a term, not from all that have it.
    held = below.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    partial = _term_pairs(below.join(held, "term"), entities)
    outside = F.greatest(1.0 - F.col("rest") * F.col("rest"), F.lit(1e-300))
    left = F.sqrt(F.greatest(1.0 - F.col("partial") * F.col("partial") / outside, F.lit(0.0)))
    candidates = partial.filter(F.col("partial") + F.col("rest") * left > min_sim - _SLACK)
    return _complete(candidates, weights).filter(F.col("similarity") > min_sim)


def _seed_threshold(weights: DataFrame, min_sim: float, limit: int) -> float:
    """A similarity that at least ``limit`` pairs reach, found among pairs that share rare terms.

    Any such value is a valid lower bound for the pairs in the answer, so it only saves work.
    """
    rare = weights.filter((F.col("df") > 1) & (F.col("df") <= SEED_DF))
    # Each entity of a rare term meets the next one only, so there are no more pairs than postings.
    following = Window.partitionBy("term").orderBy("entity")
    met = rare.select(
        F.col("entity").alias("a"),
        F.lead("entity").over(following).alias("b"),
        (F.col("weight") * F.lead("weight").over(following)).alias("product"),
    )
    seeds = met.filter("b IS NOT NULL").groupBy("a", "b").agg(F.sum("product").alias("partial"))
    # Without tails the whole vector has to be completed from band 0 up.
    seeds = seeds.withColumn("rest", F.lit(1.0)).withColumn("cut", F.lit(0))
    seeds = seeds.orderBy(F.desc("partial"), "a", "b").limit(4 * limit)
    exact = _complete(seeds.withColumn("partial", F.lit(0.0)), weights)
    best = exact.orderBy(F.desc("similarity")).limit(limit)
    reached = best.agg(F.count("*").alias("n"), F.min("similarity").alias("lowest")).first()
    if reached["n"] < limit:
        return min_sim
    return max(min_sim, reached["lowest"] - _SLACK)


def pair_similarities(
    weights: DataFrame, key: str, min_sim: float = 0.1, limit: int | None = None
) -> DataFrame:
    """``(a, b, similarity)``: the cosine of unit vectors, for pairs above ``min_sim``.

    With a ``limit`` the best pairs come in order: similarity (to 9 places) descending, then
    names. All of it is exact.
    """
    banded = written(_banded(weights, key), "pair-weights")
    entities = banded.select("entity").distinct().count()
    if limit is None:
        return _pairs_above(banded, min_sim, entities)
    threshold = min_sim
    if entities > FEW_ENTITIES:
        first, copies = _first_of_copies(banded, limit)
        banded = banded.join(first, "entity", "left_semi")
        # So many pairs of equal vectors have a similarity of 1.
        threshold = max(min_sim, 1.0 - _SLACK) if copies >= limit else _seed_threshold(banded, min_sim, limit)
    pairs = _pairs_above(banded, threshold, entities)
    return pairs.orderBy(F.round("similarity", 9).desc(), "a", "b").limit(limit)


def similar_pairs(
    clean: DataFrame,
    key: str = "member_name",
    min_sim: float = 0.1,
    limit: int | None = 100,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The most similar entities by the cosine of their TF-IDF vectors."""
    own = counts if counts is not None else term_counts(clean, key)
    pairs = pair_similarities(tfidf(clean, key, counts=own), key, min_sim, limit)
    if counts is None:
        # The pairs are made from the weights, which are written.
        discard(own)
    return pairs
