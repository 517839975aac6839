"""Ranked search that leaves most postings unread.

The postings of a term are cut into blocks by falling weight, and a small table names the largest weight of each
block. A query so knows, before it reads a posting, the most that each block can add to a score. Once
it has k speeches with a known score, blocks whose postings cannot lift a speech among these are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from corpuscope.operators.index import Index, small_side
from corpuscope.operators.search import scan_of
from corpuscope.runtime import top_per_group, written
from corpuscope.schema import SPEECH_ID
from corpuscope.sources.layout import with_bucket

#: Postings of one block.
BLOCK_ROWS = 1024
#: For the first bound each query scores so many times k speeches.
TRIED = 4
#: Query, term and weight.
ASKED_BYTES = 100
#: Sums of the same weights in another order differ by less than this.
SLACK = 1e-9

_BLOCK = ["term", "shard", "block"]


@dataclass(frozen=True)
class Blocks:
    """``heads(term, shard, block, n, top)``, ``postings`` (of each block) and ``vectors`` (of each speech).

    ``postings(term, shard, block, n, top, posting)`` holds ``array<struct<speech_id, weight>>`` and
    ``vectors(speech_id, weights)`` holds ``map<term, weight>``. Without ``buckets`` the blocks are not stored yet:
    a search writes them before it reads them.
    """

    heads: DataFrame
    postings: DataFrame
    vectors: DataFrame
    buckets: int | None = None


def build_blocks(index: Index, rows: int = BLOCK_ROWS) -> Blocks:
    """The blocks of an index, made as they are stored or searched.

    A frequent term is cut within its shards, so that no task orders all of its postings.
    """
    falling = Window.partitionBy("term", "shard").orderBy(F.col("weight").desc(), SPEECH_ID)
    block = F.floor((F.row_number().over(falling) - 1) / rows).cast("int")
    placed = index.weights.select("term", "shard", SPEECH_ID, "weight").withColumn("block", block)
    postings = placed.groupBy(*_BLOCK).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("weight").alias("top"),
        F.collect_list(F.struct(SPEECH_ID, "weight")).alias("posting"),
    )
    return Blocks(heads_of(postings), postings, vectors_of(postings))


def heads_of(postings: DataFrame) -> DataFrame:
    """The ``heads`` of postings in blocks."""
    return postings.select(*_BLOCK, "n", "top")


def vectors_of(postings: DataFrame) -> DataFrame:
    """The ``vectors`` of postings in blocks."""
    rows = postings.select("term", F.inline("posting"))
    entry = F.collect_list(F.struct("term", "weight"))
    return rows.groupBy(SPEECH_ID).agg(F.map_from_entries(entry).alias("weights"))


def _kept(blocks: Blocks) -> Blocks:
    """The same blocks as written tables; the postings are made once."""
    if blocks.buckets is not None:
        return blocks
    postings = written(blocks.postings, "blocks")
    return Blocks(heads_of(postings), postings, written(vectors_of(postings), "speech-vectors"))


def _read(blocks: Blocks, chosen: DataFrame) -> DataFrame:
    """The postings of chosen blocks, ``(query_id, term, cap, speech_id, part)``; ``chosen`` is a written table."""
    wanted, keys = with_bucket(chosen, _BLOCK, blocks.buckets)
    met = wanted.join(scan_of(blocks.postings, chosen, "term", blocks.buckets), keys)
    rows = met.select("query_id", "term", "query_weight", "cap", F.explode("posting").alias("p"))
    part = F.col("query_weight") * F.col("p.weight")
    return rows.select("query_id", "term", "cap", F.col(f"p.{SPEECH_ID}"), part.alias("part"))


def _exact(blocks: Blocks, weights: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(query_id, speech_id, score)`` of candidates by the vectors of their speeches.

    A speech is read once for all queries that it is a candidate of, and each of its terms meets the queries
    that ask for it; the sums of a speech lie side by side.
    """
    candidates = written(candidates, "candidates")
    wanted, keys = with_bucket(candidates.select(SPEECH_ID).distinct(), [SPEECH_ID], blocks.buckets)
    found = wanted.join(scan_of(blocks.vectors, candidates, SPEECH_ID, blocks.buckets), keys)
    entries = found.select(SPEECH_ID, F.explode("weights").alias("term", "weight"))
    asked = weights.select("query_id", "term", "query_weight")
    sums = entries.join(small_side(asked, ASKED_BYTES), "term").groupBy("query_id", SPEECH_ID)
    scored = sums.agg(F.sum(F.col("query_weight") * F.col("weight")).alias("score"))
    return candidates.join(scored, ["query_id", SPEECH_ID])


def _levels(most: DataFrame) -> DataFrame:
    """Add ``cap`` to ``(query_id, term, most, bar)``: what a posting of the term may add and be left unread.

    Caps are min(most, level) with the one level of a query at which they sum up to its bar, so a speech met in no block that was read
    stays below the bar. A query whose terms together stay below it reads nothing.
    """
    rising = Window.partitionBy("query_id").orderBy("most", "term")
    all_terms = Window.partitionBy("query_id")
    before = F.coalesce(F.sum("most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.count(F.lit(1)).over(all_terms) - F.row_number().over(rising) + 1
    level = (F.col("bar") - before) / left
    rows = most.withColumn("_level", level)
    first = F.min(F.when(F.col("_level") <= F.col("most"), F.struct("most", "term", "_level"))).over(all_terms)
    reach = F.coalesce(first["_level"], F.lit(float("inf")))
    return rows.withColumn("cap", F.least("most", reach)).withColumn("level", reach).drop("_level")


def search_blocks(
    blocks: Blocks, weights: DataFrame, top_k: int = 10, min_score: float = 0.05
) -> tuple[DataFrame, DataFrame]:
    """The ``top_k`` matches above ``min_score`` of each query, as :func:`best_matches` of all scores gives them.

    ``weights`` come from :func:`query_weights`. Returns the matches and, for each query and term, how many of its
    postings were read: ``(query_id, term, read, postings)``.

    1. The heaviest block of each term is read, and the best speeches found get their exact scores from
       their vectors: the k-th of these, or ``min_score``, is the query's bar.
    2. Blocks are read that can add more than the level of :func:`_levels` to a score.
    3. Speeches that cannot reach the bar with all they may have in unread blocks are dropped, and the
       others get their exact scores. Equal scores at the bar are all kept.
    """
    if top_k < 1:
        raise ValueError("top_k must be at least 1")
    blocks = _kept(blocks)
    asked, keys = with_bucket(weights, ["term"], blocks.buckets)
    named = scan_of(blocks.heads, weights, "term", blocks.buckets)
    bound = (F.col("query_weight") * F.col("top")).alias("bound")
    heads = asked.join(named, keys).select("query_id", "query_weight", *_BLOCK, "n", bound)
    heads = written(heads, "query-blocks")

    best = F.max_by(F.struct(*_BLOCK[1:], "query_weight", F.col("bound").alias("cap")), "bound")
    first = heads.groupBy("query_id", "term").agg(best.alias("b")).select("query_id", "term", "b.*")
    tried = _read(blocks, written(first, "first-blocks")).groupBy("query_id", SPEECH_ID).agg(F.sum("part").alias("score"))
    tried = top_per_group(tried, "query_id", [F.col("score").desc(), F.col(SPEECH_ID)], TRIED * top_k, "_at", SPEECH_ID)
    known = _exact(blocks, weights, tried.select("query_id", SPEECH_ID))
    kth = top_per_group(known, "query_id", [F.col("score").desc(), F.col(SPEECH_ID)], top_k, "_at", SPEECH_ID)
    reached = kth.filter(F.col("_at") == top_k).select("query_id", F.col("score").alias("reached"))

    most = heads.groupBy("query_id", "term").agg(F.max("bound").alias("most"))
    bar = F.greatest(F.lit(min_score), F.coalesce("reached", F.lit(min_score))) - SLACK
    caps = written(_levels(most.join(reached, "query_id", "left").select("query_id", "term", "most", bar.alias("bar"))), "caps")
    chosen = heads.join(caps, ["query_id", "term"]).filter(F.col("bound") >= F.col("level"))
    chosen = written(chosen.select("query_id", "query_weight", *_BLOCK, "n", "cap"), "chosen-blocks")

    unread = caps.groupBy("query_id").agg(F.sum("cap").alias("_caps"), F.first("bar").alias("bar"))
    partial = _read(blocks, chosen).groupBy("query_id", SPEECH_ID).agg(F.sum("part").alias("part"), F.sum("cap").alias("met"))
    reach = F.col("part") + F.col("_caps") - F.col("met")
    candidates = partial.join(unread, "query_id").filter(reach >= F.col("bar") - SLACK).select("query_id", SPEECH_ID)
    scored = _exact(blocks, weights, candidates)
    order = [F.round("score", 9).desc(), F.col(SPEECH_ID)]
    matches = top_per_group(scored.filter(F.col("score") > min_score), "query_id", order, top_k, "rank", SPEECH_ID)

    reads = chosen.groupBy("query_id", "term").agg(F.sum("n").alias("read"))
    totals = heads.groupBy("query_id", "term").agg(F.sum("n").alias("postings"))
    read = totals.join(reads, ["query_id", "term"], "left").na.fill(0, ["read"])
    return matches, read.select("query_id", "term", "read", "postings")
