"""Ranked lexical search by a pipeline of term owners.

Documents are cut into blocks, and the postings of the searched terms lie block by block. The terms are dealt to owners
by document frequency, rarest first. A bundle is one item in one block: the documents it has met so far
with their scores. Bundles pass from owner to owner; each stage cogroups them with the owner's postings
of the same block and adds integer contributions. The best scores so far bound what a document
must still reach, so later owners, who hold the frequent terms, add few new documents. All arithmetic that
makes a score is in 64-bit integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuscope.runtime import top_per_group, written

#: Documents of one block.
BLOCK = 2048
#: Owners take terms found in at most N / 256, N / 64, ... of the N documents, the last one all others.
OWNERS, STEP = 5, 4
#: Items that share the postings of one task.
GROUP_ITEMS = 512
#: A searched vocabulary of at most so many bytes is sent to all tasks; a larger one is joined.
VOCABULARY_BYTES = 32 << 20

# ASCII characters that are no letter or digit end a term; A-Z are lower-cased, all others stay.
_PLAIN = bytes(c + 32 if chr(c).isascii() and chr(c).isupper() else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_NOT_A_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def terms_of(text: Column) -> Column:
    """The terms of a text in order, repeats included; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.filter(F.split(plain, _NOT_A_TERM), lambda term: term != "")


def asked_terms(items: DataFrame) -> DataFrame:
    """``(item, item_id, group, term, repeats)``; ``item`` tells apart rows that share an id. A written table."""
    numbered = written(items.select("item_id", terms_of(F.col("text")).alias("terms")), "items")
    numbered = numbered.withColumn("item", F.monotonically_increasing_id())
    rows = written(numbered.select("item", "item_id", F.explode("terms").alias("term")), "item-terms")
    groups = -(-rows.agg(F.count_distinct("item").alias("n")).first()["n"] // GROUP_ITEMS) or 1
    group = F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int").alias("group")
    return written(rows.groupBy("item", "item_id", group, "term").agg(F.count(F.lit(1)).alias("repeats")), "asked")


_BLOCKS = "block long, doc_ids array<long>, lengths binary, terms array<string>, held array<int>, places binary, counts binary"


def blocks_of(docs: DataFrame, vocabulary: set[str] | None) -> DataFrame:
    """Documents in blocks, with the postings of the terms in ``vocabulary`` (None: all). A written table.

    A block has the ids and numbers of terms of its documents; of each term how many documents hold it,
    their places in the block and the term's counts there, term after term.
    """
    wanted = None if vocabulary is None else frozenset(t.encode() for t in vocabulary)

    def one(number: int, ids: pa.Array, texts: list[bytes | None]) -> pa.RecordBatch:
        lengths, postings = [], {}
        for place, text in enumerate(texts):
            words = text.translate(_PLAIN).split(b" ") if text else []
            counted = Counter(words)
            lengths.append(len(words) - counted.pop(b"", 0))
            for term in counted if wanted is None else counted.keys() & wanted:
                postings.setdefault(term, []).append((place, counted[term]))
        order = sorted(postings)
        pairs = np.array([pair for term in order for pair in postings[term]], dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()),
            "doc_ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
            "lengths": pa.array([np.array(lengths, "<i4").tobytes()], pa.binary()),
            "terms": pa.array([[t.decode() for t in order]], pa.list_(pa.string())),
            "held": pa.array([[len(postings[t]) for t in order]], pa.list_(pa.int32())),
            "places": pa.array([pairs[:, 0].astype("<u2").tobytes()], pa.binary()),
            "counts": pa.array([pairs[:, 1].astype("<i4").tobytes()], pa.binary()),
        })

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("first")[0].as_py() if batch.num_rows else 0
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                yield one(number + start, part.column("doc_id"), part.column("text").to_pylist())

    rows = docs.select(F.monotonically_increasing_id().alias("first"), "doc_id", F.col("text").cast("binary").alias("text"))
    return written(rows.mapInArrow(cut, _BLOCKS), "blocks")


def term_weights(blocks: DataFrame, asked: DataFrame) -> tuple[DataFrame, int, int]:
    """``(term, df, weight, owner)`` of the asked terms, N and L; the table is written."""
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.frombuffer(b"".join(batch.column("lengths").to_pylist()), "<i4")
            yield pa.RecordBatch.from_pydict({"held": [int((n > 0).sum())], "all": [int(n.sum(dtype=np.int64))]})

    total = blocks.select("lengths").mapInArrow(sizes, "held long, all long").agg(F.sum("held"), F.sum("all")).first()
    n, length = (int(x or 0) for x in total)
    each = blocks.select(F.inline(F.arrays_zip("terms", "held"))).groupBy(F.col("terms").alias("term")).agg(F.sum("held").alias("df"))
    ratio = F.lit(2 * n + 2).cast("double") / (2 * F.col("df") + 1)
    weight = F.floor(F.lit(1000.0) * F.log(ratio)).cast("long")
    owner = F.lit(0)
    for k in range(1, OWNERS):
        owner = owner + (F.col("df") * STEP ** (OWNERS - k) > n).cast("int")
    known = each.join(asked.select("term").distinct(), "term").select("term", "df", weight.alias("weight"), owner.alias("owner"))
    return written(known, "term-weights"), n, length


def impacts(blocks: DataFrame, n: int, length: int) -> DataFrame:
    """``(block, term, places, parts, most)``: of each posting the factor of the weight. A written table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                places = np.frombuffer(block["places"], "<u2")
                tf = np.frombuffer(block["counts"], "<i4").astype(np.int64)
                size = np.frombuffer(block["lengths"], "<i4").astype(np.int64)[places]
                parts = 10**9 * tf // (1000 * tf + 8 * (25 + 75 * size * n // length)) if len(tf) else tf
                ends = np.cumsum(block["held"], dtype=np.int64)
                spans = list(zip([0, *ends.tolist()], ends.tolist()))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block["block"]] * len(spans), pa.int64()),
                    "term": pa.array(block["terms"], pa.string()),
                    "places": pa.array([places[a:b].tobytes() for a, b in spans], pa.binary()),
                    "parts": pa.array([parts[a:b].astype("<i4").tobytes() for a, b in spans], pa.binary()),
                    "most": pa.array([int(parts[a:b].max()) for a, b in spans], pa.int64()),
                })

    found = blocks.select("block", "lengths", "terms", "held", "places", "counts")
    return written(found.mapInArrow(read, "block long, term string, places binary, parts binary, most long"), "impacts")


_BUNDLE = "block long, group int, item long, places binary, scores binary, best array<long>"


def _stage(key: tuple, bundles: pd.DataFrame, postings: pd.DataFrame, k: int) -> pd.DataFrame:
    """Add the contributions of one owner's postings to the bundles of one block."""
    scores = {}
    for item, places, old in zip(bundles["item"], bundles["places"], bundles["scores"]):
        scores[item] = row = np.zeros(BLOCK, dtype=np.int64)
        row[np.frombuffer(places, "<u2")] = np.frombuffer(old, "<i8")
    bars = {}
    columns = ("weight", "places", "parts", "items", "repeats", "bars")
    for weight, places, parts, items, repeats, bar in zip(*(postings[c] for c in columns)):
        at = np.frombuffer(places, "<u2")
        added = weight * np.frombuffer(parts, "<i4").astype(np.int64)
        for item, times, least in zip(items, repeats, bar):
            row = scores.get(item)
            if row is None:
                scores[item] = row = np.zeros(BLOCK, dtype=np.int64)
            row[at] += added * times
            bars[item] = least
    out = []
    for item, row in scores.items():
        at = np.flatnonzero(row >= max(1, bars.get(item, 1)))
        if len(at):
            found = row[at]
            best = np.sort(found)[::-1][:k]
            out.append((*key, item, at.astype("<u2").tobytes(), found.astype("<i8").tobytes(), best.tolist()))
    return pd.DataFrame(out, columns=["block", "group", "item", "places", "scores", "best"])


def _finalists(key: tuple, bundles: pd.DataFrame, blocks: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best documents of each bundle of one block."""
    ids = blocks["doc_ids"].iloc[0]
    none = np.array([i is None or i != i for i in ids])
    ids = np.array([0 if skip else int(i) for i, skip in zip(ids, none)], dtype=np.int64)
    out = []
    for item, places, scores in zip(bundles["item"], bundles["places"], bundles["scores"]):
        at, score = np.frombuffer(places, "<u2"), np.frombuffer(scores, "<i8")
        for i in np.lexsort((at, ids[at], none[at], -score))[:k]:
            place = int(at[i])
            out.append((item, None if none[place] else int(ids[place]), key[0] + place, int(score[i])))
    return pd.DataFrame(out, columns=["item", "doc_id", "row", "score"], dtype=object)


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each row of ``items(item_id, text)`` the ``k`` highest-scoring of
    ``docs(doc_id, text)``, highest first, then by ascending id (nulls last).

    Terms are maximal runs of characters other than ASCII ones that are no letter or digit; only A-Z are lower-cased. Null and empty texts have
    no terms: such documents are found by nothing, such items find nothing. Documents with a score of 0 (a term in all
    documents may weigh 0) are not found. Rows that repeat an id are documents or items of their own, and copies of a text
    all count. Further columns of either table are not read.

    Exactness: a document is left out of a bundle only if its score so far and the most that all later owners could add
    (weight times the largest factor of any posting) stay below the item's k-th best score so far.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    asked = asked_terms(items)
    terms = asked.select("term").distinct()
    size = terms.agg((F.count(F.lit(1)) * 64 + F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).alias("n")).first()["n"]
    vocabulary = {row["term"] for row in terms.collect()} if size <= VOCABULARY_BYTES else None
    blocks = blocks_of(docs, vocabulary)
    weights, n, length = term_weights(blocks, asked)
    postings = impacts(blocks, n, length)

    most = postings.groupBy("term").agg(F.max("most").alias("most"))
    wanted = asked.join(weights.join(most, "term"), "term")
    wanted = written(wanted.withColumn("bound", F.col("repeats") * F.col("weight") * F.col("most")), "wanted")
    rest = wanted.groupBy("item", "owner").agg(F.sum("bound").alias("bound"))
    # Owners in falling order: what lies before one in the window comes after it in the pipeline.
    rest = rest.withColumn("place", -F.col("owner"))
    later = Window.partitionBy("item").orderBy("place").rangeBetween(Window.unboundedPreceding, -1)
    rest = written(rest.select("item", "owner", F.coalesce(F.sum("bound").over(later), F.lit(0)).alias("rest")), "rest")

    bundles = items.sparkSession.createDataFrame([], _BUNDLE)
    reached = items.sparkSession.createDataFrame([], "item long, reached long")
    for owner in range(OWNERS):
        own = wanted.filter(F.col("owner") == owner).join(rest, ["item", "owner"]).join(reached, "item", "left")
        bar = F.coalesce(F.col("reached") - F.col("rest"), F.lit(1)).alias("bar")
        entry = F.struct("item", F.col("repeats"), bar)
        own = own.groupBy("group", "term", "weight").agg(F.collect_list(entry).alias("entries"))
        own = own.select(
            "group", "term", "weight", F.col("entries.item").alias("items"),
            F.col("entries.repeats").alias("repeats"), F.col("entries.bar").alias("bars"),
        )
        met = postings.select("block", "term", "places", "parts").join(written(own, "owned"), "term").drop("term")

        def stage(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return _stage(key, left, right, k)

        passed = bundles.groupBy("block", "group").cogroup(met.groupBy("block", "group"))
        bundles = written(passed.applyInPandas(stage, _BUNDLE), "bundles")
        scores = bundles.select("item", "block", F.explode("best").alias("reached"))
        leading = top_per_group(scores, "item", [F.desc("reached")], k, "place", slice_by="block")
        reached = written(leading.filter(F.col("place") == k).select("item", "reached"), "reached")

    def finalists(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _finalists(key, left, right, k)

    found = bundles.select("block", "item", "places", "scores").groupBy("block")
    found = found.cogroup(blocks.select("block", "doc_ids").groupBy("block"))
    found = found.applyInPandas(finalists, "item long, doc_id long, row long, score long")
    order = [F.col("score").desc(), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")]
    ranked = top_per_group(found, "item", order, k, "rank", slice_by="row")
    names = asked.select("item", "item_id").distinct()
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
