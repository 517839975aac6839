"""Approximate nearest neighbours by a forest of random-projection trees.

A tree halves the vectors again and again at the median of their products with a random direction. The
directions and medians come from a bounded sample; every vector is then indexed under its leaf of each
tree. A query walks all trees at once through one priority queue: the branch whose splits it misses by
the least comes next, whichever tree it belongs to, until the leaves reached hold enough vectors. These
are ranked by their exact cosines, where the vectors are.

How many are enough is measured: for a bounded number of the queries the true neighbours are found
among all vectors, and the walk is long enough to meet the wanted share of them. Vectors with structure
need few leaves, vectors that point everywhere need many.

Each vector is stored once, in a part of bounded size with its neighbours by the first tree. A query goes to
the parts that hold vectors of its leaves. Equal vectors are one entry with their smallest ids, so copies fill no leaf.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuscope.llm.tiles import _matrix, _unit, usable
from corpuscope.runtime import written

#: Trees, and the numbers in the sample that fits them: 20,000 vectors of 64 numbers.
TREES = 16
SAMPLE_NUMBERS = 1_280_000
#: A leaf holds about so many vectors of the sample.
LEAF_SAMPLE = 32
#: The share of true neighbours that walks are made long enough for, and the queries it is measured on.
RECALL = 0.95
TRIALS = 200
#: A task ranks so many entries at most for so many queries.
PART_ENTRIES = 16_000
PART_QUERIES = 4_000
#: Parts are told apart by the leaves they hold in so many regions at most; a region has 4 kB for each 32,768 leaves.
REGIONS = 4_096
_BITS = 32_768


class Forest:
    """Arrays of splits; a child that is a leaf is stored as minus its number minus one."""

    def __init__(self, sample: np.ndarray, trees: int, seed: int) -> None:
        width = sample.shape[1] if sample.size else 1
        random = np.random.default_rng(seed)
        self.directions, self.medians, self.children, self.roots, self.leaves = [], [], [], [], []
        for _ in range(trees):
            leaves = 0
            todo, top = [(np.arange(len(sample)), None)], None
            while todo:
                rows, above = todo.pop()
                me = -leaves - 1
                if len(rows) > LEAF_SAMPLE:
                    direction = random.standard_normal(width)
                    product = sample[rows] @ (direction / np.linalg.norm(direction))
                    median = float(np.median(product))
                    if (product < median).any():
                        me = len(self.medians)
                        self.directions.append(direction / np.linalg.norm(direction))
                        self.medians.append(median)
                        self.children.append([0, 0])
                        todo += [(rows[product < median], (me, 0)), (rows[product >= median], (me, 1))]
                if me < 0:
                    leaves += 1
                if above is None:
                    top = me
                else:
                    self.children[above[0]][above[1]] = me
            self.roots.append(top)
            self.leaves.append(leaves)
        self.directions = np.array(self.directions).reshape(-1, width)
        self.medians = np.array(self.medians)
        self.children = np.array(self.children).reshape(-1, 2)
        #: Numbers leaves over all trees.
        self.first_leaf = np.r_[0, np.cumsum(self.leaves)]

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        out = np.zeros((len(vectors), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(vectors), root)
            while (at >= 0).any():
                moving = np.flatnonzero(at >= 0)
                node = at[moving]
                side = np.einsum("ij,ij->i", vectors[moving], self.directions[node]) >= self.medians[node]
                at[moving] = self.children[node, side.astype(int)]
            out[:, t] = self.first_leaf[t] - at - 1
        return out

    def walk(self, vector: np.ndarray, sizes: np.ndarray):
        """Leaves that hold entries, with the entries in the leaves before, in the order of the splits missed on their way.

        A way's misses add up as squares, as the distances to its hyperplanes would if they stood at right angles.
        """
        margins = self.directions @ vector - self.medians
        queue = [(0.0, t, root) for t, root in enumerate(self.roots)]
        heapq.heapify(queue)
        held = 0
        while queue:
            missed, t, node = heapq.heappop(queue)
            if node < 0:
                leaf = int(self.first_leaf[t]) - node - 1
                if sizes[leaf]:
                    yield leaf, held
                    held += int(sizes[leaf])
                continue
            margin = float(margins[node])
            near = int(margin >= 0)
            heapq.heappush(queue, (missed, t, int(self.children[node, near])))
            heapq.heappush(queue, (missed + margin * margin, t, int(self.children[node, 1 - near])))

    def search(self, vector: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
        """The first leaves of the walk, until they hold ``enough``."""
        found = []
        for leaf, before in self.walk(vector, sizes):
            if before >= enough:
                break
            found.append(leaf)
        return found


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, share: float | None = None, trees: int = TREES, seed: int = 0,
    id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL,
) -> DataFrame:
    """``(query_id, rank, id_col, score)``: the ``k`` nearest vectors found for each query row.

    Nearness is the cosine in double precision, ties go to the smaller id, a query's own id is no
    candidate. Vectors with nulls, NaN or infinities and zero vectors take no part, nor do null ids;
    vectors of different lengths never meet. Rows that repeat an id and a vector count once. With
    ``k`` candidates or fewer all are returned. A query is shown as many entries (one met in two trees
    counts twice) as find the share ``recall`` of the neighbours of ``TRIALS`` queries, or, if given, ``share``
    times the number of entries; a share of ``trees`` or more visits everything.
    """
    spark = vectors.sparkSession
    rows = usable(vectors.withColumn("_query", is_query), id_col, vector_col)
    rows = rows.filter("id IS NOT NULL").distinct().withColumn("key", F.xxhash64("vector"))
    # Of equal vectors the k + 1 smallest ids can be among somebody's k nearest.
    order = Window.partitionBy("key", "vector").orderBy("id")
    ids = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    entries = ids.groupBy("key", "vector").agg(F.min("id").alias("entry"), F.sort_array(F.collect_list("id")).alias("ids"))
    entries = written(entries, "entries")
    asked = written(
        usable(vectors.filter(is_query), id_col, vector_col).filter("id IS NOT NULL").distinct(), "queries"
    )
    results = []
    for width, count in entries.groupBy(F.size("vector").alias("width")).count().collect():  # one length, as a rule
        own, questions = (t.filter(F.size("vector") == width) for t in (entries, asked))
        results.append(_search(own, questions, width, count, k, share, trees, seed, recall))
    if not results:
        results = [spark.createDataFrame([], "query long, entry long, score double")]
    near = results[0]
    for more in results[1:]:
        near = near.union(more)
    near = near.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("id"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    near = near.filter(F.col("id") != F.col("query")).withColumn("rank", F.row_number().over(best).cast("int"))
    return near.filter(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias(id_col), "score"
    )


def _at(numbers: np.ndarray, index: Column) -> Column:
    """The number at ``index`` of a bounded list."""
    return F.get(F.lit(numbers.tolist()), index)


def _enough(forest: Forest, placed: DataFrame, asked: DataFrame, sizes: np.ndarray, k: int, seed: int, recall: float) -> float:
    """The entries a walk must hold to meet ``recall`` of the true neighbours of ``TRIALS`` queries, drawn by a hash."""
    drawn = asked.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(TRIALS).select("vector").collect()
    if not drawn:
        return 1.0
    trials = _unit(np.array([r[0] for r in drawn]))

    def best(tables):
        for table in tables:
            own = _unit(_matrix(table.column("vector"))) @ trials.T
            first = np.argpartition(-own, min(k, len(own) - 1), axis=0)[: k + 1]
            for trial, rows in enumerate(first.T):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), trial)), pa.array(own[rows, trial]), table.column("leaves").take(pa.array(rows))],
                    ["trial", "score", "leaves"],
                )

    order = Window.partitionBy("trial").orderBy(F.desc("score"), F.xxhash64("leaves"))
    near = placed.select("vector", "leaves").mapInArrow(best, "trial long, score double, leaves array<long>")
    near = near.withColumn("place", F.row_number().over(order)).filter((F.col("place") > 1) & (F.col("place") <= k + 1))
    wanted = defaultdict(list)
    for trial, leaves in near.select("trial", "leaves").collect():  # k rows for each trial; the first is the query itself
        wanted[trial].append(leaves)
    needed = []
    for trial, neighbours in wanted.items():
        before = np.full(len(sizes), np.iinfo(np.int64).max)
        for leaf, held in forest.walk(trials[trial], sizes):
            before[leaf] = held
        needed += [int(before[leaves].min()) for leaves in neighbours]
    return float(np.quantile(needed, recall, method="higher")) + 1 if needed else 1.0


def _search(
    entries: DataFrame, asked: DataFrame, width: int, count: int, k: int, share: float | None, trees: int, seed: int, recall: float
) -> DataFrame:
    """``(query, entry, score)``: the best entries of each query within each part."""
    most = max(1, SAMPLE_NUMBERS // width)
    drawn = entries.select("vector").orderBy(F.xxhash64("vector", F.lit(seed))).limit(most).collect()
    forest = Forest(_unit(np.array([r[0] for r in drawn])), trees, seed)
    leaves = int(forest.first_leaf[-1])

    def place(tables):
        for table in tables:
            found = forest.leaves_of(_unit(_matrix(table.column("vector"))))
            yield pa.RecordBatch.from_arrays(
                [table.column("entry"), table.column("vector"), pa.array(list(found), pa.list_(pa.int64()))],
                ["entry", "vector", "leaves"],
            )

    placed = written(entries.select("entry", "vector").mapInArrow(place, "entry long, vector array<double>, leaves array<long>"), "leaves")
    sizes = np.zeros(leaves, np.int64)
    # One number per leaf, of which there are as many as the sample allows.
    for leaf, n in placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        sizes[leaf] = n
    enough = share * count if share is not None else _enough(forest, placed, asked, sizes, k, seed, recall)
    enough = max(enough, trees * (k + 1))  # of which one tree alone has k others at least

    # Along the leaves of the first tree the entries have places, drawn within their leaf; parts are runs of places.
    ends = np.cumsum(sizes[: forest.leaves[0]])
    leaf = F.get("leaves", F.lit(0))
    first = _at(ends - sizes[: forest.leaves[0]], leaf)
    within = F.pmod(F.xxhash64("entry", F.lit(seed)), F.greatest(_at(sizes[: forest.leaves[0]], leaf), F.lit(1)))
    part = F.floor((first + within) / PART_ENTRIES).cast("long")
    placed = placed.withColumn("part", part)
    total = -(-count // PART_ENTRIES)
    each = -(-total // REGIONS)
    number = F.explode("leaves").alias("leaf")
    held = placed.select(F.floor(F.col("part") / each).alias("region"), number).withColumn("leaf", F.col("leaf") + 1)
    held = held.groupBy("region", F.bitmap_bucket_number("leaf").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("leaf")).alias("bits")
    )
    buckets = -(-leaves // _BITS)
    regions = np.zeros((-(-total // each), buckets * _BITS // 8), np.uint8)
    for region, bucket, bits in held.collect():  # at most REGIONS rows for each bucket
        regions[region, (bucket - 1) * _BITS // 8 : bucket * _BITS // 8] = np.frombuffer(bits, np.uint8)
    regions = regions[:, : -(-leaves // 8)]

    def visit(tables):
        for table in tables:
            for query, vector in zip(table.column("id").to_pylist(), _matrix(table.column("vector"))):
                seen = np.zeros(leaves, bool)
                seen[forest.search(_unit(vector[None])[0], sizes, enough)] = True
                packed = np.packbits(seen, bitorder="little")
                reached = np.flatnonzero((regions & packed).any(1))
                parts = (reached[:, None] * each + np.arange(each)).ravel()
                parts = parts[parts < total]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts), pa.array([query] * len(parts), pa.int64()),
                     pa.array([vector] * len(parts), pa.list_(pa.float64())), pa.array([packed.tobytes()] * len(parts), pa.binary())],
                    ["part", "query", "vector", "seen"],
                )

    spread = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    visits = asked.repartition(spread).mapInArrow(visit, "part long, query long, vector array<double>, seen binary")
    visits = written(visits, "visits")
    # A part that many queries visit meets them in slices.
    slices = visits.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / PART_QUERIES).cast("int").alias("slices"))
    slices = written(slices, "slices")
    asking = visits.join(slices, "part").withColumn("slice", F.pmod(F.xxhash64("query"), "slices").cast("int"))
    showing = placed.join(slices, "part").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))

    def rank(key, shown: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        kept = [[], [], []]
        if len(shown) and len(queries):
            shown = shown.sort_values("entry")
            entry = shown["entry"].to_numpy()
            units, under = _unit(np.stack(shown["vector"].to_list())), np.stack(shown["leaves"].to_list())
            for query, vector, seen in zip(queries["query"], _unit(np.stack(queries["vector"].to_list())), queries["seen"]):
                bits = np.unpackbits(np.frombuffer(seen, np.uint8), bitorder="little").astype(bool)
                met = np.flatnonzero(bits[under].any(1))
                scores = units[met] @ vector
                order = np.argsort(-scores, kind="stable")[: k + 1]  # equal scores: smaller ids first
                kept[0].append(np.full(len(order), query))
                kept[1].append(entry[met[order]])
                kept[2].append(scores[order])
        query, found, scores = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in kept)
        return pd.DataFrame({"query": query, "entry": found, "score": scores})

    shown = showing.select("part", "slice", "entry", "vector", "leaves").groupBy("part", "slice")
    asked_of = asking.select("part", "slice", "query", "vector", "seen").groupBy("part", "slice")
    return shown.cogroup(asked_of).applyInPandas(rank, "query long, entry long, score double")
