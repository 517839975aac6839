"""Clusters of speeches with similar topics, and what to say about them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from corpuscope.operators.numbering import number_rows
from corpuscope.runtime import top_per_group
from corpuscope.schema import SPEECH_ID, columns_with_prefix, require_columns

# Centroids per pass of the assignment; a task holds no more of them at once.
_CHUNK = 1_024

# K-Means starts whose first centroids are chosen at the same time.
_PARALLEL_STARTS = 10

# MLlib's tolerance: a start ends when no centroid moves further.
_TOLERANCE = 1e-4


# Partial sums that one task of the tree merges, and at most so many that the driver does.
_FAN_IN = 64


@dataclass(frozen=True)
class Clusters:
    """``assigned`` (the input with ``cluster_id``), the centroid of each id, and the inertia."""

    assigned: DataFrame
    centroids: list[list[float]]
    cost: float


def cluster_topics(
    df: DataFrame,
    k: int = 100,
    seed: int = 42,
    n_init: int = 10,
    max_iter: int = 300,
    column: str = "topics",
) -> Clusters:
    """K-Means on an array column: the best of ``n_init`` starts by inertia.

    MLlib chooses the first centroids of each start; all starts then share the passes over the vectors.

    A start ends when no centroid moves further than MLlib's tolerance of 1e-4, at the latest after
    ``max_iter`` iterations. Fewer than ``k`` ids come back if some cluster is left empty, as when
    there are fewer than ``k`` different vectors. Clusters are numbered by size, largest first, then by centroid, so the same partition always
    gets the same ids.
    """
    require_columns(df, [column])
    vectors = df.select(array_to_vector(F.col(column)).alias("features"))
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    packed = _packed(df, column).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        vectors.count()

        def first(start: int) -> np.ndarray:
            model = KMeans(k=k, seed=seed + start, maxIter=0).fit(vectors)
            return np.array([center for center in model.clusterCenters()], dtype=np.float64)

        # The starts are independent jobs over the same kept vectors; run together they fill the cluster.
        with ThreadPool(min(n_init, _PARALLEL_STARTS)) as pool:
            target = inheritable_thread_target(df.sparkSession)(first)
            starts = pool.map(target, range(n_init))
        starts = _iterated(packed, starts, max_iter)
        results = _sums(packed, starts)
        best = min(range(n_init), key=lambda start: results[start][2])
        _, sizes, cost = results[best]
        centroids = [[float(x) for x in center] for center in starts[best]]
    finally:
        vectors.unpersist()
        packed.unpersist()

    filled = [i for i in range(len(centroids)) if sizes[i] > 0]
    order = sorted(filled, key=lambda i: (-sizes[i], [round(x, 9) for x in centroids[i]]))
    centroids = [centroids[i] for i in order]
    return Clusters(assign_clusters(df, centroids, column), centroids, cost)


def _packed(df: DataFrame, column: str) -> DataFrame:
    """The vectors as blocks of doubles, ``(n, x)``, dealt to all cores: each pass reads them, however few files they came in."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0).flatten().to_numpy(zero_copy_only=False).tobytes()
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64()), "x": pa.array([block], pa.binary())})

    vectors = df.select(F.col(column).cast("array<double>"))
    cores = df.sparkSession.sparkContext.defaultParallelism
    if vectors.rdd.getNumPartitions() < cores:
        vectors = vectors.repartition(cores)
    return vectors.mapInArrow(pack, "n long, x binary")


def _sums(packed: DataFrame, starts: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each start the sums and numbers of the vectors next to its centroids, and the inertia, from one pass."""
    shapes = [centers.shape for centers in starts]
    most = 1_024

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((k, d + 2)) for k, d in shapes]
        part = -1
        for batch in batches:
            part = batch.column("part")[0].as_py()
            for n, x in zip(batch.column("n").to_pylist(), batch.column("x")):
                block = np.frombuffer(x.as_buffer(), dtype=np.float64).reshape(n, -1)
                for at in range(0, n, most):
                    points = block[at : at + most]
                    rows = np.arange(len(points))
                    squares = np.square(points).sum(axis=1)
                    for centers, total in zip(starts, sums):
                        lengths = np.square(centers).sum(axis=1)
                        distance = points @ (-2.0 * centers.T) + lengths
                        nearest = distance.argmin(axis=1)
                        least = distance[rows, nearest]
                        distance[rows, nearest] = np.inf
                        # The products round; what they leave in doubt is decided by the differences.
                        close = np.flatnonzero(~(distance.min(axis=1) - least > 1e-12 * (squares + lengths.max())))
                        for row in close:
                            nearest[row] = np.square(points[row] - centers).sum(axis=1).argmin()
                        # A sum for each centroid, each vector in turn.
                        order = np.argsort(nearest, kind="stable")
                        first = np.flatnonzero(np.diff(nearest[order], prepend=-1))
                        found = nearest[order][first]
                        gap = np.square(points - centers[nearest]).sum(axis=1)
                        columns = np.column_stack([points, np.ones(len(points)), gap])[order]
                        total[found] += np.add.reduceat(columns, first)
        numbers = np.concatenate([total.ravel() for total in sums]).tobytes()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "sums": pa.array([numbers], pa.binary())})

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(numbers) for numbers in frame["sums"]], axis=0)
        return pd.DataFrame({"part": frame["part"].iloc[:1], "sums": [total.tobytes()]})

    parts = packed.select(F.spark_partition_id().cast("long").alias("part"), "n", "x")
    partial = parts.mapInArrow(summed, "part long, sums binary").filter("part >= 0")
    left = packed.rdd.getNumPartitions()
    while left > _FAN_IN:
        up = F.floor(F.col("part") / _FAN_IN).alias("part")
        partial = partial.select(up, "sums").groupBy("part").applyInPandas(merged, "part long, sums binary")
        left = -(-left // _FAN_IN)
    rows = sorted(partial.collect(), key=lambda row: row["part"])
    total = np.sum([np.frombuffer(row["sums"]) for row in rows], axis=0)
    cuts = np.cumsum([k * (d + 2) for k, d in shapes])[:-1]
    tables = [table.reshape(k, d + 2) for table, (k, d) in zip(np.split(total, cuts), shapes)]
    return [(table[:, :-2], table[:, -2].astype(np.int64), float(table[:, -1].sum())) for table in tables]


def _iterated(packed: DataFrame, starts: list[np.ndarray], max_iter: int) -> list[np.ndarray]:
    """Lloyd's iterations of all starts together: each pass moves the centroids of every start that still does.

    An empty cluster keeps its centroid; a start ends as MLlib's does.
    """
    starts, moving = list(starts), list(range(len(starts)))
    for _ in range(max_iter):
        if not moving:
            break
        still = []
        for start, (sums, sizes, _) in zip(moving, _sums(packed, [starts[start] for start in moving])):
            filled = sizes > 0
            centers = starts[start].copy()
            centers[filled] = sums[filled] / sizes[filled, None]
            if (np.square(centers - starts[start]).sum(axis=1) > _TOLERANCE**2).any():
                still.append(start)
            starts[start] = centers
        moving = still
    return starts


def assign_clusters(
    df: DataFrame,
    centroids: Sequence[Sequence[float]],
    column: str = "topics",
    ids: Sequence[int] | None = None,
) -> DataFrame:
    """Add the ``cluster_id`` of the nearest centroid; ties go to the lower id.

    Centroids are model parameters (clusters x dimensions numbers). A large model is shipped in
    chunks, each improving on the nearest centroid so far.
    """
    labels = np.array(ids if ids is not None else range(len(centroids)), dtype=np.int64)
    order = np.argsort(labels, kind="stable")
    labels, centers = labels[order], np.asarray(centroids, dtype=np.float64)[order]

    def nearest(begin: int):
        chunk, chunk_labels = centers[begin : begin + _CHUNK], labels[begin : begin + _CHUNK]

        @F.pandas_udf("distance double, cluster_id long")
        def in_chunk(vectors: pd.Series) -> pd.DataFrame:
            if vectors.empty:
                return pd.DataFrame({"distance": [], "cluster_id": []})
            points = np.stack(vectors.to_numpy()).astype(np.float64)
            distance = np.full(len(points), np.inf)
            nearest_id = np.full(len(points), -1, dtype=np.int64)
            for center, label in zip(chunk, chunk_labels):
                squared = np.square(points - center).sum(axis=1)
                closer = squared < distance
                distance[closer] = squared[closer]
                nearest_id[closer] = label
            return pd.DataFrame({"distance": distance, "cluster_id": nearest_id})

        return in_chunk(F.col(column))

    best = None
    for begin in range(0, len(centers), _CHUNK):
        found = nearest(begin)
        best = found if best is None else F.least(best, found)
    assigned = df.withColumn("_nearest", best)
    return assigned.withColumn("cluster_id", F.col("_nearest.cluster_id").cast("int")).drop(
        "_nearest"
    )


def cluster_sizes(df: DataFrame) -> DataFrame:
    """``(cluster_id, n_speeches)`` by id."""
    require_columns(df, ["cluster_id"])
    return df.groupBy("cluster_id").agg(F.count("*").alias("n_speeches")).orderBy("cluster_id")


def cluster_size_report(df: DataFrame, n: int = 5, small: int = 5) -> DataFrame:
    """``(part, rank, cluster_id, n_speeches)``: the largest and the smallest clusters, and under
    ``small`` (rank 1, no id) the number of clusters with fewer than ``small`` speeches.

    There is one row per cluster to sort, not one per speech.
    """
    sizes = cluster_sizes(df)
    both = sizes.withColumn("part", F.explode(F.array(F.lit("largest"), F.lit("smallest"))))
    size = F.when(F.col("part") == "largest", -F.col("n_speeches")).otherwise(F.col("n_speeches"))
    ends = top_per_group(both, "part", [size, F.col("cluster_id")], n, "rank", "cluster_id")
    few = sizes.agg(F.count_if(F.col("n_speeches") < small).alias("n_speeches")).select(
        F.lit("small").alias("part"),
        F.lit(1).alias("rank"),
        F.lit(None).cast("int").alias("cluster_id"),
        "n_speeches",
    )
    return ends.unionByName(few)


def cluster_topic_means(df: DataFrame, dims: int | None = None, column: str = "topics") -> DataFrame:
    """``(cluster_id, Topic_1, ..)``: the mean of each topic by cluster, ids ascending.

    Works on an array column of ``dims`` numbers or, without ``dims``, on ``Topic_*`` columns.
    """
    require_columns(df, ["cluster_id"])
    if dims is None:
        means = [F.avg(name).alias(name) for name in columns_with_prefix(df, "Topic_")]
    else:
        means = [F.avg(F.get(F.col(column), j)).alias(f"Topic_{j + 1}") for j in range(dims)]
    return df.groupBy("cluster_id").agg(*means).orderBy("cluster_id")


def cluster_top_topics(means: DataFrame, min_weight: float = 0.05) -> DataFrame:
    """``(cluster_id, topic, weight)``: topics above ``min_weight`` per cluster, to 3 places."""
    names = columns_with_prefix(means, "Topic_")
    long = means.unpivot("cluster_id", names, "topic", "weight")
    heavy = long.filter(F.col("weight") > min_weight)
    return heavy.select("cluster_id", "topic", F.bround("weight", 3).alias("weight"))


def select_cluster(df: DataFrame, cluster_id: int) -> DataFrame:
    """The speeches of one cluster."""
    require_columns(df, ["cluster_id"])
    return df.filter(F.col("cluster_id") == int(cluster_id))


# The layout of an exported speech and the words for missing fields.
_BLOCK = (
    "--- Ομιλία %d/%d ---\nΟμιλητής: %s\nΗμερομηνία: %s\nΚείμενο:\n%s\n\n" + "=" * 50 + "\n\n"
)
_NO_NAME = "Άγνωστος"
_NO_DATE = "-"


def cluster_speeches(df: DataFrame, cluster_id: int, order_by: str = SPEECH_ID) -> DataFrame:
    """``(index, block)``: the speeches of one cluster as numbered text blocks, by speech id."""
    chosen = select_cluster(df, cluster_id)
    numbered, count = number_rows(chosen, order_by, "index")
    block = F.format_string(
        _BLOCK,
        "index",
        F.lit(count),
        F.coalesce("member_name", F.lit(_NO_NAME)),
        F.coalesce("sitting_date", F.lit(_NO_DATE)),
        "speech",
    )
    return numbered.select("index", block.alias("block"))


def write_cluster_speeches(blocks: DataFrame, path: str) -> None:
    """Write the blocks as text, in order over the files and within each."""
    ranged = blocks.repartitionByRange("index").sortWithinPartitions("index")
    # The writer ends each block with the newline that is cut off here.
    lines = ranged.select(F.regexp_replace("block", r"\n\z", "").alias("block"))
    lines.write.mode("overwrite").text(path)
