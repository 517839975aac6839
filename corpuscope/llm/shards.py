"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows each partition sends to each shard is drawn first, with the partitions' and the shards' sizes as
margins. Then a partition permutes its rows among the shards it owes, the rows are exchanged, and
each shard is permuted again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpuscope.runtime import written

#: numpy draws exact hypergeometric numbers for populations below this.
NUMPY_POPULATION = 10**9
#: The second permutation of a shard is cut into slices of about so many rows, each sorted by one task.
SLICE_ROWS = 4096
_KEYS = 1 << 62


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart, the larger ones first."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows drawn without replacement are among the ``good`` ones.

    Beyond numpy's populations by inversion: the probabilities around the mode follow from ratios of
    neighbours, out to where they vanish in double precision.
    """
    if good + bad < NUMPY_POPULATION:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    least, most = max(0, draws - bad), min(good, draws)
    mode = min(most, max(least, (draws + 1) * (good + 1) // (good + bad + 2)))
    share = good / (good + bad)
    reach = int(12 * (draws * share * (1 - share)) ** 0.5) + 40
    k = np.arange(max(least, mode - reach), min(most, mode + reach), dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(ratio)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    at = np.searchsorted(mass, rng.random() * mass[-1], side="right")
    return max(least, mode - reach) + min(int(at), len(k))


def communication_matrix(partitions: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Rows sent from each partition to each shard, distributed as by a uniform permutation of all rows.

    Row sums are ``partitions``, column sums ``shards``. A partition's rows are drawn from the places that
    the earlier ones left open, shard by shard.
    """
    rng = np.random.default_rng([seed, 0])
    left = list(shards)
    matrix = np.zeros((len(partitions), len(shards)), dtype=np.int64)
    for p, rows in enumerate(partitions):
        others = sum(left)
        for j, places in enumerate(left):
            others -= places
            matrix[p, j] = drawn = hypergeometric(rng, places, others, rows)
            left[j] -= drawn
            rows -= drawn
    return matrix


def _dealt(counts: np.ndarray, part: int, seed: int, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of a partition, in the order read: shard, slice of the shard, key within the slice."""
    rng = np.random.default_rng([seed, 1, part])
    shard = rng.permutation(np.repeat(np.arange(len(counts), dtype=np.int32), counts))
    key = rng.integers(0, _KEYS, len(shard), dtype=np.int64)
    return shard, (key // -(-_KEYS // slices)).astype(np.int32), key


def shuffled(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` (from 0) and ``slot`` (from 0, gapless in each shard) to every row of a stored table.

    Shard sizes differ by one at most, and every assignment of rows to places is as likely as any other.
    Reruns over the same files agree. Rows are whatever they are: nulls, copies and empty texts count as
    one row each and copies are dealt apart; columns named ``shard`` or ``slot`` are replaced; an empty
    table gives no rows.

    ``docs`` is read twice, first for the rows of each partition (no column), so it must be a stored
    table, whose partitions are the same each time; if they are not, the run fails. To the driver
    and to the tasks goes the matrix alone, partitions x shards numbers. Rows are exchanged once. A shard's
    second permutation orders random keys; it is cut by the keys into slices, whose sizes are known
    from the matrix by dealing without data.
    """
    spark = docs.sparkSession
    part = F.spark_partition_id().alias("part")
    found = {row["part"]: row["n"] for row in docs.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [found.get(p, 0) for p in range(max(found, default=-1) + 1)]
    matrix = communication_matrix(sizes, shard_sizes(sum(sizes), shards), seed)
    wide = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, -(-sum(sizes) // (shards * SLICE_ROWS)), -(-min(wide, sum(sizes)) // shards))
    shared = spark.sparkContext.broadcast(matrix)

    def deal(batches):
        own = TaskContext.get().partitionId()
        counts = shared.value[own] if own < len(shared.value) else shared.value[:0].sum(0)
        dealt, at = _dealt(counts, own, seed, slices), 0
        for batch in batches:
            end = at + batch.num_rows
            if end > len(dealt[0]):
                raise ValueError(f"partition {own} has more rows than the {len(dealt[0])} counted before")
            extra = [pa.array(column[at:end]) for column in dealt]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], ["row", "shard", "slice", "key"])
            at = end
        if at < len(dealt[0]):
            raise ValueError(f"partition {own} has {at} rows, not the {len(dealt[0])} counted before")

    names = [name for name in docs.columns if name.lower() not in ("shard", "slot")]
    rows = docs.select(F.struct(*names).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    dealt = rows.mapInArrow(deal, f"row {kind}, shard int, slice int, key long")
    offsets = written(_slice_offsets(spark, shared, seed, slices), "slices")
    within = Window.partitionBy("shard", "slice").orderBy("key")
    placed = dealt.withColumn("place", F.row_number().over(within)).join(offsets, ["shard", "slice"])
    return placed.select("row.*", "shard", (F.col("first") + F.col("place") - 1).cast("long").alias("slot"))


def _slice_offsets(spark: SparkSession, matrix, seed: int, slices: int) -> DataFrame:
    """``(shard, slice, first)``: the first slot of every slice, by dealing all partitions without their rows."""

    def count(frames):
        for frame in frames:
            total = 0
            for part in frame["id"]:
                shard, piece, _ = _dealt(matrix.value[part], int(part), seed, slices)
                total = total + np.bincount(shard * np.int64(slices) + piece, minlength=matrix.value.shape[1] * slices)
            at = np.flatnonzero(total)
            yield type(frame)({"shard": at // slices, "slice": at % slices, "n": total[at] if len(at) else at})

    parts = spark.range(0, len(matrix.value), 1, max(1, min(len(matrix.value), spark.sparkContext.defaultParallelism * 4)))
    sizes = parts.mapInPandas(count, "shard int, slice int, n long").groupBy("shard", "slice").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write what :func:`shuffled` gave, a folder for each shard, each file a run of slots in order."""
    sharded.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
