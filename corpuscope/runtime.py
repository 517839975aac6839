"""Helpers that decide where intermediate data lives and how it is spread over the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session (one machine, as in tests) may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="corpuscope-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used yet.

    All paths of an application lie in one folder named after it, which :func:`release` removes.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


# Texts and postings take a quarter less room on disk than with the default codec.
CODEC = "zstd"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a statement inside are removed at its end, not when the driver happens to collect garbage.

    For statements that write a table: nothing reads their shuffles later.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table that is used several times to the shared folder and read it back.

    Unlike a cache it outlives its executors, and each use reads only the columns it needs. With
    ``by`` the table is partitioned by that column.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, partitionBy=by, compression=CODEC)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`written` gave, once no result that is still to be made reads them."""
    for table in tables:
        _remove(table.sparkSession, table._written_to)


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, once no result that reads them is needed."""
    _remove(spark, f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a table that arrives in fewer splits than there are cores one partition per core.

    A table of realistic size has more splits than cores and is returned as it is, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def partitions_for(spark: SparkSession, rows: int, rows_each: int = 1_000_000) -> int:
    """How many partitions suit so many rows: one per core at least, the configured number at most."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(spark.sparkContext.defaultParallelism, -(-rows // rows_each)))


# Spark prunes ``row_number() <= n`` ahead of the shuffle up to this n
# (spark.sql.optimizer.windowGroupLimitThreshold); above it the groups are cut into slices first.
_PRUNED_LIMIT = 1000
_SLICES = 64


def top_per_group(
    df: DataFrame, group: str, order: list[Column], n: int, rank: str, slice_by: str
) -> DataFrame:
    """The first ``n`` rows of every group with their 1-based ``rank``.

    No task has to sort a whole group: small ``n`` are pruned within each partition before the
    shuffle, large ``n`` within slices of the group.
    """
    if n > _PRUNED_LIMIT:
        piece = F.pmod(F.xxhash64(F.col(slice_by)), F.lit(_SLICES))
        within = Window.partitionBy(group, "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", piece)
            .withColumn("_pre", F.row_number().over(within))
            .filter(F.col("_pre") <= n)
            .drop("_slice", "_pre")
        )
    overall = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(overall)).filter(F.col(rank) <= n)
