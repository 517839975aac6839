"""How stored tables are cut into buckets, and how joins make use of that.

Stored tables are partitioned by a ``bucket`` column. A join that names the bucket as one of its
keys lets Spark prune, at run time, all buckets that the (small) other side does not ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpuscope.runtime import CODEC, shuffles_freed

BUCKET = "bucket"
PIECE = "_piece"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def with_bucket(
    df: DataFrame, keys: list[str], buckets: int | None
) -> tuple[DataFrame, list[str]]:
    """``df`` ready to join a table stored in ``buckets`` (None: not stored) and the join keys."""
    if buckets is None:
        return df, keys
    # Every bucket passes the filter; without one Spark does not expect pruning to pay off.
    asked = df.withColumn(BUCKET, bucket_of(keys, buckets)).filter(F.col(BUCKET) >= 0)
    return asked, [BUCKET, *keys]


def write_buckets(
    df: DataFrame, keys: list[str], order: list[str], buckets: int, path: str
) -> None:
    """Write ``df`` partitioned by the bucket of ``keys``, each file sorted by ``order``.

    Each bucket is cut into as many slices as it takes to occupy all shuffle partitions, so
    a large bucket is not the work of one task and has several files.
    """
    placed = placed_in_buckets(df, keys, buckets).drop(PIECE)
    write_placed(placed, order, path)


def placed_in_buckets(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``df`` with its bucket and slice, shuffled as :func:`write_buckets` stores it: rows with equal ``keys`` share a task."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = -(-partitions // buckets)
    piece = F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(slices))
    return df.withColumns({BUCKET: bucket_of(keys, buckets), PIECE: piece}).repartition(BUCKET, PIECE)


def write_placed(placed: DataFrame, order: list[str], path: str) -> None:
    """Write what :func:`placed_in_buckets` gave, each file sorted by ``order``."""
    ordered = placed.sortWithinPartitions(BUCKET, *order)
    with shuffles_freed(placed.sparkSession):
        ordered.write.mode("overwrite").partitionBy(BUCKET).parquet(path, compression=CODEC)
