"""Consecutive numbers over a table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# About so many rows are sorted in one task.
_ROWS_PER_SLICE = 500_000
_MOST_SLICES = 10_000


def number_rows(df: DataFrame, key: str, name: str) -> tuple[DataFrame, int]:
    """Number the rows from 1 in the order of the unique ``key``; also returns their count.

    Quantiles cut the keys into slices; a row's number is its place in its slice plus the size
    of all slices before. No slice is larger than a task can sort, whatever the table.
    """
    keys = df.select(key)
    total = keys.count()
    slices = min(_MOST_SLICES, -(-total // _ROWS_PER_SLICE))
    if slices <= 1:
        bounds: list = []
    else:
        cuts = [i / slices for i in range(1, slices)]
        at = F.percentile_approx(key, cuts, 10 * slices).alias("bounds")
        bounds = sorted(set(keys.agg(at).first()["bounds"]))
    before = F.lit(0)
    if bounds:
        before = F.size(F.filter(F.lit(bounds), lambda bound: bound < F.col(key)))
    sliced = df.withColumn("_slice", before)
    sizes = {row[0]: row[1] for row in sliced.groupBy("_slice").count().collect()}
    offsets, passed = [], 0
    for piece in range(len(bounds) + 1):
        offsets.append(passed)
        passed += sizes.get(piece, 0)
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(key))
    number = (within + F.get(F.lit(offsets), F.col("_slice"))).cast("bigint")
    return sliced.withColumn(name, number).drop("_slice"), total
