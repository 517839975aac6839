"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuscope.runtime import written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
#: About so many documents of one source and size are numbered by one task.
TIE_SLICE = 5_000
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _hashed(value: Column) -> Column:
    """The first 32 bits of the md5 of a value's text."""
    return F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Add ``target`` to a table with ``source, source_size`` and one row per source.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes; a target
    stops at ``cap`` times its source's size, and the excess is shared again by weight. That is the
    level L at which targets min(weight * L, cap * size) use up the sum, found from running
    sums over the sources by their cap per weight (one row per source in one task).
    """
    last = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = (F.row_number().over(last) - 1) % len(weights)
    table = F.array(*map(F.lit, weights))
    rows = sizes.withColumn("weight", F.element_at(table, turn + 1)).withColumn("most", F.col("source_size") * cap)
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "capped": F.coalesce(F.sum("most").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "all": F.sum("source_size").over(everything),
        }
    )
    rows = rows.withColumn("level", (F.col("all") - F.col("capped")) / F.col("open"))
    fits = F.col("level") * F.col("weight") <= F.col("most")
    level = F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("most") / F.col("weight"))).over(everything)
    target = F.least(F.col("most"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return rows.select(*sizes.columns, target.alias("target"))


def mix(
    docs: DataFrame, seed: int = 0, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``(id_col, source, size, source_size, target, copies)`` for every row.

    Each document of a source is expected target / source_size times. Along the source these expectations
    are summed, one offset in [0, 1) drawn from the seed and the source is added, and a document is taken once for
    every integer that its part of the sum crosses: floor(r * i + u) - floor(r * (i - 1) + u) times
    at place i. Largest documents come first, so that the words taken come near the target; ties
    in size go by a hash of the id, then the id. Reruns agree. Empty texts can be taken
    but have no words; a null source is a source of its own; with repeated ids each row counts.

    The places come from counts per (source, size), added up over the distinct sizes of a source, then
    per slice of equal documents, so neither a large source nor a group of copies is sorted by one task.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = written(rows.withColumn("hash", _hashed(F.col("id"))), "sizes")
    by_size = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("alike"))
    earlier = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.withColumn("before", F.coalesce(F.sum("alike").over(earlier), F.lit(0)))
    by_size = by_size.withColumn("slices", F.ceil(F.col("alike") / TIE_SLICE))
    by_size = written(by_size.withColumnRenamed("source", "s").withColumnRenamed("size", "n"), "by-size")

    totals = by_size.groupBy(F.col("s").alias("source")).agg(F.sum(F.col("n") * F.col("alike")).alias("source_size"))
    targets = written(source_targets(totals, weights, cap).withColumnRenamed("source", "s"), "targets")
    offset = _hashed(F.concat_ws(" ", F.lit(str(seed)), F.coalesce(F.concat(F.lit("="), F.col("s")), F.lit("null"))))
    targets = targets.withColumn("offset", offset / F.lit(4294967296.0))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    by_size = written(
        by_size.join(targets.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t"))).drop("t").withColumn("rate", rate), "rates"
    )

    same = rows["source"].eqNullSafe(by_size["s"]) & (rows["size"] == by_size["n"])
    placed = rows.join(by_size, same).withColumn("slice", F.pmod("hash", "slices"))
    placed = written(placed.drop("s", "n"), "placed")
    slices = placed.filter("slices > 1").groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("each"))
    lower = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("skipped", F.coalesce(F.sum("each").over(lower), F.lit(0))).drop("each")
    slices = written(slices.toDF("s", "n", "slice_no", "skipped"), "slices")
    within = Window.partitionBy("source", "size", "slice").orderBy(F.col("id").isNull(), "id")
    placed = placed.withColumn("within", F.row_number().over(within))
    same = placed["source"].eqNullSafe(slices["s"]) & (placed["size"] == slices["n"]) & (placed["slice"] == slices["slice_no"])
    place = F.col("before") + F.coalesce("skipped", F.lit(0)) + F.col("within")
    crossed = F.floor(F.col("rate") * place + F.col("offset")) - F.floor(F.col("rate") * (place - 1) + F.col("offset"))
    return placed.join(slices, same, "left").select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", crossed.cast("long").alias("copies")
    )
