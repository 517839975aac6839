"""All pairs of near-equal vectors, tile by tile, with the dimensions in the order of their variance.

Vectors are scaled to length one and turned into the directions of the principal components. Of two
tiles, the products over the leading dimensions are added up first; what the remaining dimensions can
add is at most the product of the lengths of the remainders. Pairs that cannot reach the threshold are
given up after each group of dimensions; the rest is computed in full, in double precision.

Tiles hold vectors that are alike in the leading dimensions: two unit vectors with cosine c are at most
sqrt(2 - 2c) apart in every direction, so vectors are binned by steps of that width along the first
directions, and only tiles of equal or neighbouring bins meet. Equal vectors are one from the start.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpuscope.llm.components import components
from corpuscope.runtime import written

#: Vectors that travel together, and those that one matrix product compares.
TILE = 8_192
BLOCK = 1_024
#: Directions along which vectors are binned: each more prunes more and sends a tile to thrice as many partners.
LEADING = 2
STEPS = (8, 8, 16, 32)
#: Turned vectors decide pairs that are farther than this from the threshold, the original ones decide the others.
ROUNDING = 1e-12


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` (doubles) of the rows whose vector takes part: no null, no NaN or infinity, not all zero."""
    values = F.transform(vector_col, lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), values.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)  # large and tiny components stay finite
    return matrix / np.sqrt((matrix * matrix).sum(1, keepdims=True))


def principal_axes(classes: DataFrame, width: int) -> np.ndarray:
    """Columns: the directions of the unit vectors' second moments, largest first; from sums over all rows."""

    def moments(tables):
        total = np.zeros((width, width))
        for table in tables:
            own = _unit(_matrix(table.column("vector")))
            total += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([total.ravel()], pa.list_(pa.float64()))], ["k", "m"])

    rows = classes.mapInArrow(moments, "k int, m array<double>").select(F.posexplode("m"))
    sums = rows.groupBy("pos").agg(F.sum("col").alias("m")).collect()  # width squared numbers
    total = np.zeros(width * width)
    for pos, value in sums:
        total[pos] = value
    return np.linalg.eigh(total.reshape(width, width))[1][:, ::-1]


def compare_tiles(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of rows (unit vectors in the order of the axes) whose cosine reaches ``least`` or is within
    ``ROUNDING`` of it, and which pairs are so close."""
    width = a.shape[1]
    rows, cols, sums, start = None, None, None, 0
    for step in (*STEPS, width):
        stop = min(width, start + step)
        if rows is None:
            part = a[:, :stop] @ b[:, :stop].T
            rest = np.outer(np.sqrt((a[:, stop:] ** 2).sum(1)), np.sqrt((b[:, stop:] ** 2).sum(1)))
            rows, cols = np.nonzero(part + rest >= least - 1e-9)
            sums = part[rows, cols]
        elif start < width:
            sums = sums + np.einsum("ij,ij->i", a[rows, start:stop], b[cols, start:stop])
            rest = np.sqrt((a[rows, stop:] ** 2).sum(1) * (b[cols, stop:] ** 2).sum(1))
            kept = sums + rest >= least - 1e-9
            rows, cols, sums = rows[kept], cols[kept], sums[kept]
        start = stop
        if not len(rows):
            break
    reached = sums >= least - ROUNDING
    return rows[reached], cols[reached], sums[reached] < least + ROUNDING


def joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each the smallest node of its component) after nodes ``i`` and ``j`` are linked pairwise."""
    while True:
        u, v = labels[i], labels[j]
        differ = u != v
        if not differ.any():
            return labels
        i, j, u, v = i[differ], j[differ], u[differ], v[differ]
        parent = np.arange(len(labels))
        np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        labels = parent[labels]


def near_vectors(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for every row of ``vectors``.

    Two vectors link if their cosine is ``least`` or more, none below it: where turned vectors cannot tell, the
    original ones do, scaled to length one, multiplied and added in doubles. Vectors that take no part (see ``usable``)
    and those whose length nobody shares have no links and their own id as component. Equal
    vectors link with each other; rows with the same id and vector count as different rows. A null id
    gives a null component. ``kept`` marks the vector whose id names its component.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    key = F.xxhash64("vector")  # the arrays are compared too, the hash only shortens the key
    rows = rows.filter("id IS NOT NULL").withColumn("key", key)
    classes = rows.groupBy("key", "vector").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes, "vector-classes")

    pieces = []
    for (width,) in classes.select(F.size("vector")).distinct().collect():  # lengths of vectors: one, as a rule
        pieces.append(_links(classes.filter(F.size("vector") == width), width, least))
    found = pieces[0] if pieces else spark.createDataFrame([], "kind int, a long, b long")
    for more in pieces[1:]:
        found = found.union(more)
    found = written(found, "vector-links")

    counts = found.filter("kind = 1").groupBy(F.col("a").alias("class")).agg(F.sum("b").alias("others"))
    comps = components(found.filter("kind = 0").select("a", "b")).withColumnRenamed("node", "class")
    places = classes.select("key", "vector", "class", "copies").join(counts, "class", "left").join(comps, "class", "left")
    places = places.select(
        "key", "vector",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class").alias("component"),
    )
    places = written(places, "vector-places")
    every = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("vector"))
    out = every.withColumn("key", key).join(places, ["key", "vector"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _links(classes: DataFrame, width: int, least: float) -> DataFrame:
    """Rows (0, a, b): a and b are of one component; (1, a, n): a links to n vectors within one pair of tiles."""
    found = written(_compared(classes, width, least), "tile-links")
    close = found.filter("kind = 2")
    own = classes.select("class", "copies", "vector")
    for side in "ab":
        close = close.join(own.toDF(side, f"copies_{side}", f"vector_{side}"), side)

    def decide(tables):
        for table in tables:
            if table.num_rows:
                cosines = (_unit(_matrix(table.column("vector_a"))) * _unit(_matrix(table.column("vector_b")))).sum(1)
                yield table.filter(pa.array(cosines >= least)).select(["a", "b", "copies_a", "copies_b"])

    linked = close.select("a", "b", "copies_a", "copies_b", "vector_a", "vector_b").mapInArrow(
        decide, "a long, b long, copies_a long, copies_b long"
    )
    rows = [("0", "greatest(a, b)", "least(a, b)"), ("1", "a", "copies_b"), ("1", "b", "copies_a")]
    structs = ", ".join(f"struct({kind} AS kind, {a} AS a, {b} AS b)" for kind, a, b in rows)
    return found.filter("kind < 2").union(linked.selectExpr(f"inline(array({structs}))"))


def _compared(classes: DataFrame, width: int, least: float) -> DataFrame:
    """The rows of :func:`_links` from turned vectors; (2, a, b): a and b are too close to the threshold to tell."""
    axes = principal_axes(classes, width)
    step = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-6
    leading = min(LEADING, width)

    def binned(tables):
        for table in tables:
            turned = _unit(_matrix(table.column("vector"))) @ axes
            bins = np.floor(turned[:, :leading] / step).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [table.column("class"), table.column("copies"), pa.array(list(turned), pa.list_(pa.float64())),
                 pa.array(list(bins), pa.list_(pa.int32()))],
                ["class", "copies", "turned", "bin"],
            )

    schema = "class long, copies long, turned array<double>, bin array<int>"
    rows = written(classes.select("class", "copies", "vector").mapInArrow(binned, schema), "turned")
    sizes = rows.groupBy("bin").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    sizes = written(sizes, "bins")
    # The tiles of a bin and those it meets, each pair once: the other bins are not smaller in order.
    shifts = F.array(*[F.array(*[F.lit(d // 3**k % 3 - 1) for k in range(leading)]) for d in range(3**leading)])
    near = sizes.select(F.col("bin").alias("bin_a"), F.col("tiles").alias("tiles_a"), F.explode(shifts).alias("shift"))
    near = near.withColumn("bin_b", F.zip_with("bin_a", "shift", lambda x, d: x + d)).filter(F.col("bin_b") >= F.col("bin_a"))
    near = near.join(sizes.withColumnsRenamed({"bin": "bin_b", "tiles": "tiles_b"}), "bin_b")
    pairs = near.withColumn("tile_a", F.explode(F.sequence(F.lit(0), F.col("tiles_a") - 1)))
    pairs = pairs.withColumn("tile_b", F.explode(F.sequence(F.lit(0), F.col("tiles_b") - 1)))
    pairs = pairs.filter((F.col("bin_a") != F.col("bin_b")) | (F.col("tile_b") >= F.col("tile_a")))
    pairs = pairs.select("bin_a", "tile_a", "bin_b", "tile_b")

    tile = F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int").alias("tile")
    tiled = rows.join(sizes, "bin").select("bin", tile, "class", "copies", "turned")
    # One row per tile: its vectors packed, some hundred kilobytes.
    packed = written(tiled.groupBy("bin", "tile").applyInPandas(_packed, "bin array<int>, tile int, ids binary, copies binary, vectors binary"), "tiles")
    pairs = written(pairs.withColumn("pair", F.xxhash64("bin_a", "tile_a", "bin_b", "tile_b")), "tile-pairs")
    sides = []
    for side in "ab":
        own = pairs.select("pair", F.col(f"bin_{side}").alias("bin"), F.col(f"tile_{side}").alias("tile"))
        own = own.join(packed, ["bin", "tile"])
        # Columns of their own on either side, though both come from the same tables.
        sides.append(own.select(*(F.col(c).alias(c) for c in ("pair", "ids", "copies", "vectors"))).groupBy("pair"))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        (ids_a, copies_a, x), (ids_b, copies_b, y) = (_unpacked(t.iloc[0], width) for t in (left, right))
        same = ids_a[0] == ids_b[0]
        n_a, n_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        ids = ids_a if same else np.r_[ids_a, ids_b]
        order = np.argsort(ids)  # labels are numbers in the order of the ids
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        labels = np.arange(len(ids))
        close = [(ids[:0], ids[:0])]
        for p in range(0, len(x), BLOCK):
            for q in range(p if same else 0, len(y), BLOCK):
                i, j, unsure = compare_tiles(x[p : p + BLOCK], y[q : q + BLOCK], least)
                i, j = i + p, j + q
                if same:
                    i, j, unsure = i[i < j], j[i < j], unsure[i < j]
                close.append((ids_a[i[unsure]], ids_b[j[unsure]]))
                i, j = i[~unsure], j[~unsure]
                n_a += np.bincount(i, copies_b[j], len(n_a)).astype(np.int64)
                n_b += np.bincount(j, copies_a[i], len(n_b)).astype(np.int64)
                labels = joined(labels, rank[i], rank[j if same else j + len(ids_a)])
        node = np.flatnonzero(labels != np.arange(len(ids)))
        parts = [(0, ids[order[node]], ids[order[labels[node]]]), (1, ids_a[n_a > 0], n_a[n_a > 0]), (1, ids_b[n_b > 0], n_b[n_b > 0]),
                 (2, *map(np.concatenate, zip(*close)))]
        return pd.concat([pd.DataFrame({"kind": k, "a": u, "b": v}) for k, u, v in parts])

    return sides[0].cogroup(sides[1]).applyInPandas(compare, "kind int, a long, b long")


def _unpacked(row, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, copies = (np.frombuffer(row[c], np.int64) for c in ("ids", "copies"))
    return ids, copies, np.frombuffer(row["vectors"], np.float64).reshape(-1, width)


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("class")
    return pd.DataFrame(
        {
            "bin": [rows["bin"].iloc[0]],
            "tile": [rows["tile"].iloc[0]],
            "ids": [rows["class"].to_numpy(np.int64).tobytes()],
            "copies": [rows["copies"].to_numpy(np.int64).tobytes()],
            "vectors": [np.stack(rows["turned"].to_list()).astype(np.float64).tobytes()],
        }
    )
