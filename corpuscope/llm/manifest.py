"""Merkle manifest of a dataset: a tree of digests per source, a tree over the sources, SHA midstates in every parent.

A parent is the digest of its children's digests in hexadecimal, and keeps a copy of the hash state
before each of its child slots. To see what root a changed child leads to, folding takes the state
before its slot, adds the new digest and the siblings to its right, and never reads those to its left.

Trees are cut into chunks of ``WIDTH ** SPAN`` neighbours. A chunk's tree is built in one task, the tops of the
chunks are the leaves of the next layer, and so on until each tree has one node. Down again, each chunk
learns its way to the root (steps of state, slot and siblings), and its rows fold along that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuscope.llm import sha256
from corpuscope.runtime import written

WIDTH = 3
#: Levels of one chunk, which so has 2,187 leaves at most.
SPAN = 7

_NODE = "tree string, place long, total long, digest binary"
_STEP = 3 + 32 * WIDTH


@dataclass(frozen=True)
class Manifest:
    """Written tables: ``leaves`` (numbered rows), ``sources`` (layers of chunks, lowest first), ``named`` (the
    numbered sources with their subroots) and ``over`` (the layers over these)."""

    leaves: DataFrame
    sources: list[DataFrame]
    named: DataFrame
    over: list[DataFrame]
    span: int


def field(value: Column) -> Column:
    """A value as hashed: ``-`` if null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """The digest of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def tree_key(source: Column) -> Column:
    """A source as the name of its tree: no null, in the order of null first, then UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``place`` (from 0, by ``order``) and ``total`` within each ``tree``; returns a written table.

    The rows are cut into ranges, equal ones apart, and numbered in each; the sizes of the ranges give
    the first number of each. A tree of any size is so numbered by many tasks.
    """
    rows = written(rows, "unnumbered")  # ranges are found by a reading of their own
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = rows.withColumn("_any", F.monotonically_increasing_id())
    cut = apart.repartitionByRange(ranges, "tree", *order, "_any").drop("_any")
    cut = written(cut.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = cut.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        "tree", "_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    within = F.row_number().over(Window.partitionBy("tree", "_range").orderBy(*order))
    placed = cut.withColumn("_within", within).join(written(firsts, "firsts"), ["tree", "_range"])
    place = (F.col("_first") + F.col("_within") - 1).alias("place")
    return written(placed.select(*rows.columns, place, "total"), "numbered")


def depth(total: int) -> int:
    """Levels above so many leaves."""
    levels = 0
    while total > 1:
        total, levels = -(-total // WIDTH), levels + 1
    return levels


def _levels(digests: np.ndarray, levels: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each level: the children's digests, and for each child the state before its slot."""
    for _ in range(levels):
        n = digests.shape[1]
        states = np.empty((8, n), dtype=np.uint32)
        after = np.empty((8, -(-n // WIDTH)), dtype=np.uint32)
        after[:] = sha256.START
        for slot in range(WIDTH):
            own = digests[:, slot::WIDTH]
            states[:, slot::WIDTH] = after[:, : own.shape[1]]
            after[:, : own.shape[1]] = sha256.after_digests(after[:, : own.shape[1]], own)
        yield digests, states
        digests = sha256.ended(after, np.minimum(WIDTH, n - WIDTH * np.arange(after.shape[1])))
    yield digests, digests[:, :0]


def _chunk(nodes: pd.DataFrame, span: int) -> dict:
    """The chunk of some neighbours: their tree as bytes, level after level, and its top."""
    nodes = nodes.sort_values("place")
    total = int(nodes["total"].iloc[0])
    found = list(_levels(sha256.unpacked(b"".join(nodes["digest"])), min(span, depth(total))))
    return {
        "tree": nodes["tree"].iloc[0],
        "place": int(nodes["place"].iloc[0]) // WIDTH**span,
        "total": -(-total // WIDTH**span),
        "digest": sha256.packed(found[-1][0])[0],
        "size": len(nodes),
        "levels": len(found) - 1,
        "digests": b"".join(b"".join(sha256.packed(d)) for d, _ in found[:-1]),
        "states": b"".join(b"".join(sha256.packed(s)) for _, s in found[:-1]),
    }


def _stored(chunk: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The levels of a chunk as :func:`_chunk` kept them."""
    digests, states, n = sha256.unpacked(chunk["digests"]), sha256.unpacked(chunk["states"]), chunk["size"]
    at = 0
    for _ in range(chunk["levels"]):
        yield digests[:, at : at + n], states[:, at : at + n]
        at, n = at + n, -(-n // WIDTH)


def layers(nodes: DataFrame, span: int) -> list[DataFrame]:
    """The chunks over ``tree, place, total, digest``, layer by layer until every tree has one node."""
    found = []
    while True:
        keyed = nodes.select("tree", "place", "total", "digest").groupBy("tree", F.floor(F.col("place") / WIDTH**span).alias("_chunk"))
        chunks = keyed.applyInPandas(
            lambda group: pd.DataFrame([_chunk(group, span)]), f"{_NODE}, size int, levels int, digests binary, states binary"
        )
        chunks = written(chunks, "chunks")
        found.append(chunks)
        nodes = chunks.filter("total > 1")
        if nodes.isEmpty():
            return found


def build(rows: DataFrame, order: list[str], span: int = SPAN) -> Manifest:
    """The manifest of rows with ``tree`` (see :func:`tree_key`) and ``digest``; ``order`` names further columns.

    In each tree leaves ascend by ``order``, equal ones by digest; nulls come first. Equal rows are a leaf each.
    """
    leaves = numbered(rows, [*order, "digest"])
    sources = layers(leaves, span)
    tops = [layer.filter("total = 1").select("tree", "digest") for layer in sources]
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    named = numbered(roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), ["source"])
    return Manifest(leaves, sources, named, layers(named, span), span)


def _steps(chunk: dict, at: int) -> bytes:
    """The way of one leaf of a chunk to its top: of each level width, slot, state before the slot, siblings."""
    out = []
    for digests, states in _stored(chunk):
        first = at - at % WIDTH
        run = sha256.packed(digests[:, first : first + WIDTH])
        slot = at - first
        state = sha256.packed(states[:, at : at + 1])[0]
        others = b"".join(run[:slot] + run[slot + 1 :])
        out.append(bytes([len(run), slot, 0]) + state + others.ljust(32 * (WIDTH - 1), b"\0"))
        at //= WIDTH
    return b"".join(out)


def _ways(layer: DataFrame, upward: DataFrame, span: int) -> DataFrame:
    """``tree, place, way, subroot, root`` of each child of a layer's chunks, whose own ways are ``upward``."""

    def walk(frames):
        for frame in frames:
            for chunk in frame.to_dict("records"):
                first = chunk["place"] * WIDTH**span
                yield pd.DataFrame({
                    "tree": chunk["tree"],
                    "place": [first + i for i in range(chunk["size"])],
                    "way": [_steps(chunk, i) + chunk["way"] for i in range(chunk["size"])],
                    "subroot": chunk["subroot"], "root": chunk["root"],
                })

    known = layer.select("tree", "place", "size", "levels", "digests", "states").join(upward, ["tree", "place"])
    return known.mapInPandas(walk, "tree string, place long, way binary, subroot binary, root binary")


def ways(manifest: Manifest) -> DataFrame:
    """``tree, place, way, subroot, root`` of every lowest chunk, from its top to the root."""
    top = manifest.over[-1].filter("total = 1")
    upward = top.select("tree", "place", F.unhex(F.lit("")).alias("way"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    for layer in reversed(manifest.over):
        upward = _ways(layer, written(upward, "ways"), manifest.span)
    sources = written(
        upward.join(manifest.named.select("place", "source", "digest"), "place").select(
            F.col("source").alias("tree"), F.lit(0).cast("long").alias("place"), "way", F.col("digest").alias("subroot"), "root"
        ),
        "source-ways",
    )
    # A tree begins in the layer where it has one chunk; above that it has none.
    upward = sources.limit(0)
    for i in reversed(range(len(manifest.sources))):
        own = manifest.sources[i].filter("total = 1").select("tree", "place").join(sources, ["tree", "place"])
        upward = written(own.unionByName(upward), "ways")
        if i:
            upward = _ways(manifest.sources[i], upward, manifest.span)
    return upward


def _fold_chunk(chunk: dict, rows: pd.DataFrame, first_place: int) -> pd.DataFrame:
    """Fold every row's replacement to the root, and hash the siblings passed, level by level."""
    n = len(rows)
    at = (rows["place"] - first_place).to_numpy()
    value = sha256.unpacked(b"".join(rows["replacement"]))
    proof, passed = np.repeat(sha256.START, n, axis=1), np.zeros(n, dtype=np.int64)
    for digests, states in _stored(chunk):
        first = at - at % WIDTH
        width = np.minimum(WIDTH, digests.shape[1] - first)
        folded = sha256.after_digests(states[:, at], value)
        for slot in range(WIDTH):
            there = slot < width
            other, right = there & (first + slot != at), there & (first + slot > at)
            proof[:, other] = sha256.after_digests(proof[:, other], digests[:, first[other] + slot])
            folded[:, right] = sha256.after_digests(folded[:, right], digests[:, first[right] + slot])
            passed += other
        value, at = sha256.ended(folded, width), at // WIDTH
    way = chunk["way"]
    for step in range(0, len(way), _STEP):
        width, slot = way[step], way[step + 1]
        known = sha256.unpacked(way[step + 3 : step + 3 + 32 * width])
        folded = sha256.after_digests(known[:, :1], value)
        for other in range(1, width):
            proof = sha256.after_digests(proof, known[:, other : other + 1])
            if other > slot:
                folded = sha256.after_digests(folded, known[:, other : other + 1])
        passed += width - 1
        value = sha256.ended(folded, np.full(n, width))
    out = rows.drop(columns=["tree", "place", "replacement"])
    return out.assign(
        subroot=chunk["subroot"], root=chunk["root"],
        proof=sha256.packed(sha256.ended(proof, passed)), folded_root=sha256.packed(value),
    )


def fold(manifest: Manifest, replacement: Column, kept: dict[str, str]) -> DataFrame:
    """For every leaf the columns ``kept`` (name and type) and ``subroot, root, proof, folded_root`` (32 bytes each).

    ``folded_root`` is the root if the leaf were ``replacement`` (null: the leaf itself); ``proof`` the digest of all
    siblings on its way, each run's from left to right.
    """
    chunks = manifest.sources[0].drop("total", "digest").join(ways(manifest), ["tree", "place"])
    each = WIDTH**manifest.span
    place = F.floor(F.col("place") / each)
    rows = manifest.leaves.select(*kept, "tree", "place", F.coalesce(replacement, "digest").alias("replacement"), place.alias("_chunk"))

    def together(rows: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        found = chunk.iloc[0].to_dict()
        return _fold_chunk(found, rows.drop(columns="_chunk"), found["place"] * each)

    kinds = [f"{name} {kind}" for name, kind in kept.items()]
    schema = ", ".join([*kinds, *(f"{name} binary" for name in ("subroot", "root", "proof", "folded_root"))])
    return rows.groupBy("tree", "_chunk").cogroup(chunks.groupBy("tree", "place")).applyInPandas(together, schema)
