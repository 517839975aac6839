"""The manifest against a tree made with hashlib, level by level."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscope.llm import manifest, sha256
from corpuscope.llm.queries import op11_merkle_manifest


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def shown(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grown(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def passed(levels: list[list[str]], at: int, value: str) -> tuple[list[str], str]:
    """Siblings on the way up, and where a changed node leads."""
    siblings = []
    for level in levels[:-1]:
        first = at - at % 3
        left, right = level[first:at], level[at + 1 : first + 3]
        siblings += left + right
        value, at = h(*left, value, *right), at // 3
    return siblings, value


def expected(rows: list[tuple]) -> list[tuple]:
    """Of rows (doc_id, source, leaf, changed leaf or None) everything the manifest says."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[s] = own, grown([r[2] for r in own])
    over = grown([trees[s][1][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        own, levels = trees[s]
        for at, (doc_id, _, leaf, changed) in enumerate(own):
            low, value = passed(levels, at, changed or leaf)
            high, value = passed(over, i, value)
            out.append((doc_id, leaf, levels[-1][0], over[-1][0], h(*low, *high), value))
    return out


def built(spark, rows: list[tuple], span: int) -> list[tuple]:
    """``rows`` hold doc_id, source, text, and whether the text is changed."""
    table = spark.createDataFrame(rows, "doc_id long, source string, text string, tampered boolean, place string, total string")
    leaf = manifest.leaf_digest(F.col("doc_id"), F.col("source"), F.col("text"))
    changed = F.when(F.col("tampered"), manifest.leaf_digest(F.col("doc_id"), F.col("source"), F.lit("!")))
    tree = manifest.tree_key(F.col("source"))
    leaves = table.select("doc_id", tree.alias("tree"), leaf.alias("digest"), changed.alias("changed"))
    found = manifest.fold(manifest.build(leaves, ["doc_id"], span), F.col("changed"), {"doc_id": "long", "digest": "binary"})
    names = ["digest", "subroot", "root", "proof", "folded_root"]
    return [(r.doc_id, *(r[n].hex() for n in names)) for r in found.collect()]


def key(row: tuple) -> tuple:
    return (row[0] is not None, row[0] or 0, *row[1:])


@pytest.mark.parametrize("span", [1, 2, 7])
def test_trees(spark, span):
    rows = [(i, "hot", f"text {i}", i % 2 == 0, "a", "b") for i in range(100)]
    rows += [(i, ["one", "é", "e", None, ""][i % 5], [None, "", "long " * 90_000, "ü\n"][i % 4], i % 3 == 0, "a", "b") for i in range(100, 143)]
    rows += [(None, "one", "x", False, "a", "b"), (None, "one", "x", False, "a", "b"), (None, None, None, True, "a", "b"), (7, "lone", "z", True, "a", "b")]
    rows += [(5, "hot", "same", False, "a", "b")] * 4  # repeated rows are a leaf each
    leaves = [
        (i, s, h(shown(i), shown(s), shown(t)), h(shown(i), shown(s), shown("!")) if changed else None)
        for i, s, t, changed, *_ in rows
    ]
    found = sorted(built(spark, rows, span), key=key)
    assert found == sorted(expected(leaves), key=key)
    assert any(r[5] != r[3] for r in found) and any(r[5] == r[3] for r in found)


def test_one_leaf_and_none(spark):
    rows = [(1, "a", "x", False, "", "")]
    leaf = h(shown(1), shown("a"), shown("x"))
    assert built(spark, rows, 7) == [(1, leaf, leaf, leaf, h(""), leaf)]
    assert built(spark, [], 7) == []


def test_states_resume():
    rng = np.random.default_rng(0)
    digests = [rng.bytes(32) for _ in range(40)]
    words, state = sha256.unpacked(b"".join(digests)), sha256.START
    for blocks in range(4):
        message = "".join(d.hex() for d in digests[:blocks])
        assert sha256.packed(sha256.ended(state, np.array([blocks]))) == [hashlib.sha256(message.encode()).digest()]
        state = sha256.after_digests(state, words[:, blocks : blocks + 1])
        state = sha256.unpacked(sha256.packed(state)[0])  # a state can be stored
    assert sha256.packed(words) == digests


def test_folding_reads_no_left_sibling():
    digests = sha256.unpacked(b"".join(hashlib.sha256(bytes([i])).digest() for i in range(9)))
    levels = list(manifest._levels(digests, 2))
    # Leaves 2 and 8 are the last of their runs: the state before their slot stands for all the others.
    state = sha256.after_digests(levels[0][1][:, [2, 8]], digests[:, [2, 8]])
    assert (sha256.ended(state, np.array([3, 3])) == levels[1][0][:, [0, 2]]).all()


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    leaves = []
    for r in docs:
        known = "".join(map(shown, (r.doc_id, r.source, r.lang, r.n_chars)))
        even = zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        leaves.append((r.doc_id, r.source, h(known, shown(r.text)), h(known, shown(r.text.replace("\n", ""))) if even else None))
    found = op11_merkle_manifest(spark, sf_dir).collect()
    assert sorted(r[:6] for r in found) == sorted(expected(leaves))
    assert all(r.verified == (r.folded_root == r.root) for r in found) and not all(r.verified for r in found)
