"""Lookups by letters against the exact test of every name."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from corpuscope.functions.text import contains_all
from corpuscope.operators import names as nm
from corpuscope.runtime import scratch_path
from corpuscope.sources.indexes import load_names, save_names

NAMES = [
    "Παπαδόπουλος Γιώργος", "ΠΑΠΑΔΟΠΟΥΛΟΥ Μαρία", "Άννα-Μαρία Ωμέγα", "Ζωή", "Ὀδυσσεύς", "Straße 7", "STRASSE 7", "Ærø", "aero",
    "Łukasz Çelik", "Celik", "José Ñandú", "jose nandu", "x", "", "李 明", "ﬁn", "fin", "ＦＩＮ", "áb", "ab c", "O'Neill, J.", "ᾳδης", "αιδης",
]
NEEDLES = [
    "παπαδοπουλ", "ΓΙΩΡΓΟΣ παπα", "μαρια", "ς", "σ", "ωή", "οδυσσευς", "strasse", "straße 7", "aero", "ærø", "l", "celik", "çElik łu",
    "jose ñ", "x", "李", "明 李", "fin", "in", "áb", "b", "o'n ll,", "", "   ", None, "zz", "αδης", "αιδ", "ß", "7",
]


@pytest.mark.parametrize("stored", [False, True])
def test_the_same_names(spark, stored):
    rows = [*enumerate(NAMES), (99, None), (100, "Celik")]
    table = spark.createDataFrame(rows, "name_id long, name string")
    index = nm.build_names(table, "name", "name_id")
    if stored:
        path = scratch_path(spark, "test-names")
        save_names(index, path, buckets=4)
        index = load_names(spark, path)
    asked = spark.createDataFrame([*enumerate(NEEDLES), (6, "fin")], "needle_id long, needle string")
    found = Counter((r.needle_id, r.name_id) for r in nm.find_names(index, asked).collect())
    wanted: Counter = Counter()
    for needle_id, needle in [*enumerate(NEEDLES), (6, "fin")]:
        exact = table.filter(contains_all(table["name"], needle or ""))
        wanted.update((needle_id, r.name_id) for r in exact.collect())
    assert found == wanted and len(wanted) > 40


def test_few_names_are_tested(spark, monkeypatch):
    rows = [(i, f"Member {i:05d}") for i in range(2000)]
    index = nm.build_names(spark.createDataFrame(rows, "name_id long, name string"), "name", "name_id")
    path = scratch_path(spark, "test-names")
    save_names(index, path, buckets=8)
    seen = {}
    original = nm.written
    monkeypatch.setattr(nm, "written", lambda df, name: seen.setdefault(name, original(df, name)))
    asked = spark.createDataFrame([(1, "mbér 01234"), (2, "1999")], "needle_id long, needle string")
    found = nm.find_names(load_names(spark, path), asked)
    assert sorted((r.needle_id, r.name_id) for r in found.collect()) == [(1, 1234), (2, 1999)]
    assert seen["possible-names"].count() <= 4


def test_lookups_read_their_buckets(spark, monkeypatch):
    index = nm.build_names(spark.createDataFrame([(i, f"n{i}") for i in range(99)], "name_id long, name string"), "name", "name_id")
    path = scratch_path(spark, "test-names")
    save_names(index, path, buckets=8)
    plans = []
    original = nm.written
    monkeypatch.setattr(nm, "written", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or original(df, name))
    nm.find_names(load_names(spark, path), spark.createDataFrame([(1, "n42")], "needle_id long, needle string"))
    assert "dynamicpruning" in plans[-1] and "In(gram, [" in plans[-1]


def test_long_texts_are_indexed_in_one_walk(spark):
    """Cutting runs out by position took time with the square of the length: minutes for this text."""
    text = "".join(chr(97 + (i * i) % 23) for i in range(400_000)) + " Ωμέγα ж ab"
    index = nm.build_names(spark.createDataFrame([(1, text)], "id long, name string"), "name", "id")
    grams = {row["gram"] for row in index.postings.collect()}
    plain = text.lower().replace("έ", "ε")
    known = [part for part in re.split("[^ -~α-ω]+", plain) if part]
    wanted = {part[at : at + n] for part in known for n in (1, 2, 3) for at in range(len(part) - n + 1)}
    assert grams == wanted | {nm.ANY, nm.ODD}
