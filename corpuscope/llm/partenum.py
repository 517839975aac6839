"""Exact Jaccard join of shingle sets by partition-and-enumerate signatures.

Sets are put in bands of similar size. For two sets of a band (or of neighbouring bands) with a Jaccard
similarity over the threshold, the number of shingles in only one of them is at most k, which follows
from the band. The domain of shingles is hashed into more than k / 2 partitions, so one of them holds
at most one such shingle; that partition is hashed into three parts, so two of the parts are equal in
both sets. Every set therefore has as signatures, for each partition, the three ways to leave out one
part, and similar sets share at least one signature. Small sets take more than k / 3 partitions and
the fifteen ways to leave out two of six parts: each signature covers more of the set, so that a
passage in many short texts makes few equal ones. Candidates are verified on whole sets.

- Equal sets are one class before anything is compared; within a task they make signatures once.
- Parts that are empty in many sets would share meaningless signatures. A few spare partitions allow
  leaving those out: if no more partitions of a set are sparse than there are spare ones, one with
  contents still agrees. Other sets keep them, so no pair is lost.
- Of the sets that share a signature, each is compared with two leaders only. Where such a group is
  left in several components, pairs from different components are checked as well if they also share
  one of their rarest shingles, as similar sets must (the prefix filter), and if neither their sizes
  nor the place of that shingle nor the distance of their histograms rules them out. Components are therefore those of all links,
  though copies are never expanded into all pairs.
- Before texts are read, pairs of large sets are compared by histograms whose bins grow with the set.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpuscope.llm.components import components
from corpuscope.llm.shingles import digest, mix, shingle_set
from corpuscope.runtime import written

#: Parts of a partition and how many are left out: for sets of a band up to SMALL, and for larger ones.
SMALL, SMALL_PARTS, LARGE_PARTS = 220, (6, 2), (3, 1)
SKETCH = 128
#: Shingles for each bin of the finer histogram of a set that fills the plain one with more than this.
FINER = 4
#: Cells in which shingles of undecided sets are counted, to tell rare from frequent ones.
CELLS = 1 << 20
#: Bits of the map by which texts are picked before a join.
BITMAP = 1 << 23
_BATCH = 2_000
_RUN_PART = 4_096
#: Numbers of pairs and groups that a task holds before it passes them on.
_HELD = 6_000_000
#: Buckets of signatures that a task reads one after the other.
_BUCKETS_EACH = 2
_STAR_PART = 64
_BLOCK = 1_000
_SIGNATURE_BYTES = 5
_STEP = math.log(1.06)


class Bands:
    """Size bands for sets that are similar at ``percent`` / 100 or more."""

    def __init__(self, percent: int) -> None:
        self.percent, self.first, self.last = percent, [1], [1]

    def _reach(self, size: int) -> int:
        """The largest set that a set of this size can be similar to."""
        return 100 * size // self.percent

    def of(self, size: int) -> int:
        """The band of a size."""
        while self.last[-1] < size:
            self.first.append(self.last[-1] + 1)
            self.last.append(max(self.first[-1], self._reach(self.first[-1])))
        return int(np.searchsorted(self.last, size))

    def tags(self, size: int) -> list[int]:
        """The bands under which a set of this size can meet a partner: its own, and the one below."""
        own = self.of(size)
        below = own > 0 and size <= self._reach(self.last[own - 1])
        return [own - 1, own] if below else [own]

    def distance(self, tag: int) -> int:
        """The most shingles that two similar sets, the smaller of this band, do not share."""
        top = self.last[tag]
        return (100 - self.percent) * (top + self._reach(top)) // (100 + self.percent)


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """All signatures of a set; none under a tag that only equal sets could share."""
    out = []
    for tag in bands.tags(len(shingles)):
        k = bands.distance(tag)
        if not k:
            continue
        parts, without = SMALL_PARTS if bands.last[tag] <= SMALL else LARGE_PARTS
        least = k // (without + 1) + 1
        spare = least // 10 + 1
        n = least + spare
        seeded = mix(shingles ^ np.uint64((tag + 1) * 0x9E3779B97F4A7C15 % 2**64))
        cell = (seeded % np.uint64(n * parts)).astype(np.int64)  # partition and part at once
        sums = np.zeros(n * parts, np.uint64)
        np.add.at(sums, cell, mix(seeded + np.uint64(0x632BE59BD9B4E019)))
        sizes = np.bincount(cell, minlength=n * parts).reshape(n, parts)
        sums = sums.reshape(n, parts)
        left_out = np.array(list(combinations(range(parts), without)))
        kept = sizes.sum(1, keepdims=True) - sizes[:, left_out].sum(2)  # shingles in what is left
        rest = sums.sum(1, keepdims=True, dtype=np.uint64) - sums[:, left_out].sum(2, dtype=np.uint64)
        place = np.arange(kept.size, dtype=np.uint64).reshape(kept.shape) + np.uint64((tag + 1) << 32)
        value = mix(mix(place) + mix(rest))
        if ((kept == 0).any(1)).sum() <= spare:
            value = value[kept > 0]
        out.append(value.ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray) -> bytes:
    """A histogram whose distance is at most that of the sets: shingles by hash, 255 at most each."""
    return _histogram(shingles, SKETCH)


def finer(shingles: np.ndarray) -> bytes | None:
    """A histogram with a bin for every two to ``FINER`` shingles, their number a power of two; none if that is the plain one.

    In a fixed number of bins the differences of large sets cancel out; these grow with the set, to a few per cent of its text.
    """
    bins = 1 << max(0, -(-len(shingles) // FINER) - 1).bit_length()
    return _histogram(shingles, bins) if bins > SKETCH else None


def _histogram(shingles: np.ndarray, bins: int) -> bytes:
    return np.minimum(np.bincount((shingles % np.uint64(bins)).astype(np.int64), minlength=bins), 255).astype(np.uint8).tobytes()


def histogram_distance(x: bytes, y: bytes) -> int:
    """Of two histograms, the one with more bins folded to those of the other; at most the distance of the sets."""
    x, y = (np.frombuffer(own, np.uint8) for own in (x, y))
    bins = min(len(x), len(y))
    x, y = (own.reshape(-1, bins).sum(0, dtype=np.int64) for own in (x, y))
    return int(np.abs(x - y).sum())


def _digests(words: int):
    def run(tables):
        for table in tables:
            sets = [shingle_set(t, words) for t in table.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                    pa.array([finer(s) for s in sets], pa.binary()),
                ],
                ["id", "n", "digest", "sketch", "finer"],
            )

    return run


def _size_code(size: int) -> int:
    """A size to within 6 %, in a byte; sizes above some millions share the last code."""
    return min(255, int(math.log(size) / _STEP))


def _may_be_close(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes with these codes can be within ``percent`` / 100 of one another."""
    apart = np.abs(x.astype(np.int64) - y)
    return (apart - 1) * _STEP <= math.log(100 / percent) + 1e-9


def _counts(counts: np.ndarray) -> bytes:
    """Numbers in one byte each if they are below 256, else in four."""
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def _signature_rows(words: int, percent: int, buckets: int):
    """Signatures by bucket, packed: ids of sets, how many signatures each has there, and these."""

    def run(tables):
        bands = Bands(percent)

        def rows(sets: dict[bytes, tuple[int, np.ndarray]]):
            mine = sorted(sets.values(), key=lambda own: own[0])
            ids = np.array([i for i, _ in mine], np.int64)
            wide = len(ids) > 1 and int(ids[-1]) - int(ids[0]) >= 1 << 32
            offsets = ids - ids[0]
            if not wide:
                offsets = offsets.astype(np.uint32)
            lengths = np.array([_size_code(len(s)) for _, s in mine], np.uint8)
            each = [signatures(s, bands) for _, s in mine]
            values = np.concatenate(each) if each else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(len(ids)), [len(e) for e in each])
            bucket = (values >> np.uint64(40)) % np.uint64(buckets)
            order = np.lexsort((owner, bucket))
            bucket, owner, values = bucket[order], owner[order], values[order]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
            made = defaultdict(list)
            for i, a in enumerate(cuts):
                b = cuts[i + 1] if i + 1 < len(cuts) else len(bucket)
                own, counts = np.unique(owner[a:b], return_counts=True)
                made["bucket"].append(int(bucket[a]))
                made["least"].append(int(ids[0]))
                made["ids"].append(offsets[own].tobytes())
                made["sizes"].append(lengths[own].tobytes())
                made["counts"].append(_counts(counts))
                raw = np.ascontiguousarray(values[a:b]).view(np.uint8).reshape(-1, 8)
                made["values"].append(np.ascontiguousarray(raw[:, :_SIGNATURE_BYTES]).tobytes())
            kinds = [("bucket", pa.int32()), ("least", pa.int64()), *((c, pa.binary()) for c in ("ids", "sizes", "counts", "values"))]
            return pa.RecordBatch.from_arrays([pa.array(made[n], t) for n, t in kinds], [n for n, _ in kinds])

        sets: dict[bytes, tuple[int, np.ndarray]] = {}
        shingles = 0
        for table in tables:
            for key, text in zip(table.column("id").to_pylist(), table.column("text").to_pylist()):
                found = shingle_set(text, words)
                name = digest(found)
                if len(found) and (name not in sets or sets[name][0] > key):
                    sets[name] = (key, found)  # of equal sets the smallest id
                    shingles += len(found)
                if len(sets) >= _BATCH or shingles > 4_000_000:
                    yield rows(sets)
                    sets, shingles = {}, 0
        if sets:
            yield rows(sets)

    return run


def _shared_signatures(percent: int, targets: int):
    """Pairs (leader, member) of the sets that share a signature, and the larger groups themselves.

    A task reads its buckets one after the other. Pairs and groups found in several of them are kept once, and leave packed
    by the task that will drop those which other tasks have found as well: kind 0, pairs ``a, b, size of the group``, unless
    the sizes of the sets rule them out; kind 1, parts of groups ``name, part, size, members ...``.
    """

    def run(tables):
        at, parts = None, []
        pairs, groups, held = [], {}, 0
        for bucket, least, ids, sizes, counts, values in _rows_of(tables, "bucket", "least", "ids", "sizes", "counts", "values"):
            if bucket != at and parts:
                held += _collect(_groups(*(np.concatenate(x) for x in zip(*parts)), percent), pairs, groups)
                parts = []
            if held > _HELD:
                yield from _packed(pairs, groups, targets)
                pairs, groups, held = [], {}, 0
            at = bucket
            raw = np.frombuffer(values, np.uint8).reshape(-1, _SIGNATURE_BYTES)
            full = np.zeros((len(raw), 8), np.uint8)
            full[:, :_SIGNATURE_BYTES] = raw
            # Ids and counts are as wide as the row needs; there is one code of a size for each.
            own = np.frombuffer(ids, np.uint32 if len(ids) == 4 * len(sizes) else np.int64).astype(np.int64) + least
            times = np.frombuffer(counts, np.uint8 if len(counts) == len(sizes) else np.uint32)
            owners, lengths = np.repeat(own, times), np.repeat(np.frombuffer(sizes, np.uint8), times)
            parts.append((full.view(np.uint64).ravel(), owners, lengths))
        if parts:
            _collect(_groups(*(np.concatenate(x) for x in zip(*parts)), percent), pairs, groups)
        yield from _packed(pairs, groups, targets)

    return run


def _rows_of(tables, *names: str):
    for table in tables:
        yield from zip(*(table.column(n).to_pylist() for n in names))


def _collect(found, pairs: list, groups: dict) -> int:
    """Add what one bucket gave; returns about how many numbers that are."""
    if found is None:
        return 0
    near, large = found
    pairs.append(near)
    more = 0
    for name, part, size, members in large:
        if (name, part) not in groups:
            groups[name, part] = (size, members)
            more += len(members) + 3
    return near.size + more


def _once(pairs: list) -> np.ndarray:
    """Rows ``a, b, size``, each pair once with the largest size of its groups."""
    rows = np.concatenate(pairs) if pairs else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((-rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]] if len(rows) else rows


def _packed(pairs: list, groups: dict, targets: int):
    out = []
    rows = _once(pairs)
    target = (mix(rows[:, 0].copy().view(np.uint64) ^ mix(rows[:, 1].copy().view(np.uint64))) % np.uint64(targets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    rows, target = rows[order], target[order]
    cuts = np.flatnonzero(np.r_[True, target[1:] != target[:-1], True]) if len(rows) else []
    out += [(int(target[a]), 0, rows[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
    mine = defaultdict(list)
    for (name, part), (size, members) in groups.items():
        place = int(mix(np.array([name + part], np.int64).view(np.uint64))[0] % np.uint64(targets))
        mine[place] += [np.array([name, part, size, len(members)], np.int64), members]
    out += [(place, 1, np.concatenate(own).tobytes()) for place, own in mine.items()]
    for a in range(0, len(out), 256):
        chunk = list(zip(*out[a : a + 256]))
        types = (pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(chunk, types)], ["target", "kind", "packed"])


def _met_once(tables):
    """Unpack pairs and groups and keep each once: rows ``kind, a, b, size, members``."""
    pairs, names = [], set()
    for kind, packed in _rows_of(tables, "kind", "packed"):
        numbers = np.frombuffer(packed, np.int64)
        if kind == 0:
            pairs.append(numbers.reshape(-1, 3))
            if sum(map(len, pairs)) > _HELD:
                pairs = [_once(pairs)]
            continue
        new, at = [], 0
        while at < len(numbers):
            name, part, size, n = numbers[at : at + 4].tolist()
            if (name, part) not in names:
                names.add((name, part))
                new.append((name, part, size, numbers[at + 4 : at + 4 + n]))
            at += 4 + n
        if new:
            yield _rows(1, *zip(*new))
    rows = _once(pairs)
    for a in range(0, len(rows), 100_000):
        own = rows[a : a + 100_000]
        yield _rows(0, own[:, 0], own[:, 1], own[:, 2], [None] * len(own))


def _groups(values: np.ndarray, owners: np.ndarray, lengths: np.ndarray, percent: int):
    """Of one bucket: rows ``a, b, size`` of pairs, and parts ``name, part, size, members`` of groups."""
    order = np.lexsort((owners, values))
    values, owners, lengths = values[order], owners[order], lengths[order].astype(np.int64)
    new = np.r_[True, (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])]
    values, owners, lengths = values[new], owners[new], lengths[new]
    begins = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    sizes = np.diff(np.r_[begins, len(values)])
    shared = np.repeat(sizes > 1, sizes)
    values, owners, lengths = values[shared], owners[shared], lengths[shared]
    sizes = sizes[sizes > 1]
    if not len(sizes):
        return None
    begins = np.r_[0, np.cumsum(sizes)[:-1]]
    group = np.repeat(np.arange(len(sizes)), sizes)
    # The first leader is the smallest id, the second the smallest by one of two hashes.
    turn = mix(owners.view(np.uint64) + (values[begins] % np.uint64(2))[group] * np.uint64(0x9E3779B97F4A7C15))
    leaders = np.concatenate([begins[group], np.lexsort((turn, group))[begins][group]])
    member = np.concatenate([np.arange(len(owners))] * 2)
    a, b, m = owners[leaders], owners[member], np.concatenate([sizes[group]] * 2)
    close = (a != b) & _may_be_close(lengths[leaders], lengths[member], percent)
    a, b, m = a[close], b[close], m[close]
    pairs = _once([np.column_stack([a, b, m])])
    # Groups with the same members count once.
    large = np.flatnonzero(sizes > 2)
    names = np.add.reduceat(mix(owners.view(np.uint64)), begins).view(np.int64)
    _, first = np.unique(names[large], return_index=True)
    parts = []
    for i in large[first]:
        for p in range(0, sizes[i], _RUN_PART):
            members = owners[begins[i] + p : begins[i] + min(sizes[i], p + _RUN_PART)]
            parts.append((int(names[i]), p // _RUN_PART, int(sizes[i]), members))
    return pairs, parts


def _rows(kind: int, a, b, m, members) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(a), pa.int32()), *(pa.array(x, pa.int64()) for x in (a, b, m)), pa.array(members, pa.list_(pa.int64()))],
        ["kind", "a", "b", "size", "members"],
    )


def _with_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts whose ids may be among ``ids``, so that a join shuffles few others.

    A bitmap of fixed size (a megabyte) by the hash of the id; the more ids, the more texts pass.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(BITMAP))
    words = ids.select(place.alias("place")).selectExpr("CAST(place DIV 64 AS INT) AS word", "shiftleft(1L, CAST(place % 64 AS INT)) AS bit")
    bitmap = np.zeros(BITMAP // 64, np.int64)
    for word, bits in words.groupBy("word").agg(F.bit_or("bit")).collect():
        bitmap[word] = bits

    @F.pandas_udf("boolean")
    def may_be(places: pd.Series) -> pd.Series:
        places = places.to_numpy()
        return pd.Series((bitmap[places // 64] >> (places % 64)) & 1 == 1)

    return texts.filter(may_be(place))


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b, size)`` of classes that neither sizes nor histograms rule out, before a text is read."""
    pairs = written(pairs.groupBy("a", "b").agg(F.max("size").alias("size")), "met")
    own = classes.select("class", "n", "sketch")
    pairs = pairs.join(own.toDF("a", "n_a", "sketch_a"), "a").join(own.toDF("b", "n_b", "sketch_b"), "b")

    def close(tables):
        for table in tables:
            x, y = (table.column(c).to_numpy() for c in ("n_a", "n_b"))
            bins = [np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH) for c in ("sketch_a", "sketch_b")]
            far = (np.maximum(*bins) - np.minimum(*bins)).sum(1, dtype=np.int64)
            ok = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
            ok &= far * (100 + percent) <= (100 - percent) * (x + y)
            yield table.select(["a", "b", "size"]).filter(pa.array(ok))

    return pairs.mapInArrow(close, "a long, b long, size long")


def _near_in_detail(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b, size)`` that the finer histograms of large sets do not rule out either.

    A pair with a set that has none stays; where an id has several sets, any two of them may keep the pair.
    """
    own = sets.select("id", "n", "finer")
    # Merged at every size, as the histograms grow with the texts; the shorter rows meet a leader's first.
    rows = pairs.join(own.toDF("a", "n_a", "finer_a").hint("merge"), "a").join(own.toDF("b", "n_b", "finer_b").hint("merge"), "b")

    def close(tables):
        for table in tables:
            columns = [table.column(c).to_pylist() for c in ("n_a", "n_b", "finer_a", "finer_b")]
            ok = [
                x is None or y is None or histogram_distance(x, y) * (100 + percent) <= (100 - percent) * (n + m)
                for n, m, x, y in zip(*columns)
            ]
            yield table.select(["a", "b", "size"]).filter(pa.array(ok, pa.bool_()))

    return rows.mapInArrow(close, "a long, b long, size long")


def verified(pairs: DataFrame, texts: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b, size)`` whose sets are similar enough, read from whole texts.

    ``sets`` has the histograms by which pairs are ruled out before that. A leader's partners are dealt over parts of some dozens, each with a copy of the leader, and a
    task reads one set at a time.
    """
    spread = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("size") / _STAR_PART)).cast("long")
    pairs = written(pairs.groupBy("a", "b").agg(F.max("size").alias("size")), "pairs")
    pairs = _near_in_detail(pairs, sets, percent).groupBy("a", "b").agg(F.max("size").alias("size"))
    pairs = written(pairs.withColumn("part", part), "near-pairs")
    wanted = pairs.select("a", "part", F.col("a").alias("id"), F.lit(0).alias("role")).distinct()
    wanted = wanted.union(pairs.select("a", "part", F.col("b").alias("id"), F.lit(1).alias("role")))
    wanted = written(wanted, "compared")
    # Merged at every size: a table that fits a broadcast today would make another plan tomorrow.
    rows = wanted.join(_with_ids(texts, wanted).hint("merge"), "id")
    rows = rows.repartition(spread, "a", "part").sortWithinPartitions("a", "part", "role", "id")

    def compare(tables):
        at, leader = None, None
        for table in tables:
            found = []
            columns = [table.column(c).to_pylist() for c in ("a", "part", "role", "id", "text")]
            for a, p, role, key, text in zip(*columns):
                own = shingle_set(text, words)
                if role == 0:
                    at, leader = (a, p), own
                    continue
                assert at == (a, p), "a leader comes before its partners"
                both = len(np.intersect1d(leader, own, assume_unique=True))
                if len(own) and 100 * both >= percent * (len(leader) + len(own) - both):
                    found.append((a, key))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.select("a", "part", "role", "id", "text").mapInArrow(compare, "a long, b long")


def _left_over(groups: DataFrame, members: DataFrame, found: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs from different components among the sets of groups that are left in several of them.

    Similar sets share one of the first ``n - ceil(n * percent / 100) + 1`` shingles of each, in any
    order that is the same for all; this one puts rare shingles first. ``members`` has one row per
    class of equal sets.
    """
    comps = found.select(F.col("node").alias("class"), "component")
    classes = members.join(comps, "class", "left").withColumn("component", F.coalesce("component", "class"))
    classes = written(classes.select("class", "n", "sketch", "component"), "group-classes")
    rows = groups.select(F.col("a").alias("run"), F.explode("members").alias("id"))
    rows = written(rows.join(classes.select(F.col("class").alias("id"), "component"), "id"), "group-rows")
    mixed = rows.groupBy("run").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    undecided = written(rows.join(written(mixed.select("run"), "mixed-groups"), "run").select("id").distinct(), "undecided-ids")
    undecided = undecided.join(_with_ids(texts, undecided).hint("merge"), "id").dropDuplicates(["id"])
    undecided = written(undecided, "undecided")

    def count(tables):
        total = np.zeros(CELLS, np.int64)
        for table in tables:
            for text in table.column("text").to_pylist():
                np.add.at(total, (shingle_set(text, words) % np.uint64(CELLS)).astype(np.int64), 1)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(total[cells], pa.int64())], ["cell", "n"])

    cells = written(undecided.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")), "cells")
    mean = cells.agg(F.sum("n")).first()[0] or 0
    # Which cells are frequent: a bounded number, as all counts add up to CELLS times the mean.
    often = dict(cells.filter(F.col("n") >= 8 + 4 * mean / CELLS).collect())

    def prefixes(tables):
        rank = np.zeros(CELLS, np.int64)
        rank[list(often)] = list(often.values())
        for table in tables:
            firsts, owners, places = [], [], []
            for key, text in zip(table.column("id").to_pylist(), table.column("text").to_pylist()):
                own = shingle_set(text, words)
                order = np.lexsort((own, rank[(own % np.uint64(CELLS)).astype(np.int64)]))
                first = own[order[: len(own) - -(-len(own) * percent // 100) + 1]]
                firsts.append(first.view(np.int64))
                owners.append(np.full(len(first), key))
                places.append(np.arange(len(first)))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (firsts, owners, places)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in flat], ["shingle", "class", "place"])

    rows = undecided.select("id", "text").mapInArrow(prefixes, "shingle long, class long, place long")
    # Histograms only go to the shingles that are in several components.
    rows = written(rows.join(classes.drop("sketch"), "class"), "prefixes")
    mixed = rows.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"))
    mixed = mixed.filter("x < y").select("shingle", F.ceil(F.col("size") / _BLOCK).cast("int").alias("blocks"))
    rows = written(rows.join(written(mixed, "mixed-shingles"), "shingle"), "mixed-prefixes")
    rows = rows.join(classes.select("class", "sketch"), "class")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    spread = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = rows.select("shingle", "lo", "hi", "class", "place", "n", "component", "sketch", "block")
    picked = picked.repartition(spread, "shingle", "lo", "hi").sortWithinPartitions("shingle", "lo", "hi", "class")
    pairs = picked.mapInPandas(lambda tables: _by_key(tables, percent), "a long, b long").distinct()
    return pairs.withColumn("size", F.lit(_STAR_PART).cast("long"))


def _by_key(tables, percent: int):
    """Pairs within each run of rows of one key; the last run of a batch waits for the next batch."""
    keys, waiting = ["shingle", "lo", "hi"], []
    for table in tables:
        if not len(table):
            continue
        table = pd.concat([*waiting, table])
        last = (table[keys] == table[keys].iloc[-1]).all(axis=1).to_numpy()
        done, waiting = table[~last], [table[last]]
        if len(done):
            yield _pairs_of(done, keys, percent)
    if waiting:
        yield _pairs_of(waiting[0], keys, percent)


def _pairs_of(rows: pd.DataFrame, keys: list[str], percent: int) -> pd.DataFrame:
    """Pairs of one block (or of two) that sizes, places and histograms do not rule out.

    If this is the first shingle in order that two sets share, they share at most what follows it
    in either; a similar pair therefore stays at its first shared shingle. The rows of a key stand together; each
    is paired with those behind it, some 100,000 pairs at a time.
    """
    names, n, comp, block, place = (rows[c].to_numpy() for c in ("class", "n", "component", "block", "place"))
    rest, two = n - place, (rows["lo"] != rows["hi"]).to_numpy()
    bins = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(-1, SKETCH)
    values = rows[keys].to_numpy()
    ends = np.flatnonzero(np.r_[(values[1:] != values[:-1]).any(1), True]) + 1
    behind = np.repeat(ends, np.diff(np.r_[0, ends])) - np.arange(len(rows)) - 1
    passed = np.r_[0, np.cumsum(behind)]
    found, start = [np.zeros((0, 2), np.int64)], 0
    while start < len(rows):
        stop = max(start + 1, int(np.searchsorted(passed, passed[start] + 100_000, side="right")) - 1)
        first = np.repeat(np.arange(start, stop), behind[start:stop])
        second = first + 1 + np.arange(len(first)) - (passed[first] - passed[start])
        x, y = n[first], n[second]
        ok = (comp[first] != comp[second]) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
        ok &= (100 + percent) * np.minimum(rest[first], rest[second]) >= percent * (x + y)
        ok &= ~two[first] | (block[first] != block[second])
        first, second, total = first[ok], second[ok], (x + y)[ok]
        low, high = np.minimum(bins[first], bins[second]), np.maximum(bins[first], bins[second])
        near = (high - low).sum(1, dtype=np.int64) * (100 + percent) <= (100 - percent) * total
        found.append(np.column_stack([names[first[near]], names[second[near]]]))
        start = stop
    pairs = np.unique(np.concatenate(found), axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def jaccard_components(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Rows with their component, and the links between different sets that were verified.

    The first table has ``id_col, n_shingles, component_id`` for every row of ``docs``: the number of
    distinct shingles of ``words`` words and the smallest id that links (100 * intersection >=
    ``percent`` * union) lead to. A null or empty text has no shingles and its own id. Rows without an
    id take no part and have a null component; rows that share an id share what their sets reach.
    The second table has ``a, b``: ids of two different sets each (their smallest).
    Other columns are not read.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = _BUCKETS_EACH * tasks
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = written(texts.mapInArrow(_digests(words), "id long, n long, digest binary, sketch binary, finer binary"), "sets")
    finer_of = written(rows.filter("id IS NOT NULL").select("id", "n", "finer").distinct(), "finer")
    with_set = rows.filter("n > 0 AND id IS NOT NULL")
    classes = written(with_set.groupBy("digest").agg(F.min("id").alias("class")), "classes")
    members = written(with_set.join(classes, "digest").select("id", "n", "sketch", "class"), "members")

    known = texts.filter(F.col("id").isNotNull())
    packed = known.mapInArrow(
        _signature_rows(words, percent, buckets), "bucket int, least long, ids binary, sizes binary, counts binary, values binary"
    )
    schema = "kind int, a long, b long, size long, members array<long>"
    dealt = packed.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(_shared_signatures(percent, tasks), "target int, kind int, packed binary")
    shared = written(found.repartition(tasks, "target").mapInArrow(_met_once, schema), "shared")

    class_of = written(members.select("id", "class").distinct(), "class-of")
    pairs = shared.filter("kind = 0").groupBy("a", "b").agg(F.max("size").alias("size"))
    pairs = pairs.join(class_of.toDF("a", "class_a"), "a").join(class_of.toDF("b", "class_b"), "b")
    pairs = pairs.select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"), "size")
    one_each = written(members.filter("id = class").dropDuplicates(["class"]), "one-each")
    links = written(verified(_near(pairs.filter("a < b"), one_each, percent), known, finer_of, words, percent), "links")

    groups = shared.filter("kind = 1")
    more = _left_over(groups, one_each, components(links), known, words, percent)
    links = written(links.union(verified(more, known, finer_of, words, percent)), "all-links")
    # One id with several texts ties their sets together.
    tied = members.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a < b").select("a", "b")
    found = components(links.union(tied)).withColumnRenamed("node", "class")
    by_set = classes.join(written(found, "found"), "class", "left")
    by_set = by_set.select("digest", F.coalesce("component", "class").alias("component_id"))
    out = rows.join(written(by_set, "components"), "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out, links
