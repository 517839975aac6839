"""Work once per distinct word: the words of a batch of texts travel to their bucket and come back as results.

A *batch* is what one task reads until its words or tokens reach a bound. Its distinct words, each
listed once however often it occurs, are shuffled by a hash of the word, so the most frequent word
of a corpus is no larger a key than the rarest. The positions of the words stay with the batch as
packed numbers and meet the results again by the number of the batch.

Both passes number the batches by partition and row order, so ``texts`` must be a stored table (as
all scans of files are); ``check`` values make a mismatch fail loudly instead of mixing words up.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

WORDS_PER_BATCH = 150_000
TOKENS_PER_BATCH = 1_500_000

Split = Callable[[str], list]

DICTIONARY_SCHEMA = "batch long, bucket int, check long, words array<string>, counts array<long>"
POSITION_SCHEMA = "batch long, check long, ids array<long>, lengths binary, positions binary, buckets binary"


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes."""
    return zstandard.ZstdCompressor(level=3).compress(values.tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    """The array that ``pack`` made."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def bucket_of(words: list, buckets: int) -> np.ndarray:
    """The bucket of each word, the same in every process."""
    as_bytes = (w if isinstance(w, bytes) else w.encode() for w in words)
    return np.fromiter((zlib.crc32(w) % buckets for w in as_bytes), np.uint16, len(words))


def bucket_count(df: DataFrame) -> int:
    """Four buckets for each shuffle partition, at most what 16 bits can number."""
    return min(65_535, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _checksum(words: list) -> int:
    """Of the words of a batch in their order."""
    total = 0
    for w in words:
        total = zlib.crc32(w if isinstance(w, bytes) else w.encode(), total)
    return total


def _numbered(tables: Iterator[pa.RecordBatch], split: Split, weighed: bool, positions: bool):
    """Batches as (number, words in order of first occurrence, ids, lengths, positions, weights)."""
    part = TaskContext.get().partitionId()
    serial = 0

    def fresh():
        return (defaultdict(count().__next__) if positions else {}), [], [], [], []

    words, ids, lengths, places, weights = fresh()
    tokens = 0
    for table in tables:
        weigh = table.column("weight").to_pylist() if weighed else None
        for row, (key, text) in enumerate(zip(table.column("id").to_pylist(), table.column("text").to_pylist())):
            found = split(text or "")
            if positions:
                places.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
            else:
                words.update(dict.fromkeys(found))
            ids.append(key)
            lengths.append(len(found))
            if weighed:
                weights.append(weigh[row])
            tokens += len(found)
            if len(words) >= WORDS_PER_BATCH or tokens >= TOKENS_PER_BATCH:
                yield (part << 24) + serial, list(words), ids, lengths, places, weights
                words, ids, lengths, places, weights = fresh()
                serial, tokens = serial + 1, 0
    if ids:
        yield (part << 24) + serial, list(words), ids, lengths, places, weights


def dictionaries(texts: DataFrame, split: Split, buckets: int, weighed: bool = False) -> DataFrame:
    """The distinct words of each batch by bucket, in order of first occurrence.

    ``texts`` has ``id``, ``text`` and, if ``weighed``, ``weight``; ``counts`` sums the weights of
    the occurrences of a word within the batch (empty if not weighed).
    """

    def run(tables):
        for batch, words, _, lengths, places, weights in _numbered(tables, split, weighed, weighed):
            check = _checksum(words)
            owner = bucket_of(words, buckets)
            counts = None
            if weighed:
                flat = np.concatenate(places) if places else np.zeros(0, np.uint32)
                counts = np.bincount(flat, np.repeat(np.asarray(weights, float), lengths), len(words)).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(owner[order].astype(int)) != 0]) if len(order) else []
            rows = defaultdict(list)
            for i, start in enumerate(starts):
                own = order[start : starts[i + 1] if i + 1 < len(starts) else None]
                rows["batch"].append(batch)
                rows["bucket"].append(int(owner[own[0]]))
                rows["check"].append(check)
                rows["words"].append([words[j] for j in own])
                rows["counts"].append(counts[own] if weighed else [])
            kinds = [("batch", pa.int64()), ("bucket", pa.int32()), ("check", pa.int64()),
                     ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in kinds], [n for n, _ in kinds])

    return texts.mapInArrow(run, DICTIONARY_SCHEMA)


def word_positions(texts: DataFrame, split: Split, buckets: int) -> DataFrame:
    """Per batch: ids and token counts of its texts, the words' numbers at each position, the words' buckets."""

    def run(tables):
        for batch, words, ids, lengths, places, _ in _numbered(tables, split, False, True):
            flat = np.concatenate(places) if places else np.zeros(0, np.uint32)
            planes = np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 4).T)  # equal bytes side by side
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch], pa.int64()),
                    pa.array([_checksum(words)], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([pack(np.asarray(lengths, np.int64))], pa.binary()),
                    pa.array([pack(planes)], pa.binary()),
                    pa.array([pack(bucket_of(words, buckets))], pa.binary()),
                ],
                ["batch", "check", "ids", "lengths", "positions", "buckets"],
            )

    return texts.mapInArrow(run, POSITION_SCHEMA)


def by_bucket(tables: DataFrame) -> DataFrame:
    """All rows of a bucket in one partition, a few buckets each."""
    return tables.repartition(int(tables.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("bucket"))


class Positions:
    """One row of ``word_positions``, unpacked."""

    def __init__(self, row) -> None:
        self.check = int(row["check"])
        self.ids = list(row["ids"])
        self.lengths = unpack(row["lengths"], np.int64)
        planes = unpack(row["positions"], np.uint8).reshape(4, -1)
        self.flat = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
        self.buckets = unpack(row["buckets"], np.uint16)
        #: Where each word stands once the buckets' words are put one after the other.
        self.order = np.argsort(self.buckets, kind="stable")
        self.rank = np.empty(len(self.order), np.int64)
        self.rank[self.order] = np.arange(len(self.order))

    def agree(self, checks) -> None:
        """Fail if the words came from another reading of the table."""
        if len(self.buckets) and {int(c) for c in checks} != {self.check}:
            raise RuntimeError("the two passes read different rows: store the table first")
