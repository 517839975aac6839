"""Byte-level BPE: every distinct pre-token of the corpus is encoded once, ids return to their positions."""

from __future__ import annotations

import base64
import re
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from corpuscope.llm.dictionary import (
    Positions,
    bucket_count,
    by_bucket,
    dictionaries,
    pack,
    unpack,
    word_positions,
)

# Letters and digits of the first Unicode blocks, for which the standard library's faster ``re`` finds
# the same pre-tokens as the pattern with \p{L} and \p{N}; texts with other characters take ``regex``.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ʯ"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PLAIN_TEXT = re.compile("[\t-\r -~\xa0-ʯ]*")
_KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN_PATTERN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^\s{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s+"
)
_COMPILED: dict = {}


def pre_tokens(text: str, pattern: str) -> list[str]:
    """The matches of the pattern."""
    if pattern == _KNOWN_PATTERN and _PLAIN_TEXT.fullmatch(text):
        return _PLAIN_PATTERN.findall(text)
    if pattern not in _COMPILED:
        _COMPILED[pattern] = regex.compile(pattern)
    return [m.group() for m in _COMPILED[pattern].finditer(text)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _encoder(path: str, pattern: str):
    """One encoder per Python process."""
    if (path, pattern) not in _COMPILED:
        import tiktoken

        ranks = read_ranks(path)
        _COMPILED[path, pattern] = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _COMPILED[path, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids array<int>)`` for every row of a stored table; a null text counts as empty.

    Pre-tokens are exploded with their positions inside a batch; the distinct ones are shuffled by
    hash, each is encoded once by the task that owns its hash, and the ids are joined back to the batch
    and put at the positions. An empty text has no ids; repeated rows and null ids are kept as they
    are; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    buckets = bucket_count(docs)
    split = partial(pre_tokens, pattern=pattern)

    def encode_words(tables):
        known: dict[str, bytes] = {}
        for table in tables:
            encoder = _encoder(ranks, pattern)
            rows = [[], []]
            for words in table.column("words").to_pylist():
                for word in words:
                    if word not in known:
                        known[word] = np.asarray(encoder._encode_single_piece(word), np.uint32).tobytes()
                found = [known[word] for word in words]
                rows[0].append(pack(np.fromiter(map(len, found), np.uint32, len(found)) // 4))
                ids = np.frombuffer(b"".join(found), np.uint32)
                rows[1].append(pack(ids.astype(np.uint16) if not len(ids) or ids.max() < 2**16 else ids))
            yield pa.RecordBatch.from_arrays(
                [*(table.column(n) for n in ("batch", "bucket", "check")), *(pa.array(r, pa.binary()) for r in rows)],
                ["batch", "bucket", "check", "lengths", "ids"],
            )

    encoded = by_bucket(dictionaries(texts, split, buckets)).mapInArrow(
        encode_words, "batch long, bucket int, check long, lengths binary, ids binary"
    )

    def reassemble(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        at = Positions(left.iloc[0])
        at.agree(right["check"])
        right = right.sort_values("bucket")
        none = np.zeros(0, np.uint32)
        each = [unpack(x, np.uint32) for x in right["lengths"]]
        lengths = np.concatenate([none, *each]).astype(np.int64)
        packed = [unpack(x, np.uint8) for x in right["ids"]]
        ids = [x.view(np.uint16 if len(x) == 2 * n.sum() else np.uint32) for x, n in zip(packed, each)]
        ids = np.concatenate([none, *ids]).astype(np.int32)
        starts = np.r_[0, np.cumsum(lengths)]
        out, begin = [], 0
        for n in at.lengths:
            ranks_ = at.rank[at.flat[begin : begin + n]]
            begin += n
            each = lengths[ranks_]
            ends = np.cumsum(each)
            total = int(ends[-1]) if n else 0
            out.append(ids[np.arange(total) + np.repeat(starts[ranks_] - (ends - each), each)])
        return pd.DataFrame({"id": pd.array(at.ids, "Int64"), "ids": out})

    parts = word_positions(texts, split, buckets)
    joined = parts.groupBy("batch").cogroup(encoded.groupBy("batch"))
    return joined.applyInPandas(reassemble, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, ranks: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add the bytes of the ids: a join with the token-byte table, whose size the vocabulary fixes.

    Null ids give null, no ids give no bytes; an id outside the vocabulary is an error.
    """
    schema = StructType([*tokens.schema, StructField(bytes_col, BinaryType())])

    def run(tables):
        table_of = {i: b for b, i in read_ranks(ranks).items()}
        token_bytes = [table_of.get(i) for i in range(max(table_of) + 1)]
        for table in tables:
            column = table.column(ids_col)
            offsets = column.offsets.to_numpy()
            flat = column.values.to_numpy()
            made = [
                b"".join([token_bytes[i] for i in flat[a:b].tolist()]) if ok else None
                for a, b, ok in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*table.columns, pa.array(made, pa.binary())], [*table.schema.names, bytes_col]
            )

    return tokens.mapInArrow(run, schema)
