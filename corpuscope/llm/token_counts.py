"""Token counts by digest: a stored cache answers for known contents, only new ones are encoded."""

from __future__ import annotations

import hashlib
import os
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpuscope.runtime import written

CACHE_SCHEMA = "digest binary, version string, n_tokens long"
_KEPT_WORDS = 400_000
# Letters and digits of plain texts, for which splitting here and in the tokenizer's library agree.
_PLAIN_TEXT = re.compile("[\t-\r -~\xa0-įı-ſ]*")
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PLAIN_WORDS = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+")


def version_of(tokenizer: str) -> str:
    """The digest of a tokenizer's file."""
    with open(tokenizer, "rb") as data:
        return hashlib.sha256(data.read()).hexdigest()


def content_digest(text: Column) -> Column:
    """Of a text in which each run of white space is one blank, as the tokenizer reads it; null is empty."""
    return F.unhex(F.md5(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+", " ")))


def _counter(tokenizer: str):
    """A function that counts the tokens of a text, each distinct word of a task encoded once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    library.no_truncation()
    library.no_padding()
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    known: dict[str, int] = {}

    def whole(text: str) -> int:
        return len(library.encode(text, add_special_tokens=False).ids)

    def count(text: str) -> int:
        if not _PLAIN_TEXT.fullmatch(text) or any(s in text for s in special):
            return whole(text)
        words = _PLAIN_WORDS.findall(text.lower())
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) > _KEPT_WORDS:
                known.clear()
                new = list(set(words))
            for w, e in zip(new, library.encode_batch(new, add_special_tokens=False)):
                known[w] = len(e.ids)
        return sum(map(known.__getitem__, words))

    # Word by word only where the pattern is the one above; else whole texts.
    return count if _splits_as_expected(library) else whole


def _splits_as_expected(library) -> bool:
    """Whether the file's steps are lower-casing and the split by the pattern above."""
    sample = "It's 12 O'Clock,  d'été…\nnaïve!? x1y2"
    if library.normalizer is None or library.pre_tokenizer is None:
        return False
    text = library.normalizer.normalize_str(sample)
    found = library.pre_tokenizer.pre_tokenize_str(text)
    return [text[a:b] for _, (a, b) in found] == _PLAIN_WORDS.findall(sample.lower())


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, text_col: str = "text") -> DataFrame:
    """Add ``n_bytes`` and ``n_tokens`` to every row.

    The digest of the normalised content and the tokenizer's version are joined to ``cache``, a folder
    of Parquet files shared by the cluster (made if missing). Contents without a count are reduced
    to one row per digest (copies within a task before the shuffle), encoded, and appended to it.
    A null text counts as empty. A rerun or a retried append may write a digest twice with the same
    count; reading takes one. Existing columns of those two names are replaced.
    """
    spark = docs.sparkSession
    version = version_of(tokenizer)
    empty = spark.createDataFrame([], CACHE_SCHEMA)
    empty.write.mode("append").parquet(cache)  # makes the folder, adds nothing

    def stored() -> DataFrame:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("version") == version)
        return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    keyed = docs.select(content_digest(F.col(text_col)).alias("digest"), F.coalesce(text_col, F.lit("")).alias("text"))

    def encode(tables):
        count = _counter(tokenizer)
        for table in tables:
            counts = [count(t) for t in table.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([table.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    misses = keyed.join(stored(), "digest", "left_anti").dropDuplicates(["digest"])
    new = misses.mapInArrow(encode, "digest binary, n_tokens long")
    new.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)

    rows = docs.drop("n_bytes", "n_tokens").withColumn("_digest", content_digest(F.col(text_col)))
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
    # Written first: a join of two plain exchanges is one whose hot digests Spark can split.
    counts = written(stored().withColumnRenamed("digest", "_digest"), "token-counts")
    return rows.join(counts, "_digest", "left").drop("_digest")
