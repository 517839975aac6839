"""Exact random samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpuscope.schema import SPEECH_ID, require_columns

_HASH_BITS = 60
_LEVEL_BITS = 15  # a histogram has at most 2**15 rows, whatever the size of the table
_FEW_ROWS = 10_000  # so many digests are sorted rather than counted once more


def sample_hash(key: str, seed: int) -> Column:
    """A repeatable pseudo-random order of the rows: the MD5 digest of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_exact(df: DataFrame, n: int, seed: int = 42, key: str = SPEECH_ID) -> DataFrame:
    """Exactly ``n`` rows without replacement, or none when the table has fewer.

    ``key`` is unique. The rows with the ``n`` smallest hashes are taken, but nothing is sorted:
    histograms of the leading hash bits find the cut, and one filter over the table applies it.
    """
    require_columns(df, [key])
    digest = sample_hash(key, seed)
    leading = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    hashed = df.select(leading.alias("h"), digest.alias("digest"))

    # Rows whose leading bits are below ``prefix`` are in, ``wanted`` more come from those equal.
    prefix, wanted, shift = 0, n, _HASH_BITS
    while shift > 0:
        within = hashed.filter(F.shiftright("h", shift) == prefix)
        shift -= _LEVEL_BITS
        slot = F.shiftright("h", shift).alias("slot")
        slots = within.groupBy(slot).count().orderBy("slot").collect()
        if shift == _HASH_BITS - _LEVEL_BITS:
            total = sum(row["count"] for row in slots)
            if n < 1 or n > total:
                return df.limit(0)
            if n == total:
                return df
        for row in slots:
            prefix, equal = row["slot"], row["count"]
            if equal >= wanted:
                break
            wanted -= equal
        if equal <= _FEW_ROWS:
            break
    last_slot = hashed.filter(F.shiftright("h", shift) == prefix).select("digest")
    last = last_slot.orderBy("digest").limit(wanted).agg(F.max("digest")).first()[0]
    return df.filter(digest <= F.lit(last))
