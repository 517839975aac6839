"""Column names, table schemas and the check for required columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, types as T

SPEECH_ID = "speech_id"

# The speech is the last column of the source file; further columns in between pass through.
SPEECH_COLUMNS = T.StructType(
    [
        T.StructField("sitting_date", T.StringType()),
        T.StructField("member_name", T.StringType()),
        T.StructField("political_party", T.StringType()),
        T.StructField("speech", T.StringType()),
    ]
)

STEMS = T.StructType([T.StructField("stem", T.StringType())])

QUERIES = T.StructType(
    [T.StructField("query_id", T.LongType()), T.StructField("query", T.StringType())]
)

WORDS = T.StructType(
    [T.StructField("word_id", T.LongType()), T.StructField("word", T.StringType())]
)


NEEDLE = T.StructType(
    [T.StructField("needle_id", T.LongType()), T.StructField("needle", T.StringType())]
)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail before any job starts when a needed column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing column(s) {missing}; the table has {df.columns}")
    return df


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """The columns that start with ``prefix``, in table order; none is an error."""
    found = [name for name in df.columns if name.startswith(prefix)]
    if not found:
        raise ValueError(f"no column starts with {prefix!r}; the table has {df.columns}")
    return found
