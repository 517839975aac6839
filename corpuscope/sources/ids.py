"""Ids that depend on the content of a row alone, not on files, splits or the order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuscope.runtime import written
from corpuscope.schema import SPEECH_ID

#: An id has at most so many hexadecimal digits of a SHA-256 (60 bits).
HEX_DIGITS = 15
#: About so many equal rows are numbered by one task.
EQUAL_SLICE = 100_000


def content_digest(columns: Sequence[str]) -> Column:
    """The SHA-256 of the values, each with its length, so that no two rows of values are written alike."""
    parts = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat_ws(",", *parts), 256)


def _id(digest: Column, number: Column, salt: Column, digits: int) -> Column:
    text = F.concat_ws(":", digest, number.cast("string"), salt.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, digits), 16, 10).cast("bigint")


def lasting_ids(df: DataFrame, name: str = SPEECH_ID, digits: int = HEX_DIGITS) -> DataFrame:
    """Add a unique id to every row, made from all its columns.

    Equal rows are numbered, and as they are equal it does not matter which gets which number. Rows whose ids
    agree by chance are found, and all but one (the least digest) get another id, again by content alone. So reruns,
    reordered rows and other splits give the same ids; a row that is added changes no other id unless it is
    a copy or the chance is below one in 2^60 a pair.

    Only rows with copies or clashes are joined by number; all others carry their id from the first pass.
    """
    rows = df.withColumns({"_digest": content_digest(df.columns), "_row": F.monotonically_increasing_id()})
    rows = written(rows, "undigested")  # numbers of rows hold from here on
    keys = rows.select("_digest", "_row")

    repeated = keys.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    slices = F.ceil(F.col("_n") / EQUAL_SLICE)
    copies = keys.join(repeated, "_digest").withColumn("_slice", F.pmod(F.xxhash64("_row"), slices))
    copies = written(copies.drop("_n"), "copies")
    before = Window.partitionBy("_digest").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = copies.groupBy("_digest", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    firsts = sizes.select("_digest", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("_digest", "_slice").orderBy("_row")
    numbers = copies.withColumn("_at", F.row_number().over(within)).join(firsts, ["_digest", "_slice"])
    numbers = numbers.select("_row", (F.col("_first") + F.col("_at") - 1).alias("_number"))
    numbers = written(numbers.filter("_number > 0"), "numbers")

    number = F.coalesce("_number", F.lit(0))
    salt = F.lit(0)
    ids = keys.join(numbers, "_row", "left").select("_row", "_digest", number.alias("_number"), salt.alias("_salt"))
    ids = written(ids.withColumn(name, _id(F.col("_digest"), F.col("_number"), F.col("_salt"), digits)), "ids")
    while True:
        clashes = ids.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(name)
        clashes = written(clashes, "clashes")
        if clashes.isEmpty():
            break
        place = F.row_number().over(Window.partitionBy(name).orderBy("_salt", "_digest", "_number"))
        losers = ids.join(clashes, name).withColumn("_place", place).filter("_place > 1")
        losers = written(losers.select("_row", (F.col("_salt") + 1).alias("_again")), "losers")
        ids = ids.join(losers, "_row", "left").withColumn("_salt", F.coalesce("_again", "_salt")).drop("_again")
        ids = written(ids.withColumn(name, _id(F.col("_digest"), F.col("_number"), F.col("_salt"), digits)), "ids")
    others = ids.filter("_number > 0 OR _salt > 0").select("_row", F.col(name).alias("_other"))
    others = written(others, "other-ids")
    own = _id(F.col("_digest"), F.lit(0), F.lit(0), digits)
    found = rows.join(others, "_row", "left").withColumn(name, F.coalesce("_other", own))
    return found.select(name, *df.columns)
