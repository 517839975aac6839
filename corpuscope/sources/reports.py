"""Reports for people and other programs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BOM = "\ufeff"

# Quotes are doubled inside quotes; blanks around values belong to them.
CSV = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_report(
    df: DataFrame,
    path: str,
    files: int | None = None,
    order: Sequence[str | Column] | None = None,
) -> None:
    """Write a CSV report with a header that starts with a byte order mark.

    Rows are in ``order`` (by default that of the first column, ascending) within each file and over
    the files. ``files=1`` gives one file and is meant for reports of bounded size (years, parties,
    the best pairs); only its rows, not what they are computed from, are moved into one task.
    """
    order = list(order) if order else [F.col(df.columns[0]).asc()]
    if files == 1:
        placed = df.repartition(1).sortWithinPartitions(*order)
    elif files is not None:
        placed = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    else:
        placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    write_csv(placed.withColumnRenamed(df.columns[0], BOM + df.columns[0]), path)


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV with a header and doubled quotes, blanks kept."""
    df.write.mode("overwrite").options(header=True, **CSV).csv(path)


def read_report(df: DataFrame, path: str) -> DataFrame:
    """Read a report back with the schema of ``df``."""
    reader = df.sparkSession.read.schema(df.schema)
    return reader.options(header=True, multiLine=True, **CSV).csv(path)


def to_json_records(series: DataFrame) -> DataFrame:
    """One row with a year series as a JSON array of records, in the order of its columns.

    A series has one row for each year, so the array is short.
    """
    record = F.struct(*series.columns)
    return series.select(F.to_json(F.sort_array(F.collect_list(record))).alias("json"))
