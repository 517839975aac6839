"""Day-first dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(text: Column) -> Column:
    """``d/m/yyyy`` as a date, null for anything else."""
    return F.try_to_date(text, "d/M/yyyy")


def year_of(text: Column) -> Column:
    """The year of a day-first date, null when the date is not valid."""
    return F.year(parse_date(text))


def year_or_zero(text: Column) -> Column:
    """As :func:`year_of`, with 0 for an invalid date."""
    return F.coalesce(year_of(text), F.lit(0))
