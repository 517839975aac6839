"""Sentiment over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpuscope.functions.dates import year_of
from corpuscope.functions.sentiment import Lexicon, sentiment
from corpuscope.schema import require_columns


def sentiment_by_year(speeches: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """``(year, sentiment)``: mean sentiment of the original texts, to 4 places.

    ``speeches`` are the kept ones (after cleaning); null texts and invalid dates are left out.
    """
    require_columns(speeches, ["sitting_date", "speech"])
    dated = speeches.select(year_of(F.col("sitting_date")).alias("year"), "speech")
    scored = dated.na.drop().select("year", sentiment(F.col("speech"), lexicon).alias("value"))
    return scored.groupBy("year").agg(F.bround(F.avg("value"), 4).alias("sentiment"))
