"""The test tables seen as speeches, and the parameters used with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuscope.functions.sentiment import Lexicon
from corpuscope.runtime import spread
from corpuscope.schema import SPEECH_ID

STOPS = "the and of die der el la le les is in".split()
LEXICON = Lexicon("the on er".split(), "and of die".split(), "is in for".split())

# Groups in ``documents`` stand for parties and members; some keys, dates and texts are spoilt on
# purpose so that the rules for missing values are exercised. Some speeches have words of their own at
# the end, and further rows without text are added.
_LETTERS = "translate(CAST(doc_id AS STRING), '0123456789', 'abcdefghij')"
_RARE = " || ' ' || ".join(f"{_LETTERS} || 'rarum{end}'" for end in "abcdefgh")
_SPEECHES = """
SELECT doc_id AS speech_id,
       CASE WHEN doc_id % 43 = 0 THEN NULL ELSE source END AS member_name,
       CASE WHEN doc_id % 41 = 0 THEN NULL ELSE lang END AS political_party,
       CASE WHEN doc_id % 50 = 0 THEN 'n/a' ELSE {date} END AS sitting_date,
       CASE WHEN doc_id % 89 = 3 THEN text || ' ' || {rare} ELSE text END AS speech
FROM {documents}
UNION ALL
SELECT -1 - doc_id, NULL, source, {date}, '' FROM {documents} WHERE doc_id % 97 = 0
"""
_SPARK_DATE = (
    "date_format(date_add(DATE'1989-01-01', CAST((doc_id * 37) % 11688 AS INT)), 'dd/MM/yyyy')"
)
_SQL_DATE = "strftime(DATE '1989-01-01' + CAST((doc_id * 37) % 11688 AS INT), '%d/%m/%Y')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as speeches."""
    documents = table(spark, sf_dir, "documents")
    view = spark.sql(
        _SPEECHES.format(date=_SPARK_DATE, rare=_RARE, documents="{documents}"), documents=documents
    )
    return spread(view, SPEECH_ID)


# The same speeches in Greek letters, those of every fourth document in Latin ones; stems of the
# stop words, as a stop list for stemmed text holds them.
_LATIN, _GREEK = "abcdefghijklmnopqrstuvwxyz", "αβψδεφγηιξκλμνοπκρστυωωχυζ"
_IN_GREEK = f"CASE WHEN speech_id % 4 = 0 THEN speech ELSE translate(lower(speech), '{_LATIN}', '{_GREEK}') END"
GREEK_STOPS = "τηε ανδ οφ διε δερ ελ λα λε λες ισ ιν τι εν ον".split()


def greek_speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speeches in Greek letters."""
    return speeches(spark, sf_dir).withColumn("speech", F.expr(_IN_GREEK))


SPEECHES_SQL = f"speeches AS ({_SPEECHES.format(date=_SQL_DATE, rare=_RARE, documents='documents')})"
GREEK_SPEECHES_SQL = f"{SPEECHES_SQL.replace('speeches AS', 'latin AS', 1)}, speeches AS (SELECT * REPLACE ({_IN_GREEK} AS speech) FROM latin)"
