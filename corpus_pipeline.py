"""A corpus for training, stage by stage: language, toxicity, near copies, mixture, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written to the shared
folder as Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuscope.llm import bpe, language, mixing, partenum, toxicity
from corpuscope.runtime import written

#: A document whose language is less sure than this is rejected. Two won votes score 0.25 at least; the lowest of
#: 12,400 held-out documents (sf0.01, sf0.1, check_s) is 0.37.
LEAST_LANGUAGE_SCORE = 0.3
#: So is one whose letters are less like any learned language than this; 0 is chance. Votes only compare the learned
#: languages and are sure of gibberish as well. The lowest of the held-out documents is 0.05 (lines of secrets and
#: licenses), the highest of texts of 5 random words or more -0.44, of seven other languages -0.63.
LEAST_FAMILIARITY = -0.2
#: A document scored so toxic or more is dropped. Chosen from op8's held-out scores on sf0.01 and sf0.1 (README).
TOXIC_SCORE = 0.3

#: Texts reach Python so many rows at a time, as the stages share executors that keep what they once allocated.
ROWS_AT_A_TIME = 2_000

# Language models and isotonic curves have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session's Python stages; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_A_TIME)


def _with_text(docs: DataFrame) -> DataFrame:
    """Whole rows beside their text, so that no column of theirs can clash with a stage's own."""
    return docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with a language: those without letters, of no sure or of no learned language, go.

    The machines learn from the labels of all the documents.
    """
    _small_batches(spark)
    model = language.fit(docs, F.lit(True), familiar=True)
    judged = language.predict(_with_text(docs), model)
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    if model.gains is not None:
        kept = kept & (F.col("familiarity") >= LEAST_FAMILIARITY)
    return judged.filter(kept).select("_row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents scored below ``TOXIC_SCORE``, learned from all labels of ``labels``."""
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    return toxicity.score(_with_text(docs), model).filter(F.col("score") < TOXIC_SCORE).select("_row.*")


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a key of their own for each row, and the name of its column.

    That is the id. Where ids are null or repeated, these rows get numbers below all ids, in a table that
    is written, so that a row keeps its number.
    """
    key = "_key"
    while key in docs.columns:
        key += "_"
    ids = docs.groupBy(F.col("doc_id").alias(key)).agg(F.count(F.lit(1)).alias("n"))
    odd = written(ids.filter(F.col(key).isNull() | (F.col("n") > 1)).select(key), "odd-ids")
    if odd.isEmpty():
        return docs.withColumn(key, F.col("doc_id")), key
    least = min(0, docs.agg(F.min("doc_id")).first()[0] or 0)
    marked = docs.join(odd.withColumn("_odd", F.lit(True)), F.col("doc_id").eqNullSafe(F.col(key)), "left")
    number = F.lit(least - 1) - F.monotonically_increasing_id()
    own = F.when(F.col("_odd"), number).otherwise(F.col("doc_id")).alias(key)
    return written(marked.select(*[docs[name] for name in docs.columns], own), "keyed"), key


# What the two stages below join with the rows grows with them and has no bound, so it is never broadcast: the
# joins are shuffled at every size.


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near copies: the one whose id (see :func:`_keyed`) is the smallest.

    Rows without words are linked with nothing and all stay, as do different texts under one id.
    """
    _small_batches(spark)
    keyed, key = _keyed(docs)
    components, _ = partenum.jaccard_components(keyed, id_col=key)
    kept = written(components.filter(F.col("component_id") == F.col(key)).select(key), "kept-documents")
    return keyed.join(kept.hint("merge"), key, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each row as the mixture takes; rows taken 0 times go."""
    keyed, key = _keyed(docs)
    copies = key + "n"
    taken = mixing.mix(keyed, id_col=key).filter("copies > 0").select(key, F.col("copies").cast("int").alias(copies))
    rows = keyed.join(written(taken, "taken").hint("merge"), key)
    repeated = F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copies + "th")
    return rows.select(*docs.columns, repeated).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy: ``doc_id, n_tokens, ids``."""
    _small_batches(spark)
    ids = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("mixture", mix_sources),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage, each stage stored before the next begins.

    Null texts and texts without letters go in the first stage, so all that follows has text. Rows that share an id, or
    have none, are documents of their own throughout. Equal rows are near copies, of which one stays; equal scores
    and sizes are told apart by id. Other columns pass through up to the mixture. An empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
