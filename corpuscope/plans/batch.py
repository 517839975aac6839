"""All data products of a corpus in one application: python -m corpuscope.plans.batch IN OUT STOPS.

Each step writes its table below the output folder and the next one reads it from there, so a
failed run can go on from what is written.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuscope.functions.greek import greek_stem
from corpuscope.functions.sentiment import Lexicon
from corpuscope.functions.text import Stemmer
from corpuscope.operators.cleaning import clean_speeches
from corpuscope.operators.clusters import (
    cluster_sizes,
    cluster_speeches,
    cluster_topic_means,
    cluster_topics,
    write_cluster_speeches,
)
from corpuscope.operators.index import build_index, grouped_counts
from corpuscope.operators.keywords import keywords_by, with_year
from corpuscope.operators.sentiment import sentiment_by_year
from corpuscope.operators.similarity import similar_pairs
from corpuscope.operators.topics import attach_topics, latent_topics, top_topic_terms
from corpuscope.runtime import release
from corpuscope.schema import SPEECH_ID
from corpuscope.sources.dictionaries import load_stopwords, stop_list
from corpuscope.sources.indexes import save_index
from corpuscope.sources.reports import to_json_records, write_report
from corpuscope.sources.speeches import ingest_speeches, read_clean, write_clean

GROUPS = (SPEECH_ID, "political_party", "year", "member_name")


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_all(
    raw: DataFrame,
    out: str,
    stops: Sequence[str] = (),
    stemmer: Stemmer | None = greek_stem,
    lexicon: Lexicon = Lexicon(),
    topics: int = 10,
    clusters: int = 100,
    min_df: int = 5,
    buckets: int = 64,
    exported: Sequence[int] = (0,),
) -> None:
    """Clean the speeches and write every report: keywords, index, pairs, topics, clusters (and the
    texts of the ``exported`` ones, the largest by default), sentiment."""
    spark = raw.sparkSession
    write_clean(clean_speeches(raw, stops, stemmer), f"{out}/clean", buckets)
    clean = read_clean(spark, f"{out}/clean").drop("bucket")

    clean = with_year(clean)
    counts = grouped_counts(clean, GROUPS)
    for key in GROUPS:
        # Only the report by speech grows with the corpus; the others fit one file.
        report = keywords_by(clean, key, counts=counts[key])
        write_report(report, f"{out}/keywords_by_{key}", files=None if key == SPEECH_ID else 1)

    save_index(build_index(clean, counts[SPEECH_ID]), f"{out}/index", buckets, f"{out}/clean")

    pairs = similar_pairs(clean, "member_name", counts=counts["member_name"]).select(
        F.col("similarity").alias("Similarity"),
        F.col("a").alias("Member A"),
        F.col("b").alias("Member B"),
    )
    best_first = [F.desc("Similarity"), "Member A", "Member B"]
    write_report(pairs, f"{out}/similar_members", files=1, order=best_first)

    found = latent_topics(clean, topics, min_df, counts=counts[SPEECH_ID])
    terms = top_topic_terms(found.topic_terms)
    write_report(terms, f"{out}/topic_terms", files=1, order=["topic", "rank"])
    grouped = cluster_topics(found.doc_topics, clusters)
    assigned = _stored(grouped.assigned, f"{out}/speech_clusters")
    write_report(cluster_sizes(assigned), f"{out}/cluster_sizes", files=1)
    means = cluster_topic_means(assigned, len(found.sigma))
    write_report(means, f"{out}/cluster_topics", files=1)
    vectors = attach_topics(clean.drop("speech"), assigned, dims=len(found.sigma))
    vectors.write.mode("overwrite").parquet(f"{out}/speech_topics")
    for cluster in exported:
        said = attach_topics(clean, assigned)
        write_cluster_speeches(cluster_speeches(said, cluster), f"{out}/cluster_{cluster}_speeches")

    series = sentiment_by_year(clean, lexicon)
    to_json_records(series).write.mode("overwrite").text(f"{out}/sentiment")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("speeches", help="CSV with a header, the speech in the last column")
    parser.add_argument("out", help="output folder")
    parser.add_argument("stops", help="stop stems, one per line")
    parser.add_argument("--buckets", type=int, default=64, help="buckets of the stored tables")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("corpuscope").getOrCreate()
    stops = stop_list(load_stopwords(spark, args.stops))
    raw = ingest_speeches(spark, args.speeches, f"{args.out}/raw")
    build_all(raw, args.out, stops, buckets=args.buckets)
    release(spark)


if __name__ == "__main__":
    main()
