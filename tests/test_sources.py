from __future__ import annotations

import json
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpuscope.operators import index as ix
from corpuscope.operators.clusters import cluster_speeches, write_cluster_speeches
from corpuscope.runtime import discard, scratch_path, written
from corpuscope.sources import dictionaries, ids, indexes, reports, speeches as stored
from corpuscope.sources.layout import write_buckets


def test_lasting_ids(spark, monkeypatch):
    monkeypatch.setattr(ids, "EQUAL_SLICE", 7)
    rows = [(f"a{i}", i % 3 or None) for i in range(200)] + [("same", 1)] * 60 + [("x", None), (None, 2), ("", 2)]
    table = spark.createDataFrame(rows, "speech string, n int")

    def found(df, **options):
        return Counter(tuple(r) for r in ids.lasting_ids(df, **options).collect())

    once = found(table.repartition(3))
    assert len(once) == 263 and Counter({r[1:]: 0 for r in once}).keys() == set(rows)
    assert found(table.orderBy(F.desc("speech")).coalesce(1)) == once
    assert found(table.filter("speech = 'same'")).keys() <= once.keys()
    # With ids of 12 bits many clash; they are told apart by content alone.
    few = found(table.repartition(5), digits=3)
    assert len({r[0] for r in few}) == 263 and max(few.values()) == 1
    assert found(table.coalesce(1).orderBy("n"), digits=3) == few
    assert ids.lasting_ids(table.limit(0)).count() == 0


def test_ingested_once(spark, tmp_path):
    text = 'sitting_date,speech\n1/1/2000,"two\nlines"\n,second\n1/1/2000,"two\nlines"\n'
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    head, *rows = ["sitting_date,speech", ",second", '1/1/2000,"two\nlines"', '1/1/2000,"two\nlines"']
    (tmp_path / "parts").mkdir()
    for i, row in enumerate(rows):
        (tmp_path / "parts" / f"{i}.csv").write_text(f"{head}\n{row}\n", encoding="utf-8")
    whole = stored.ingest_speeches(spark, str(tmp_path / "a.csv"), str(tmp_path / "one"))
    parts = stored.ingest_speeches(spark, str(tmp_path / "parts"), str(tmp_path / "many"))
    assert Counter(whole.collect()) == Counter(parts.collect())
    assert whole.select("speech_id").distinct().count() == 3
    given = whole.withColumn("speech_id", F.col("speech_id") % 5)
    given.write.parquet(str(tmp_path / "given"))
    kept = stored.ingest_speeches(spark, str(tmp_path / "given"), str(tmp_path / "kept"), fmt="parquet")
    assert Counter(kept.collect()) == Counter(given.collect())


def test_csv_traps(spark, tmp_path):
    rows = (
        b"sitting_date,member_name,political_party,speech\n"
        b'1/2/2020,"Doe, J",NA,"two\nlines and ""quotes"""\n'
        b"31/02/2020,,red,bad \xff byte\n"
        b'3/4/2021, padded ,None,""\n'
    )
    (tmp_path / "in.csv").write_bytes(rows)
    df = stored.read_speeches(spark, str(tmp_path / "in.csv"))
    got = [tuple(r) for r in df.orderBy("speech_id").collect()]
    assert got[0][1:] == ("1/2/2020", "Doe, J", None, 'two\nlines and "quotes"')
    assert got[1][1:] == ("31/02/2020", None, "red", "bad  byte")
    assert got[2][2:4] == (" padded ", None) and not got[2][4]
    assert len({r[0] for r in got}) == 3


def test_further_columns_pass_through(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "\ufeffrecord,sitting_date,member_name,roles,political_party,speech\n"
        '7,1/2/2020,Ann,"chair, speaker",red,Hello\n',
        encoding="utf-8",
    )
    df = stored.read_speeches(spark, str(tmp_path / "in.csv"))
    assert df.columns[1:] == "record sitting_date member_name roles political_party speech".split()
    assert tuple(df.first())[1:] == ("7", "1/2/2020", "Ann", "chair, speaker", "red", "Hello")
    df.write.parquet(str(tmp_path / "table"))
    again = stored.read_speeches(spark, str(tmp_path / "table"), fmt="parquet")
    assert again.collect() == df.collect()


def test_a_file_without_speeches_is_refused(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="speech"):
        stored.read_speeches(spark, str(tmp_path / "in.csv"))


def test_report_starts_with_byte_order_mark(spark, tmp_path):
    report = spark.createDataFrame([("α", 'x, "y"')], ["party", "top_keywords"])
    reports.write_report(report, str(tmp_path / "out"), files=1)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_bytes() == '﻿party,top_keywords\nα,"x, ""y"""\n'.encode()
    assert reports.read_report(report, str(tmp_path / "out")).collect() == report.collect()


def test_json_records_keep_the_order(spark):
    series = spark.createDataFrame([(2001, 0.5), (1999, -0.25)], "year int, sentiment double")
    (row,) = reports.to_json_records(series).collect()
    assert json.loads(row["json"]) == [
        {"year": 1999, "sentiment": -0.25},
        {"year": 2001, "sentiment": 0.5},
    ]


def test_dictionary(spark, tmp_path):
    (tmp_path / "stems.txt").write_text("\n Καλ \nκαλ\nABC\n\n", encoding="utf-8")
    stems = dictionaries.load_stopwords(spark, str(tmp_path / "stems.txt"))
    assert dictionaries.stop_list(stems) == ["abc", "καλ"]
    with pytest.raises(ValueError):
        dictionaries.stop_list(stems, limit=1)
    dictionaries.write_stopwords(stems.union(stems), str(tmp_path / "out"))
    lines = "".join(p.read_text("utf-8") for p in sorted(Path(tmp_path / "out").glob("part-*")))
    assert lines == "abc\nκαλ\n"


def test_missing_dictionary_is_empty(spark, tmp_path):
    with pytest.warns(UserWarning):
        assert dictionaries.load_stopwords(spark, str(tmp_path / "none.txt")).count() == 0


def test_cluster_export(spark, tmp_path):
    rows = [(2, None, "1/1/2000", "B", 4), (1, "Ann", None, "A", 4), (3, "Bob", "x", "C", 5)]
    names = "speech_id long, member_name string, sitting_date string, speech string, cluster_id int"
    blocks = cluster_speeches(spark.createDataFrame(rows, names), 4)
    write_cluster_speeches(blocks, str(tmp_path / "out"))
    text = "".join(p.read_text("utf-8") for p in sorted(Path(tmp_path / "out").glob("part-*")))
    end = "\n\n" + "=" * 50 + "\n\n"
    assert text == (
        "--- Ομιλία 1/2 ---\nΟμιλητής: Ann\nΗμερομηνία: -\nΚείμενο:\nA" + end
        + "--- Ομιλία 2/2 ---\nΟμιλητής: Άγνωστος\nΗμερομηνία: 1/1/2000\nΚείμενο:\nB" + end
    )


def test_words_are_stemmed_once(spark, tmp_path):
    stemmed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def shortened(word):
        stemmed.add(1)
        return None if word == "BAD" else word[:3]

    stem = shortened.asNondeterministic()
    path = str(tmp_path / "stems")

    def words(*rows):
        return spark.createDataFrame([(r,) for r in rows], "term string")

    first = dictionaries.StemDictionary(spark, path, stem, "a")
    assert first.update(words("tables", "tables", "bad", None)) == 2 and stemmed.value == 2
    again = dictionaries.StemDictionary(spark, path, stem, "a")  # another session goes on
    assert again.update(words("tables", "chairs", "bad")) == 1 and stemmed.value == 3
    found = {r.term: r.stem for r in again.stems(words("bad", "chairs", "lamps")).collect()}
    assert found == {"bad": None, "chairs": "cha", "lamps": "lam"} and stemmed.value == 4
    other = dictionaries.StemDictionary(spark, path, stem, "b")
    assert other.update(words("tables")) == 1 and other.known().count() == 1 and again.known().count() == 4


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {name for name in blocks.split() if name.startswith("shuffle_")}


def test_tables_leave_no_shuffle_files(spark):
    """A shuffle goes with the statement that made it, and a table that is not needed any more can be removed."""
    before = _shuffle_files(spark)
    table = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test-shuffle")
    path = scratch_path(spark, "test-buckets")
    write_buckets(table, ["k"], ["k"], 4, path)
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert table.count() == spark.read.parquet(path).count() == 7
    discard(table)
    assert not Path(table._written_to).exists()


def test_saved_weights_are_those_of_the_index(spark, monkeypatch):
    """Counts are shuffled bare and weighted in their buckets, with shards, ids that come twice and speeches without terms."""
    monkeypatch.setattr(ix, "SHARD_ROWS", 8)
    rows = [(i % 25, f"alpha beta{i % 3} gamma{i} " + "alpha " * i, f"0{1 + i % 9}/02/200{i % 4}") for i in range(30)] + [(99, "", None)]
    clean = spark.createDataFrame(rows, "speech_id long, clean_text string, sitting_date string").withColumn("speech", F.col("clean_text"))
    built = ix.build_index(clean)
    shuffled = []
    place = indexes.placed_in_buckets
    monkeypatch.setattr(indexes, "placed_in_buckets", lambda df, *a: shuffled.append(df) or place(df, *a))
    path = scratch_path(spark, "test-index")
    indexes.save_index(built, path, buckets=4)
    assert [sorted(df.columns) for df in shuffled] == [["_df", "shard", "speech_id", "term", "tf"]]
    wanted, found = built.weights.collect(), indexes.load_index(spark, path).weights.drop("bucket").collect()
    assert max(row["shard"] for row in wanted) > 0
    assert sorted(found, key=str) == sorted(wanted, key=str)
