"""The whole run on a small Greek corpus."""

from __future__ import annotations

import json
import random

from corpuscope.operators import search as sr
from corpuscope.plans.batch import build_all
from corpuscope.functions.greek import greek_stem
from corpuscope.sources.indexes import load_index
from corpuscope.sources.speeches import read_speeches

THEMES = {
    "ann": "παιδεία σχολείο μαθητές εκπαίδευση δάσκαλος",
    "bob": "φορολογία φόρος οικονομία χρέος ανάπτυξη",
    "cid": "υγεία νοσοκομείο γιατρός ασθενείς φάρμακα",
}


def test_build_all(spark, tmp_path):
    rng = random.Random(3)
    lines = ["sitting_date,member_name,political_party,speech"]
    for i in range(60):
        name = sorted(THEMES)[i % 3]
        words = THEMES[name].split()
        said = " ".join(rng.choice(words) for _ in range(20))
        lines.append(f'{1 + i % 28}/{1 + i % 12}/{2000 + i % 3},{name},party {i % 2},"Και {said}."')
    lines.append("1/1/2000,ann,party 0,σύντομο")
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")

    raw = read_speeches(spark, str(tmp_path / "in.csv"))
    out = str(tmp_path / "out")
    build_all(raw, out, stops=["κα"], topics=3, clusters=3, buckets=4)

    index = load_index(spark, f"{out}/index")
    assert index.speeches.count() == 60
    asked = spark.createDataFrame([(1, "ο φόρος"), (2, "και")], "query_id long, query string")
    found = sr.search(index, asked, ["κα"], greek_stem).collect()
    assert found and {r["member_name"] for r in found} == {"bob"}

    keywords = (tmp_path / "out/keywords_by_member_name").glob("part-*.csv")
    (report,) = [part.read_text("utf-8-sig") for part in keywords]
    assert report.startswith("member_name,top_keywords\n")
    assert "μαθητ" in [line for line in report.splitlines() if line.startswith("ann")][0]

    sizes = spark.read.parquet(f"{out}/speech_clusters").groupBy("cluster_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [20, 20, 20]
    topics = spark.read.parquet(f"{out}/speech_topics")
    assert {"Topic_1", "Topic_3", "cluster_id", "member_name"} <= set(topics.columns)

    (text,) = [r["value"] for r in spark.read.text(f"{out}/sentiment").collect()]
    assert [row["year"] for row in json.loads(text)] == [2000, 2001, 2002]
