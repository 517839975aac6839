"""The operators of this subpackage as queries over whole tables, with the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuscope.llm import bpe, forest, language, lattice, manifest, mixing, partenum, ranked, shards, tiles, token_counts
from corpuscope.llm import toxicity, wrappers
from corpuscope.runtime import scratch_path


def fold(key: str, parts: int):
    """The fold of a row: crc32 of the key as text, modulo ``parts``; -1 without a key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts, F.lit(-1))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 80 % of their five-word shingles."""
    return partenum.jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for every fiftieth."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return forest.nearest(vectors, F.col("vec_id") % 50 == 0)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    mixed = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return wrappers.extract(pages)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tokens = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    decimal = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors with a cosine of 0.95 or more."""
    return tiles.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four of five folds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs, fold("doc_id", 5) != 0)
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return language.predict(docs.select("doc_id", "text", held_out), model).drop("text").select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of two of three folds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.filter(fold("doc_id", 3) != 1), "text")
    held_out = (fold("doc_id", 3) == 1).alias("held_out")
    scored = toxicity.score(docs.withColumn("held_out", held_out), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document through a digest cache that starts empty."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    counted = token_counts.count_tokens(docs, tokenizer, scratch_path(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op10_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice and word-model scores of every document, learned from nine of ten folds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    scored = lattice.score_texts(docs, fold("doc_id", 10) != 0, vocabulary)
    return scored.select(
        "doc_id", (fold("doc_id", 10) == 0).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, its way to the root, and the root it leads to once its line ends are deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    row = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.when(fold("doc_id", 2) == 0, manifest.leaf_digest(*row, F.replace("text", F.lit("\n"), F.lit(""))))
    leaf = manifest.leaf_digest(*row, F.col("text"))
    tree = manifest.tree_key(F.col("source"))
    leaves = docs.select("doc_id", tree.alias("tree"), leaf.alias("digest"), tampered.alias("tampered"))
    built = manifest.build(leaves, ["doc_id"])
    folded = manifest.fold(built, F.col("tampered"), {"doc_id": "long", "digest": "binary"})
    found = {"leaf": "digest", "subroot": "subroot", "root": "root", "proof_sha256": "proof", "folded_root": "folded_root"}
    shown = [F.lower(F.hex(column)).alias(name) for name, column in found.items()]
    return folded.select("doc_id", *shown, (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_exact_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A uniform shuffle of all documents into 16 shards of equal counts (at most one apart)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shards.shuffled(docs, 16).select(
        "doc_id", shards.text_bytes(F.col("text")).alias("size"), F.crc32("text").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return ranked.rank(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_nearest_vectors, op3_source_mix, op4_main_text, op5_byte_bpe,
        op6_near_vectors, op7_language, op8_toxicity, op9_token_counts, op10_lattice_scores,
        op11_merkle_manifest, op12_exact_shards, op13_ranked_search,
    )
}

# CRC-32 of a decimal number, byte by byte, each byte bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
  [4294967295] || list_transform(range(1, length({id}::VARCHAR) + 1), lambda i: ascii(substr({id}::VARCHAR, i::INT, 1))::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || range(8),
    lambda d, step: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END)))"""

_TAMPERED = f"CASE WHEN {_CRC32.format(id='doc_id')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"


def _field(value: str) -> str:
    """A value as it is hashed."""
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


ORACLES: dict[str, str] = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source,
         sha256(known || {_field('text')}) AS leaf,
         sha256(known || {_field(_TAMPERED)}) AS changed
  FROM (SELECT *, {_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} AS known FROM documents)),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS total,
         dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree
  FROM hashed),
below AS (
  SELECT tree, 0 AS level, place, leaf AS h, total FROM leaves
  UNION ALL
  SELECT tree, level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (total + 2) // 3
  FROM below WHERE total > 1 GROUP BY tree, level, place // 3, total),
subroots AS (SELECT tree, h AS subroot, level AS top FROM below WHERE total = 1),
above AS (
  SELECT 0 AS level, tree - 1 AS place, subroot AS h, count(*) OVER () AS total FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (total + 2) // 3
  FROM above WHERE total > 1 GROUP BY level, place // 3, total),
tops AS (SELECT h AS root, level AS top FROM above WHERE total = 1),
-- All nodes of a document's way share one numbering of levels: first those below its subroot.
nodes AS (
  SELECT tree, level, place, h FROM below WHERE total > 1
  UNION ALL
  SELECT s.tree, s.top + a.level, a.place, a.h FROM above a, subroots s WHERE a.total > 1),
runs AS (
  SELECT tree, level, place // 3 AS run, list(h ORDER BY place) AS hs, min(place) AS start FROM nodes GROUP BY ALL),
folded AS (
  SELECT l.doc_id, l.leaf, l.tree, 0 AS level, l.place AS place, l.place AS leaf_place, l.changed AS h, '' AS proof, s.top AS turn, s.top + t.top AS last
  FROM leaves l JOIN subroots s USING (tree), tops t
  UNION ALL
  SELECT f.doc_id, f.leaf, f.tree, f.level + 1,
         CASE WHEN f.level + 1 = f.turn THEN f.tree - 1 ELSE r.run END, f.leaf_place,
         sha256(array_to_string(r.hs[1:r.at - 1] || [f.h] || r.hs[r.at + 1:len(r.hs)], '')),
         f.proof || array_to_string(r.hs[1:r.at - 1] || r.hs[r.at + 1:len(r.hs)], ''), f.turn, f.last
  FROM (SELECT *, CASE WHEN turn = 0 AND level = 0 THEN tree - 1 ELSE place END AS p FROM folded WHERE level < last) f
  JOIN (SELECT *, unnest(range(1, len(hs) + 1)) AS at FROM runs) r
    ON r.tree = f.tree AND r.level = f.level AND r.start + r.at - 1 = f.p)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM folded JOIN subroots USING (tree), tops WHERE level = last
""",
    "op3_source_mix": """
WITH RECURSIVE docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS hash
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM docs GROUP BY source),
rounds AS (
  SELECT 0 AS step, source, source_size, weight, false AS capped, 0.0::DOUBLE AS target FROM sources
  UNION ALL
  SELECT step + 1, source, source_size, weight, capped OR level * weight > 3.0 * source_size,
         CASE WHEN capped THEN target ELSE least(level * weight, 3.0 * source_size) END
  FROM (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(CASE WHEN capped THEN target END) OVER (), 0))::DOUBLE
              / nullif(sum(CASE WHEN NOT capped THEN weight END) OVER (), 0) AS level
    FROM rounds)
  WHERE step < (SELECT count(*) FROM sources)),
targets AS (SELECT * FROM rounds WHERE step = (SELECT count(*) FROM sources)),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('0 ' || coalesce('=' || d.source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, d.hash % ceil(n / 5000.0)::BIGINT, d.doc_id) AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY source, size) AS n FROM docs) d
  JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (floor(rate * place + shift) - floor(rate * (place - 1) + shift))::BIGINT * size AS taken
FROM placed
""",
    "op13_ranked_search": """
WITH words AS (
  SELECT doc_id, d, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS d FROM documents)),
asked AS (
  SELECT item_id, i, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS i FROM benchmark)),
sizes AS (SELECT d, any_value(doc_id) AS doc_id, count(*)::BIGINT AS n FROM words GROUP BY d),
totals AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM sizes),
counts AS (SELECT d, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals GROUP BY term, nn),
scores AS (
  SELECT i, item_id, d, s.doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // l))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes s USING (d), totals
  GROUP BY ALL),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ordered WHERE rank <= 10
""",
}
