"""The registered queries over documents, embeddings and pages."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import (
    divergence,
    embedding,
    minhash,
    negatives,
    outliers,
    packing,
    pieces,
    sharding,
    tokenfile,
    toxicity,
    warc,
    weaklabel,
    wrappers,
)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; those without SQL are tested against brute force."""

    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash")
def op1_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_embedding")
def op2_embedding(spark, sf_dir):
    return embedding.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_warc")
def op3_warc(spark, sf_dir):
    files = warc.write_archives(table(spark, sf_dir, "pages"))
    records = warc.read_archives(files, complete=True).filter(F.col("gap_reason").isNull())
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_pieces")
def op4_pieces(spark, sf_dir):
    encoded = pieces.encode(table(spark, sf_dir, "documents"), PIECES)
    restored = pieces.decode(encoded, PIECES)
    return restored.select(
        "doc_id",
        "n_pieces",
        F.crc32("ids").alias("ids_crc32"),
        F.octet_length("text").cast("long").alias("text_bytes"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )


@query("op5_packing")
def op5_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1, window=2048)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op7_token_files")
def op7_token_files(spark, sf_dir):
    files = tokenfile.write_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)
    return tokenfile.read_tokens(files).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op6_quality_rules")
def op6_quality_rules(spark, sf_dir):
    return outliers.quality_rules(table(spark, sf_dir, "documents"))


@query("op8_quality_classifier")
def op8_quality_classifier(spark, sf_dir):
    return weaklabel.classify(table(spark, sf_dir, "documents"))


@query("op9_html_text")
def op9_html_text(spark, sf_dir):
    found = wrappers.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op10_sharding")
def op10_sharding(spark, sf_dir):
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op11_divergence_audit",
    """WITH docs AS (
      SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents),
    words AS (
      SELECT doc, lang, source, unnest(regexp_extract_all(text, '[a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
    langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
    counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    sizes AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
    sources AS (
      SELECT DISTINCT d.lang, d.source, coalesce(s.n, 0) AS n, coalesce(l.v, 0) AS v
      FROM docs d LEFT JOIN sizes s USING (lang, source) LEFT JOIN langs l ON l.lang = d.lang),
    shares AS (
      SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
        1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (g.n + 5 * g.v) AS p,
        1 + (1000000000::HUGEINT * (k.n + 5)) // (l.n + 5 * l.v) AS q
      FROM sources g JOIN kept k USING (lang) JOIN langs l USING (lang)
      LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    apart AS (
      SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (
      SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
      FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
    ranked AS (
      SELECT lang, source, 'pair' AS part, item, value,
        row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
      UNION ALL
      SELECT lang, source, 'term', term, p - q,
        row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term)
      FROM shares WHERE c > 0 AND p > q)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 50""",
)
def op11_divergence_audit(spark, sf_dir):
    return divergence.divergence_audit(table(spark, sf_dir, "documents"))


@query(
    "op12_hard_negatives",
    """WITH vectors AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id,
      positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= 5""",
)
def op12_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved))


@query("op13_toxicity")
def op13_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
