"""Thin queries over the training-data operators, with production parameters and whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import bpe, chat, decontaminate, divergence, licences, lm, media, neardup, suffixdedup, topk, toxicity, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_chat(turns)
    formatted, spans = F.col("formatted"), F.col("loss_spans")
    read = done.select(
        "conv_id",
        chat.parse_chat(formatted).alias("turns"),
        chat.loss_text(formatted, spans).alias("loss"),
        F.length(formatted).cast("long").alias("formatted_chars"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), n AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before,
    length(role) + length(regexp_replace(role, '[^\\<\[\]]', '', 'g')) AS role_chars,
    length(text) + length(regexp_replace(text, '[^\\<\[\]]', '', 'g')) AS text_chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(4 + sum(text_chars + CASE WHEN i = 1 THEN role_chars + 5 WHEN role = before THEN 3 ELSE role_chars + 6 END) AS BIGINT)
    AS formatted_chars
FROM n GROUP BY conv_id
"""


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(_table(spark, sf_dir, "documents"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(_table(spark, sf_dir, "documents")).drop("spans")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.capture_index(_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest, coalesce(html, '') AS payload
  FROM pages
), m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS response FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM m
"""


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixdedup.digests(suffixdedup.remove_repeats(documents))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), w AS (
  SELECT row_id, lang, source,
    translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d
), k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM w GROUP BY ALL HAVING count(DISTINCT row_id) >= 3),
s AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000 * (coalesce(c.c, 0) + 1)) // (coalesce(n.n, 0) + s.v) AS p, 1 + (1000000000 * (k.total + 1)) // (s.n + s.v) AS q
  FROM g JOIN k USING (lang) JOIN s USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
      SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE c > 0 AND p > q
), o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 200
"""


def op12_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(media.store(_table(spark, sf_dir, "documents")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_license_scans": op2_license_scans,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_bpe_encoding": op5_bpe_encoding,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_exact_topk": op9_exact_topk,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_source_divergence": op11_source_divergence,
    "op12_media_columns": op12_media_columns,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLE_SQL = {"op1_chat_formatting": OP1_SQL, "op4_warc": OP4_SQL, "op9_exact_topk": OP9_SQL, "op11_source_divergence": OP11_SQL}
