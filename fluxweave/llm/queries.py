"""The numbered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, embedding_dedup, exact_dedup, jaccard, media, packing, pii, prefix_trie, quality, sentencepiece_suffix, tokens, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_report(_table(spark, sf_dir, "documents")).drop("feature_bits")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(_table(spark, sf_dir, "conversations"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_suffix.report(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.ngram_jaccard_join(_table(spark, sf_dir, "documents"), words=3, num=90, den=100, every=True)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_report(_table(spark, sf_dir, "pages")).select(*(F.col(c) for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_rows(_table(spark, sf_dir, "documents"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_token_counts, op2_media_columns, op3_exact_dedup, op4_chat_format, op5_packing, op6_quality, op7_sentencepiece, op8_ngram_jaccard, op9_pii, op10_warc, op11_prefix_trie, op12_alignment, op13_embedding_dedup)
    return {f.__name__: f for f in every}


OP3_SQL = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

OP10_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), g AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
"""


# CRC-32 of the decimal id, bit by bit; then heads and own turns as lists, nodes as their prefixes.
OP11_SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (SELECT conv_id, list(x ORDER BY pos) AS xs FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, xs, CAST(xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
         lambda s, c: list_reduce([xor(s, c), CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a // 2, CAST(3988292384 AS BIGINT) * (a % 2))))) % 6 AS INT) AS h
  FROM own
), c AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(b.xs, 1, h.h), []), list_slice(h.xs, h.h + 1, len(h.xs))) AS xs
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 100
), p AS (SELECT conv_id, d AS depth, list_slice(xs, 1, d) AS pre, len(xs) = d AS ends FROM c, unnest(range(0, len(xs) + 1)) r(d)),
n AS (
  SELECT depth, pre, MIN(conv_id) AS node, COUNT(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY depth, pre
), m AS (SELECT p.conv_id, p.depth, n.node FROM p JOIN n ON n.depth = p.depth AND n.pre = p.pre),
k AS (
  SELECT n.*, up.node AS parent, (n.n_convs - 1) * CASE WHEN n.depth = 0 THEN 0 ELSE length(n.pre[-1].t) END AS saved
  FROM n LEFT JOIN m up ON up.conv_id = n.node AND up.depth = n.depth - 1
), g AS (SELECT parent AS node, depth - 1 AS depth, COUNT(*) AS n_children FROM k WHERE depth > 0 GROUP BY 1, 2),
w AS (SELECT k.*, coalesce(g.n_children, 0) AS n_children FROM k LEFT JOIN g ON g.node = k.node AND g.depth = k.depth),
s AS (
  SELECT m.node, m.depth, SUM(w.saved) AS saved, COUNT(*) FILTER (WHERE w.n_children = 0) AS leaves
  FROM w JOIN m ON m.conv_id = w.node AND m.depth <= w.depth GROUP BY 1, 2
)
SELECT w.node AS conv_id, w.depth, w.parent AS parent_conv_id, w.n_convs, w.n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN s ON s.node = w.node AND s.depth = w.depth
"""

OP13_SQL = """
WITH RECURSIVE u AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.95
), reach AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b)
SELECT e.vec_id, (SELECT COUNT(*) FROM l WHERE l.a = e.vec_id) AS n_links,
       least(e.vec_id, (SELECT MIN(b) FROM reach r WHERE r.a = e.vec_id)) AS component_id,
       e.vec_id <= coalesce((SELECT MIN(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id) AS kept
FROM embeddings e
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3_SQL, "op10_warc": OP10_SQL, "op11_prefix_trie": OP11_SQL, "op13_embedding_dedup": OP13_SQL}
