"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .bpe import Bpe, encode_documents
from .common import table
from .embeddings import near_vectors
from .langid import identify
from .licenses import scan_licenses
from .lm import score
from .minhash import Near, near_duplicates
from .mixing import mix
from .search import top_k
from .substring import Spans, remove_repeats
from .webtext import extract


def op1_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, Spans()).withColumn("kept_sha256", F.sha2(F.col("text").cast("binary"), 256))


def op2_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")


def op3_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), Near(shingle=3, percent=85))


def op4_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, Bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op6_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op7_language_model(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"))


def op8_bm25_top_k(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where("conv_id is not null and turn is not null")
    key = F.struct("conv_id", "turn")
    found = top_k(turns.select(key.alias("doc"), "text"), turns.where("conv_id % 50 = 0").select(key.alias("query"), "text"))
    return found.select(*(F.col(f"query.{c}").alias(f"query_{c}") for c in ("conv_id", "turn")), "rank", *(F.col(f"doc.{c}").alias(f"doc_{c}") for c in ("conv_id", "turn")), "score")


def op9_source_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS name,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, none, name, size) AS ord FROM d),
s AS (SELECT none, name, sum(size)::BIGINT AS source_size,
             list_extract([5, 2, 1], 1 + ((row_number() OVER (ORDER BY none, name) - 1) % 3)::INT)::BIGINT AS w
      FROM r GROUP BY none, name),
c AS (SELECT *, 3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, none, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / (sum(w) OVER (ORDER BY cap / w, none, name ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level,
             row_number() OVER (ORDER BY cap / w, none, name) AS k FROM c),
o AS (SELECT min(k) AS k, arg_min(level, k) AS level FROM l WHERE level * w <= cap),
t AS (SELECT l.none, l.name, l.source_size,
             CASE WHEN o.k IS NULL OR l.k < o.k THEN cap::DOUBLE ELSE o.level * w END AS target FROM l, o),
q AS (SELECT r.*, t.source_size, t.target, e.round, md5('mix|' || e.round || '|' || coalesce(doc_id::VARCHAR, '') || '|' || ord) AS hash
      FROM r JOIN t USING (none, name), (SELECT unnest([0, 1, 2]) AS round) e
      WHERE size > 0 AND e.round * t.source_size <= t.target),
f AS (SELECT *, (round * source_size + sum(size) OVER (PARTITION BY none, name, round ORDER BY hash, doc_id, ord, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE / target AS finish FROM q),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, none, name, round, hash, doc_id, ord, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM f),
n AS (SELECT none, name, doc_id, ord, size, count(*) AS copies FROM g
      WHERE upto <= (SELECT sum(size) FROM r) GROUP BY ALL)
SELECT r.doc_id, r.size, t.source_size, t.target, coalesce(n.copies, 0)::BIGINT * r.size AS taken, coalesce(n.copies, 0)::BIGINT AS copies
FROM r JOIN t USING (none, name)
LEFT JOIN n ON r.none = n.none AND r.name = n.name AND r.doc_id IS NOT DISTINCT FROM n.doc_id AND r.ord = n.ord AND r.size = n.size
"""

def op10_html_extraction(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT DISTINCT conv_id, turn, coalesce(text, '') AS text FROM conversations) WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
s AS (SELECT count(*)::DOUBLE AS n, avg(len(words))::DOUBLE AS mean FROM t),
p AS (SELECT conv_id, turn, word, count(*)::DOUBLE AS tf, any_value(length)::DOUBLE AS length
      FROM (SELECT conv_id, turn, unnest(words) AS word, len(words) AS length FROM t) GROUP BY ALL),
f AS (SELECT word, ln(1 + ((SELECT n FROM s) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM p GROUP BY word),
h AS (SELECT q.conv_id AS query_conv_id, q.turn AS query_turn, d.conv_id AS doc_conv_id, d.turn AS doc_turn,
             round(sum(f.idf * d.tf * 2.2::DOUBLE / (d.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * d.length / (SELECT mean FROM s)))), 6) AS score
      FROM p q JOIN f USING (word) JOIN p d USING (word) WHERE q.conv_id % 50 = 0 GROUP BY ALL)
SELECT query_conv_id, query_turn, row_number() OVER (PARTITION BY query_conv_id, query_turn ORDER BY score DESC, doc_conv_id, doc_turn)::INT AS rank,
       doc_conv_id, doc_turn, score
FROM h QUALIFY rank <= 10
"""

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_language_model": op7_language_model,
    "op8_bm25_top_k": op8_bm25_top_k,
    "op9_source_mixing": op9_source_mixing,
    "op10_html_extraction": op10_html_extraction,
}
ORACLE: dict[str, str] = {"op8_bm25_top_k": OP8_SQL, "op9_source_mixing": OP9_SQL}
