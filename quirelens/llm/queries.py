"""The corpus operators as queries over whole tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, conversation_repair, decontaminate, hard_negatives, html_text, neighbours, ngram_join, packing, quality_model, quality_rules, suffix_dedup, toxicity, warc
from .common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.span_digest(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.component_table(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.train(docs, table(spark, sf_dir, "labels")))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(rows.unionByName(more))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").alias("vec"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95, scale=256.0)


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return neighbours.nearest(rows, F.col("vec_id") % 20 == 0, k=20)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired(conversation_repair.damage(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_warc, op2_decontaminate, op3_suffix_dedup, op4_html_text, op5_quality_rules, op6_ngram_join, op7_packing, op8_toxicity, op9_quality_model, op10_chat, op11_hard_negatives, op12_neighbours, op13_conversation_repair)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WARC_SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, url, octet_length(encode(html)) AS payload_bytes, sha1(encode(html)) AS hex FROM p),
m AS (SELECT hex, max(page_id) AS holder FROM h GROUP BY hex)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (k // 4) AS INT), 5) AS BIGINT) >> CAST(5 * (3 - k % 4) AS INT)) & 31 AS INT) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = holder THEN NULL ELSE holder END AS refers_to, url
FROM h JOIN m USING (hex)
"""

JOIN_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id GROUP BY x.doc_id, y.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(c.least, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a) c USING (doc_id)
"""

CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, 14 + length(role) + length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')) AS n FROM c),
f AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS upto, role = 'assistant' AS own,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS final FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (own), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (own), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (own OR final) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

ORACLE: dict[str, str] = {"op1_warc": WARC_SQL, "op2_decontaminate": decontaminate.CONTAMINATION_SQL, "op6_ngram_join": JOIN_SQL, "op10_chat": CHAT_SQL, "op11_hard_negatives": NEGATIVES_SQL, "op13_conversation_repair": conversation_repair.REPAIR_SQL}
