"""The registered queries of the corpus operators and their DuckDB SQL."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, contamination, fingerprints, knn, lines, mixing, negatives, packing, pii, repair, simhash, tokens, warc
from .common import table, word_count

# vocabulary files of public tokenizers: only their path is used
VOCABULARY = public_tokenizers.path


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text, and their likenesses."""
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word-piece tokens of every document."""
    counts = tokens.token_counts(F.col("text"), VOCABULARY("byte_bpe_50k.tiktoken"))
    return (table(spark, sf_dir, "documents").select("doc_id", counts.alias("_c"))
            .select("doc_id", "_c.n_words", "_c.n_tokens"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return (table(spark, sf_dir, "documents").select("doc_id", pii.pii_summary(F.col("text")).alias("_s"))
            .select("doc_id", "_s.*"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    sized = (table(spark, sf_dir, "documents")
             .select("doc_id", "source", word_count(F.col("text")).alias("size")).checkpoint())
    return (mixing.with_copies(sized, size=F.col("size"))
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")))


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS cap,
         (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS w
  FROM sized GROUP BY source),
steps AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS cap_before, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_after,
         1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS budget, cap / w AS stop_level
  FROM ranked
  WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT budget - cap_before AS left_over, w_after FROM steps
  WHERE (budget - cap_before) / w_after <= stop_level ORDER BY stop_level, cap_before LIMIT 1),
targets AS (
  SELECT r.source, r.source_size,
         CASE WHEN l.w_after IS NULL OR r.cap < l.left_over / l.w_after * r.w THEN r.cap
              ELSE least(l.left_over * r.w / l.w_after, r.cap) END AS target
  FROM ranked r LEFT JOIN level l ON true),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rated
"""

QUERIES = {
    "op2_fingerprints": op2_fingerprints,
    "op4_token_counts": op4_token_counts,
    "op5_pii": op5_pii,
    "op9_mixing": op9_mixing,
}
ORACLES = {"op9_mixing": OP9_SQL}


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated and nearly repeated lines."""
    return lines.with_dropped(table(spark, sf_dir, "documents")).select(
        "_row.doc_id", "text", F.col("n_lines").cast("bigint"), F.col("n_dropped").cast("bigint"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and group of every document."""
    grouped = simhash.group_documents(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES |= {"op8_line_dedup": op8_line_dedup, "op10_simhash": op10_simhash}


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through a WARC archive and back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


OP7_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
b AS (  -- five hexadecimal digits are four of base 32
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
         lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i * 5 + 1)::INT, 5))::BIGINT >> k) & 31)::INT + 1, 1)), '')), '') AS payload_digest
  FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS has_request FROM f
"""
QUERIES |= {"op7_warc": op7_warc}
ORACLES |= {"op7_warc": OP7_SQL}


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY("word_bpe_49k.json"))


QUERIES |= {"op6_packing": op6_packing}


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, by a network learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = classifier.train(docs, table(spark, sf_dir, "labels"))
    return classifier.classify(docs, model).select(
        "_row.doc_id", classifier.held_out(F.col("_row.doc_id")).alias("held_out"), "score", "predicted")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector."""
    return knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES |= {"op1_quality": op1_quality, "op3_top_k": op3_top_k}
OP3_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64.0::DOUBLE * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT * FROM v WHERE vec_id % 20 = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e::DOUBLE[], v.e::DOUBLE[])::BIGINT AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
ORACLES |= {"op3_top_k": OP3_SQL}


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and benchmark items that every document shares with the benchmark, by windows of 10 words."""
    found = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS span
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT rid, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS span
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN sizes ON len(w) >= n)),
found AS (SELECT rid, i, n, span FROM doc_windows WHERE (n, span) IN (SELECT (n, span) FROM item_windows)),
hits AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM found) GROUP BY rid),
named AS (
  SELECT rid, list_sort(list(DISTINCT item)) AS items FROM (SELECT DISTINCT rid, n, span FROM found)
  JOIN item_windows USING (n, span) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid)
"""
QUERIES |= {"op13_decontamination": op13_decontamination}
ORACLES |= {"op13_decontamination": OP13_SQL}


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector; every 7th row's label is moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


OP12_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_dot_product(a.e::DOUBLE[], v.e::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
         vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM ranked WHERE rank <= 10
"""
QUERIES |= {"op12_hard_negatives": op12_hard_negatives}
ORACLES |= {"op12_hard_negatives": OP12_SQL}


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, as the hash of conversation and turn says."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    k, text = F.col("k"), F.coalesce("text", F.lit(" "))
    return (conversations.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("k")).where(k != 0)
            .select("conv_id", "turn", F.when(k == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                    F.when(k == 1, "").when(k == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                    F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
            .drop("_copy"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations")
    report, _ = repair.repair(damaged(rows))
    every = rows.groupBy("conv_id").agg(F.lit("").alias("audit"))  # also those that lost all rows
    whole = report.unionByName(every, allowMissingColumns=True).groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.max("audit").alias("audit"), F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    return whole


QUERIES |= {"op11_conversation_repair": op11_conversation_repair}
