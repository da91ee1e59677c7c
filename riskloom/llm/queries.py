"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    alignment, bitpack, bottomk, byte_bpe, exact_sql, kmeans_tree, nbsvm, packing, perspectives, projection_passes, residual_packing, secrets,
    segment_filter, substring_dedup,
)
from riskloom.llm.common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(rows).withColumn("removed", F.col("removed").cast("string"))


def op2_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.packed_checksums(bitpack.write_packed(table(spark, sf_dir, "documents"), WORD_BPE))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return kmeans_tree.TreeIndex(rows).search(kmeans_tree.usable(rows).where("vec_id % 50 = 0"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op5_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.perspectives(table(spark, sf_dir, "conversations")).withColumn("mask", perspectives.mask_text("mask"))


PERSPECTIVES_SQL = r"""
WITH broken AS (
  SELECT conv_id, coalesce(turn, 4611686018427387904) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
turns AS (
  SELECT conv_id, role, regexp_replace(text, '<\|(im_start|im_end)\|>', '<\\|\1\\|>', 'g') AS text,
    translate(regexp_replace(role, '<\|(im_start|im_end)\|>', '<\\|\1\\|>', 'g'), chr(13) || chr(10), '  ') AS name,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, substring(text, 1, 64), md5(text)) - 1 AS place FROM broken),
speakers AS (SELECT DISTINCT conv_id, role AS participant FROM turns WHERE role <> 'system'),
segments AS (
  SELECT t.conv_id, participant, place, place // 64 AS part, t.role = participant AS own, text || '<|im_end|>' AS body,
    '<|im_start|>' || CASE WHEN t.role = participant THEN 'assistant' WHEN t.role = 'system' THEN 'system' ELSE 'user name=' || name END || chr(10) AS head
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, head || body || chr(10) AS segment, sum(length(head) + length(body) + 1) OVER (
    PARTITION BY conv_id, participant, part ORDER BY place) - length(body) - 1 AS start FROM segments)
SELECT conv_id, participant, CAST(part AS BIGINT) AS part, count(*) AS n_turns, string_agg(segment, '' ORDER BY place) AS text,
  coalesce(string_agg(start || ':' || (start + length(body)), ',' ORDER BY place) FILTER (WHERE own), '') AS mask
FROM placed GROUP BY conv_id, participant, part"""


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_checksums(packing.pack(table(spark, sf_dir, "documents"), WORD_BPE))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80).drop("text_hash")


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_passes.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = nbsvm.score(docs.withColumn("held_out", nbsvm.held_out()), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_texts(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)[0]


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return segment_filter.hard_negatives(rows.withColumn("label", moved), "vec_id % 100 = 0")


HARD_NEGATIVES_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
    CAST(list_inner_product(a.vec, r.vec) AS BIGINT) AS score
  FROM whole a JOIN whole r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 5"""


def op13_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residual_packing.with_checksums(residual_packing.pack(table(spark, sf_dir, "documents"), WORD_BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_packed_ids, op3_nearest, op4_secrets, op5_perspectives,
        op6_packing, op7_near_duplicates, op8_near_vectors, op9_byte_bpe, op10_quality, op11_alignment,
        op12_hard_negatives, op13_residual_packing,
    )
}
ORACLES: dict[str, str] = {
    "op5_perspectives": PERSPECTIVES_SQL, "op7_near_duplicates": exact_sql.NEAR_DUPLICATES, "op8_near_vectors": exact_sql.NEAR_VECTORS,
    "op12_hard_negatives": HARD_NEGATIVES_SQL,
}
