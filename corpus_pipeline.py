"""A corpus pipeline: quality, near duplicates, repeated passages, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns rows that are written as Parquet and read again as the next one's docs. All but
the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bottomk, nbsvm, packing, secrets, substring_dedup
from riskloom.llm.common import broadcast_if_small, forget, free_names, release, table
from riskloom.session import materialize

QUALITY_LEAST = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out what the classifier rejects. It learns from the labelled rows of ``docs``.

    Null and empty texts get the score of a text without features; repeated rows get the same score; without labels of both kinds
    all get one score, the share of good labels, and an empty table stays empty.
    """
    model = nbsvm.fit_quality(docs, table(spark, sf_dir, "labels"))
    (score,) = free_names(docs, "score")
    scored = nbsvm.score(docs, model, out=score)
    return scored.where(F.col(score) >= QUALITY_LEAST).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the smallest by id (null last), text hash, then all columns.

    Rows without words are no copies of each other and stay; an empty table stays empty.
    """
    doc, text_hash, smallest = free_names(docs, "doc", "hash", "one")
    marked = bottomk.NearDuplicates(docs, words=5, percent=80).rows()
    keys = marked.groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("n"), F.min("chosen").alias("chosen"), F.max("n_shingles").alias("n_shingles")
    )
    keys = keys.where("NOT chosen OR n > 1 AND n_shingles > 0").select(
        F.col("doc_id").alias(doc), F.col("text_hash").alias(text_hash), "chosen"
    )
    found, _ = materialize(keys, "dropped")
    forget(marked)
    again, n = materialize(found.where("chosen").drop("chosen"), "repeated")
    match = [docs.doc_id.cast("bigint").eqNullSafe(x[doc]) & F.xxhash64(docs.text).eqNullSafe(x[text_hash]) for x in (found, again)]
    left = docs.join(found, match[0], "left_anti")
    if not n:
        return left
    # Of rows that repeat id and text one, taken map-side first.
    rows = docs.join(broadcast_if_small(again, n), match[1]).groupBy(again[doc], again[text_hash])
    least = rows.agg(F.min(F.struct(*[docs[c] for c in docs.columns])).alias(smallest))
    return left.unionByName(least.select(F.inline(F.array(smallest))))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from all documents but the first that holds them; documents left without text go.

    Null and empty texts stay; rows that repeat id and text are one document; an empty table stays empty.
    """
    cut = substring_dedup.remove_repeats(docs)
    left = cut.where("n_removed = 0 OR length(trim(text)) > 0")
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every reported span becomes ``[SECRET]``; no document goes, and ``n_chars`` follows the text.

    Null texts stay null; repeated rows are treated alike; an empty table stays empty.
    """
    (before,) = free_names(docs, "before")
    clean = secrets.redact(docs.withColumn(before, F.xxhash64("text")))
    same = F.xxhash64("text").eqNullSafe(F.col(before))
    return clean.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text"))).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids. A null text is empty and holds the end id; repeated rows are repeated documents."""
    release(spark)
    return packing.with_checksums(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("secret scans", redact_secrets),
    ("packing", pack),
]
# A classifier and a tokenizer cannot be expressed in SQL; tests/llm tests every stage on planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
