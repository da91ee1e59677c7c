"""Application tables derived from the star-schema tables, used by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def loan_wide(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: key, time, 0/1 target, numeric and category features with gaps.

    No join hints: nation is small enough for Spark to broadcast by size, customer is
    sort-merged when it is not.
    """
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("apply_no"),
            F.col("o_orderdate").alias("apply_time"),
            F.date_format("o_orderdate", "yyyy-MM").alias("month"),
            (price + (key * 7919) % 300000 < 300000).cast("int").alias("target"),
            F.when(key % 10 != 0, price).alias("f_price"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("f_bal"),
            F.when(key % 50 == 0, price).alias("f_sparse"),
            (2 * price + key % 7).alias("f_price2"),
            F.col("c_nationkey").alias("f_nation"),
            F.col("o_orderpriority").alias("c_prio"),
            F.when(key % 13 != 0, F.col("c_mktsegment")).alias("c_seg"),
            F.col("n_name").alias("c_nat"),
            (1 / (1 + F.exp((price - 300000) / 100000))).alias("p"),
        )
    )


LOAN_SQL = """
lw AS (
  SELECT o_orderkey AS apply_no, o_orderdate AS apply_time, strftime(o_orderdate, '%Y-%m') AS month,
    CASE WHEN o_totalprice + (o_orderkey * 7919) % 300000 < 300000 THEN 1 ELSE 0 END AS target,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS f_price,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS f_bal,
    CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice END AS f_sparse,
    2 * o_totalprice + o_orderkey % 7 AS f_price2,
    c_nationkey AS f_nation, o_orderpriority AS c_prio,
    CASE WHEN o_orderkey % 13 <> 0 THEN c_mktsegment END AS c_seg, n_name AS c_nat,
    1 / (1 + exp((o_totalprice - 300000) / 100000)) AS p
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

TRAIN_UNTIL = "1998-01-01"
TEST_UNTIL = "1999-07-01"


def with_time_split(df: DataFrame) -> DataFrame:
    """train / test / oot by application date."""
    from riskloom.operators.split import time_split

    return time_split(df, "apply_time", TRAIN_UNTIL, TEST_UNTIL)


SPLIT_SQL = f"""
ls AS (
  SELECT *, CASE WHEN apply_time < TIMESTAMP '{TRAIN_UNTIL}' THEN 'train'
    WHEN apply_time < TIMESTAMP '{TEST_UNTIL}' THEN 'test' ELSE 'oot' END AS type FROM lw
)"""


def doc_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents: target = toxic, numeric length, categories language and source."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars", "lang", "source")
    labels = table(spark, folder, "labels")
    return docs.join(labels, "doc_id").select(
        "doc_id", F.col("toxic").alias("target"), "n_chars", "lang", "source", "quality"
    )


DOC_SQL = """
dq AS (
  SELECT d.doc_id, l.toxic AS target, d.n_chars, d.lang, d.source, l.quality
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""
