"""Input tables and key lists, and report, score and sample outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.functions.scoring import joined_text
from riskloom.functions.seal import seal, seal_cbc
from riskloom.operators.columns import key_last


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None, form: str = "parquet") -> DataFrame:
    """Wide table. CSV takes a schema where one is known; without it the types are inferred by an extra scan."""
    if form == "csv":
        reader = spark.read.option("header", True)
        return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    reader = spark.read
    return (reader.schema(schema) if schema else reader).format(form).load(path)


def read_keys(spark: SparkSession, path: str, key_type: str = "string") -> DataFrame:
    """One-column key list with a header, as written by :func:`write_keys`."""
    return spark.read.option("header", True).schema(f"key {key_type}").csv(path)


def write_report(df: DataFrame, path: str, form: str = "parquet") -> None:
    """One folder per report, replaced as a whole."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if form == "csv" else writer.format(form).save(path)


def write_scores(df: DataFrame, key: str, score: str, batch: str, path: str) -> None:
    """Key and score under one folder per batch, so readers of a batch prune the rest.

    Only the batches in ``df`` are replaced.
    """
    (
        df.select(key, score, batch)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(batch)
        .parquet(path)
    )


def write_keys(df: DataFrame, key: str, path: str, split: str = "type", part: str = "test") -> None:
    """Keys of one split as a one-column CSV."""
    df.where(F.col(split) == part).select(key).write.mode("overwrite").option("header", True).csv(path)


def sample_rows(df: DataFrame, features: Sequence[str], key: str, n: int = 100) -> DataFrame:
    """First rows by key with the model features, key last."""
    return key_last(df.select(key, *features), key).orderBy(key).limit(n)


def delivery_sample(df: DataFrame, key: str, time: str, target: str, secret: str, legacy: bool = False) -> DataFrame:
    """(key, time, merge): 'key,time,target' encrypted with GCM; ``legacy`` gives the older CBC text format."""
    text = joined_text(key, time, target)
    return df.select(key, time, (seal_cbc if legacy else seal)(text, secret).alias("merge"))


def delivery_features(df: DataFrame, target: str, time: str, time_value: str, drop: Sequence[str] = ()) -> DataFrame:
    """Feature table without the label, with a constant time column."""
    return df.drop(target, *drop).withColumn(time, F.lit(time_value))
