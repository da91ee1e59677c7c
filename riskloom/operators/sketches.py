"""Describe statistics that are kept per batch and merged, so that old batches are never read again.

A batch leaves one row per feature: count, mean, centred sum of squares, least, largest, and a quantile sketch of its values.
Rows of any number of batches merge to the row of all their values. Count, mean, deviation, least and largest are those of the values;
a quantile is off in rank by about 1.33 % of the rows at the default size of a sketch (K = 200), by 0.17 % at K = 2,000, with
a confidence of 99 %; :func:`riskloom.operators.profile.describe_numbers` is the exact form. Sketches and their merging are Spark's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.hist import as_number
from riskloom.operators.profile import PERCENTILES

K = 2000


def batch_sketches(df: DataFrame, columns: Sequence[str], batch: str, k: int = K) -> DataFrame:
    """(batch, feature, n, mean, spread, least, largest, sketch) of each batch in ``df``; one scan, one row per task, batch and feature shuffled."""
    long = df.select(F.col(batch).alias("batch"), *[as_number(df, c).alias(c) for c in columns]).unpivot(["batch"], list(columns), "feature", "value")
    return long.groupBy("batch", "feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("spread"),
        F.min("value").alias("least"), F.max("value").alias("largest"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"),
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, n, mean, spread, least, largest, sketch) over all batches."""
    keys = [*by, "feature"]
    whole = sketches.groupBy(*keys).agg(F.sum(F.col("n") * F.col("mean")).alias("total"), F.sum("n").alias("size"))
    middle = whole.select(*[F.col(c).alias(f"{c}__") for c in keys], F.try_divide("total", "size").alias("middle"))
    same = [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in keys]
    met = sketches.join(F.broadcast(middle) if not by else middle, same)  # one row per feature
    off = F.col("mean") - F.col("middle")
    return met.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("middle").alias("mean"), F.sum(F.col("spread") + F.col("n") * off * off).alias("spread"),
        F.min("least").alias("least"), F.max("largest").alias("largest"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def describe_sketches(merged: DataFrame, probs: Sequence[float] = PERCENTILES) -> DataFrame:
    """(..., feature, count, mean, std, min, max, quantiles); null without values."""
    keys = [c for c in merged.columns if c not in ("n", "mean", "spread", "least", "largest", "sketch")]
    cuts = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs]))
    return merged.select(
        *keys, F.col("n").alias("count"), "mean", F.sqrt(F.try_divide("spread", F.col("n") - 1)).alias("std"),
        F.col("least").alias("min"), F.col("largest").alias("max"), F.when(F.col("n") > 0, cuts).alias("quantiles"),
    )


def store_sketches(sketches: DataFrame, folder: str) -> None:
    """One folder per batch; a batch that comes again replaces its own."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(folder)


def read_sketches(spark: SparkSession, folder: str) -> DataFrame:
    kinds = "feature string, n bigint, mean double, spread double, least double, largest double, sketch binary, batch string"
    return spark.read.schema(kinds).parquet(folder)
