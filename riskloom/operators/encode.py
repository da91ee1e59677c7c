"""Ordinal label encoding: sorted distinct values to 0..k-1, anything else to -1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.hist import long_text
from riskloom.operators.prefix import rank_histogram
from riskloom.session import materialize

UNKNOWN = -1
MISSING_TEXT = "-1007"


def fit_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, key, code): rank of each distinct value within its column."""
    values = long_text(df, columns).where(F.col("value").isNotNull()).distinct()
    one = values.select("feature", "value", F.lit(1).alias("n"), F.lit(0).alias("bad"))
    ranked = rank_histogram(one, ["feature"])
    return ranked.rows.select("feature", F.col("value").alias("key"), F.col("n_before").cast("int").alias("code"))


def apply_labels(df: DataFrame, labels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each column by its code; unseen and null become -1. One left join per column."""
    order = df.columns
    for c in columns:
        part = labels.where(F.col("feature") == c).select(F.col("key").alias("k__"), F.col("code").alias("c__"))
        df = (
            df.join(part, F.col(c).cast("string") == F.col("k__"), "left")
            .withColumn(c, F.coalesce("c__", F.lit(UNKNOWN)).cast("int"))
            .drop("k__", "c__")
        )
    return df.select(*order)


def label_encode(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Variant with gaps as their own text: fit on train, apply to all. Returns (encoded, labels)."""
    filled = train.na.fill(MISSING_TEXT, subset=list(columns))
    labels, _ = materialize(fit_labels(filled, columns), "labels")
    return apply_labels(df.na.fill(MISSING_TEXT, subset=list(columns)), labels, columns), labels


