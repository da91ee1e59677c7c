"""Long form and per-feature histograms: the one shuffle most operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_number(df: DataFrame, name: str) -> Column:
    """Column as double, NaN turned into null (NaN sorts above infinity in Spark)."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    return col.cast("double")


def known(df: DataFrame, name: str) -> Column:
    """Column with NaN turned into null, type unchanged."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(name), F.lit(None).cast(df.schema[name].dataType))
    return F.col(name)


def long_numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value double)."""
    return df.select(*[as_number(df, c).alias(c) for c in features]).unpivot([], list(features), "feature", "value")


def long_text(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value string)."""
    return df.select(*[known(df, c).cast("string").alias(c) for c in features]).unpivot([], list(features), "feature", "value")


def names_of(features: Sequence[str], number: Column) -> Column:
    return F.get(F.array(*map(F.lit, features)), number)


def _long(df: DataFrame, values: Sequence[Column], target: str | None) -> DataFrame:
    """(feature int, value[, target]): features travel as numbers, not as long names."""
    keep = [] if target is None else [F.col(target).alias("target__")]
    numbered = df.select(*keep, *[v.alias(str(i)) for i, v in enumerate(values)])
    ids = ["target__"] if keep else []
    long = numbered.unpivot(ids, [str(i) for i in range(len(values))], "feature", "value")
    return long.withColumn("feature", F.col("feature").cast("int"))


def _counted(long: DataFrame, features: Sequence[str], has_target: bool) -> DataFrame:
    grouped = long.groupBy("feature", "value")
    if has_target:
        bad = F.coalesce(F.sum(F.col("target__").cast("bigint")), F.lit(0)).alias("bad")
        counts = grouped.agg(F.count("target__").alias("n"), bad)
    else:
        counts = grouped.agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("feature", names_of(features, F.col("feature")))


def numeric_histogram(
    df: DataFrame, features: Sequence[str], target: str | None = None, fill: float | None = None
) -> DataFrame:
    """(feature, value double, n[, bad]) of all features: one scan of the needed columns, one shuffle.

    Counts are combined in each task first, so a hot value costs one row per task. Gaps are a
    null value, or ``fill``.
    """
    values = [as_number(df, c) if fill is None else F.coalesce(as_number(df, c), F.lit(fill)) for c in features]
    return _counted(_long(df, values, target), features, target is not None)


def text_histogram(
    df: DataFrame, features: Sequence[str], target: str | None = None, fill: str | None = None
) -> DataFrame:
    """(feature, value string, n[, bad]); the same for values as text."""
    texts = [known(df, c).cast("string") for c in features]
    values = texts if fill is None else [F.coalesce(t, F.lit(fill)) for t in texts]
    return _counted(_long(df, values, target), features, target is not None)


def text_totals(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, n, bad) over all non-null values: the sums of :func:`text_histogram` without a shuffle of the values."""
    long = _long(df, [known(df, c).cast("string") for c in features], target).where(F.col("value").isNotNull())
    return _counted(long.withColumn("value", F.lit(0)), features, True).drop("value")


def number_counts(df: DataFrame, numbers: dict[str, Column], target: str) -> DataFrame:
    """(feature, value int, n, bad) of integer expressions such as bin numbers."""
    return _counted(_long(df, list(numbers.values()), target), list(numbers), True)


def histogram(frame: DataFrame, target: str, by: Sequence[str]) -> DataFrame:
    """(by..., value, n, bad) of a frame that already has a value column."""
    return frame.groupBy(*by, "value").agg(
        F.count(target).alias("n"), F.coalesce(F.sum(F.col(target).cast("bigint")), F.lit(0)).alias("bad")
    )
