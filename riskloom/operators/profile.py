"""One report row per column: size, gaps, distinct values, and either moments or frequent values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scoring import percent_text
from riskloom.operators.hist import long_numeric, numeric_histogram, text_histogram
from riskloom.operators.prefix import TASK_ROWS, quantiles, rank_histogram
from riskloom.operators.select import null_counts
from riskloom.session import materialize

# Fixed values of the report layout.
PERCENTILES = (0.01, 0.1, 0.5, 0.75, 0.9, 0.99)
NUMERIC_NAMES = ("mean", "std", "min", "1%", "10%", "50%", "75%", "90%", "99%", "max")
DISCRETE_NAMES = ("top1", "top2", "top3", "top4", "top5", "bottom5", "bottom4", "bottom3", "bottom2", "bottom1")
DETAIL_NAMES = tuple(f"{a}_or_{b}" for a, b in zip(NUMERIC_NAMES, DISCRETE_NAMES))
TOP = 5


def split_kinds(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, discrete); booleans are discrete."""
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    return numeric, [c for c in columns if c not in numeric]


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, blanks, blank_text, blank_share)."""
    counted = null_counts(df, columns).withColumn("blank_share", F.try_divide("blanks", "size"))
    return counted.select("feature", "blanks", percent_text(F.col("blank_share")).alias("blank_text"), "blank_share")


def value_shape(hist: DataFrame) -> DataFrame:
    """(feature, size, missing_q, unique, value_max_percent) of a histogram that includes null."""
    size = F.sum("n")
    return hist.groupBy("feature").agg(
        size.alias("size"),
        (F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)) / size).alias("missing_q"),
        F.count("value").alias("unique"),
        (F.max("n") / size).alias("value_max_percent"),
    )


def describe_numbers(
    hist: DataFrame,
    probs: Sequence[float] = PERCENTILES,
    task_rows: int = TASK_ROWS,
    stored_rows: int | None = None,
) -> DataFrame:
    """(feature, count, mean, std, min, max, quantiles array) from a numeric histogram, exact."""
    there = hist.where(F.col("value").isNotNull()).select("feature", "value", "n")
    n, x = F.col("n").cast("double"), F.col("value")
    first = there.groupBy("feature").agg(
        F.sum("n").alias("count"), (F.sum(n * x) / F.sum(n)).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max")
    )
    off = x - F.col("mean")
    second = (
        there.join(F.broadcast(first.select("feature", "mean", "count")), "feature")  # one row per feature
        .groupBy("feature")
        .agg(F.sqrt(F.try_divide(F.sum(n * off * off), F.max("count").cast("double") - 1)).alias("std"))
    )
    ranked = rank_histogram(there.withColumn("bad", F.lit(0).cast("bigint")), ["feature"], task_rows=task_rows, stored_rows=stored_rows)
    cuts = quantiles(ranked, probs).groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("prob", "quantile"))), lambda s: s["quantile"]).alias("quantiles")
    )
    return first.join(second, "feature").join(cuts, "feature").select(
        "feature", "count", "mean", "std", "min", "max", "quantiles"
    )


def describe_numbers_approx(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = PERCENTILES, accuracy: int = 10000
) -> DataFrame:
    """The same statistics with sketched quantiles and distinct counts.

    One scan that shuffles one sketch per task and column: the choice for very wide or very
    continuous tables where exact percentiles are not worth a shuffle of all distinct values.
    """
    long = long_numeric(df, columns)
    return long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile_approx("value", F.array(*[F.lit(float(p)) for p in probs]), F.lit(accuracy)).alias("quantiles"),
        F.approx_count_distinct("value").alias("unique"),
    )


def frequent_values(hist: DataFrame, top: int = TOP) -> DataFrame:
    """(feature, kind 'top'|'bottom', place, text): most and least frequent non-null values.

    Shares are over all rows. Ties go by value; bottom is the exact reverse of top. The
    rank limit is applied in each task before the shuffle, so an identifier-like
    column sends a handful of rows per task, not all its values.
    """
    totals = hist.groupBy("feature").agg(F.sum("n").alias("size"))
    there = hist.where(F.col("value").isNotNull())
    best = Window.partitionBy("feature").orderBy(F.desc("n"), F.asc("value"))
    worst = Window.partitionBy("feature").orderBy(F.asc("n"), F.desc("value"))
    parts = [
        there.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).withColumn("kind", F.lit(kind))
        for kind, order in (("top", best), ("bottom", worst))
    ]
    return (
        parts[0]
        .unionByName(parts[1])
        .join(F.broadcast(totals), "feature")  # one row per feature
        .select(
            "feature",
            "kind",
            "place",
            F.concat("value", F.lit(":"), percent_text(F.col("n") / F.col("size"))).alias("text"),
        )
    )


def _number_text(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%.6f", F.round(c, 6)))


def profile(df: DataFrame, columns: Sequence[str] | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """The full report. Each histogram is stored once and feeds every statistic of its columns."""
    columns = list(columns or df.columns)
    numeric, discrete = split_kinds(df, columns)
    kinds = F.create_map(*[F.lit(x) for c in columns for x in (c, df.schema[c].dataType.simpleString())])
    reports = []
    if numeric:
        hist, rows = materialize(numeric_histogram(df, numeric), "profile-numeric")
        stats = describe_numbers(hist, task_rows=task_rows, stored_rows=rows)
        values = ["mean", "std", "min", *[F.get("quantiles", F.lit(i)) for i in range(len(PERCENTILES))], "max"]
        details = [
            _number_text(F.col(v) if isinstance(v, str) else v).alias(name) for v, name in zip(values, DETAIL_NAMES)
        ]
        reports.append(value_shape(hist).join(stats, "feature", "left").select("feature", "size", "missing_q", "unique", "value_max_percent", *details))
    if discrete:
        hist, _ = materialize(text_histogram(df, discrete), "profile-discrete")
        slots = frequent_values(hist).withColumn("slot", F.concat("kind", F.col("place").cast("string")))
        wide = slots.groupBy("feature").agg(
            *[F.max(F.when(F.col("slot") == s, F.col("text"))).alias(name) for s, name in zip(DISCRETE_NAMES, DETAIL_NAMES)]
        )
        reports.append(value_shape(hist).join(wide, "feature", "left"))
    out = reports[0] if len(reports) == 1 else reports[0].unionByName(reports[1])
    return out.select(
        "feature",
        F.element_at(kinds, F.col("feature")).alias("type"),
        "size",
        percent_text(F.col("missing_q")).alias("missing"),
        "missing_q",
        "unique",
        "value_max_percent",
        *DETAIL_NAMES,
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def target_by_group(df: DataFrame, group: str, target: str) -> DataFrame:
    """Describe of a 0/1 target per group: at most two distinct values, so exact percentiles are cheap."""
    t = F.col(target).cast("double")
    return df.groupBy(group).agg(
        F.count(t).alias("count"),
        F.avg(t).alias("mean"),
        F.stddev_samp(t).alias("std"),
        F.min(t).alias("min"),
        F.percentile(t, F.lit(0.25)).alias("q25"),
        F.percentile(t, F.lit(0.5)).alias("q50"),
        F.percentile(t, F.lit(0.75)).alias("q75"),
        F.max(t).alias("max"),
    )


def describe_scores(df: DataFrame, columns: Sequence[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """(feature, count, mean, std, min, q25, q50, q75, max, coverage) of probability and score columns."""
    hist, stored = materialize(numeric_histogram(df, columns), "score-describe")
    rows = hist.groupBy("feature").agg(F.sum("n").alias("rows"))
    stats = describe_numbers(hist, (0.25, 0.5, 0.75), task_rows, stored)
    return rows.join(stats, "feature", "left").select(
        "feature",
        F.coalesce("count", F.lit(0)).alias("count"),
        "mean",
        "std",
        "min",
        *[F.get("quantiles", F.lit(i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))],
        "max",
        (F.coalesce("count", F.lit(0)) / F.col("rows")).alias("coverage"),
    )
