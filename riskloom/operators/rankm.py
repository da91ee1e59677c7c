"""AUC and KS from ranked histograms: by split, by month, by feature, or overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.hist import as_number, histogram, numeric_histogram
from riskloom.operators.prefix import TASK_ROWS, Ranked, rank_histogram
from riskloom.roles import FILL_VALUE


def auc_ks(ranked: Ranked) -> DataFrame:
    """(by..., auc, ks, n, bad). Ties count half; KS is taken at distinct scores; one class gives null."""
    bad = F.col("bad").cast("double")
    good = (F.col("n") - F.col("bad")).cast("double")
    good_before = (F.col("n_before") - F.col("bad_before")).cast("double")
    bad_all = F.col("bad_total").cast("double")
    good_all = (F.col("n_total") - F.col("bad_total")).cast("double")
    gap = F.abs(
        F.try_divide(F.col("bad_before") + bad, bad_all) - F.try_divide(good_before + good, good_all)
    )
    return (
        ranked.rows.groupBy(*ranked.by)
        .agg(
            F.sum(bad * (good_before + good / 2)).alias("wins"),
            F.max(gap).alias("gap"),
            F.max("n_total").alias("n"),
            F.max("bad_total").alias("bad"),
        )
        .select(
            *ranked.by,
            F.try_divide("wins", F.col("bad") * (F.col("n") - F.col("bad")).cast("double")).alias("auc"),
            F.when((F.col("bad") > 0) & (F.col("bad") < F.col("n")), F.col("gap")).alias("ks"),
            "n",
            "bad",
        )
    )


def ranked_score(
    df: DataFrame,
    score: str,
    target: str,
    by: Sequence[str] = (),
    bounded: bool = False,
    task_rows: int = TASK_ROWS,
) -> Ranked:
    """Ranks of a score within each group; rows without score, target or group are left out."""
    keys = list(by) or ["everything"]
    frame = df.select(
        *(by or [F.lit("all").alias("everything")]), as_number(df, score).alias("value"), F.col(target)
    ).na.drop()
    return rank_histogram(histogram(frame, target, keys), keys, bounded, task_rows)


def score_metrics(
    df: DataFrame,
    score: str,
    target: str,
    by: Sequence[str] = (),
    bounded: bool = False,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """AUC and KS of a score per group. Set ``bounded`` for integer scores only."""
    out = auc_ks(ranked_score(df, score, target, by, bounded, task_rows))
    return out if by else out.drop("everything")


def require_two_classes(metrics: DataFrame) -> tuple[float, float]:
    """(auc, ks) of an ungrouped metric frame; raises when a class is missing."""
    row = metrics.first()
    if row is None or row["auc"] is None:
        raise ValueError("AUC needs both classes")
    return row["auc"], row["ks"]


REPORT_SPLITS = ("train", "test", "oot", "cv")


def metrics_by_split(df: DataFrame, score: str, target: str, split: str, bounded: bool = False) -> DataFrame:
    """One row for each of train, test, oot, cv; splits without rows keep null metrics."""
    labels = df.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, REPORT_SPLITS))).alias(split)
    )
    return labels.join(score_metrics(df, score, target, [split], bounded), split, "left")


def feature_metrics(
    df: DataFrame, features: Sequence[str], target: str, fill: float = FILL_VALUE, task_rows: int = TASK_ROWS
) -> DataFrame:
    """(feature, auc, ks, n, bad) with each raw feature as the score: one job for all features."""
    hist = numeric_histogram(df, features, target, fill)
    return auc_ks(rank_histogram(hist, ["feature"], task_rows=task_rows))


def metric_report(metrics: DataFrame, split: str, labels: dict, splits: Sequence[str] = ("test", "train")) -> DataFrame:
    """One row: the literal ``labels``, then <split>_auc and <split>_ks of the chosen splits."""
    wide = metrics.groupBy().agg(
        *[
            F.max(F.when(F.col(split) == s, F.col(m))).alias(f"{s}_{m}")
            for m in ("auc", "ks")
            for s in splits
        ]
    )
    text = {k: v for k, v in labels.items() if isinstance(v, str)}
    numbers = {k: v for k, v in labels.items() if k not in text}
    return wide.select(
        *[F.lit(v).alias(k) for k, v in text.items()], "*", *[F.lit(v).alias(k) for k, v in numbers.items()]
    )


def running_shares(df: DataFrame, score: str, target: str, bounded: bool = False) -> DataFrame:
    """(score, n, bad, cum_bad_share, cum_good_share, gap) over distinct scores, from the highest down."""
    rows = ranked_score(df, score, target, (), bounded).rows
    good_all, good_before = F.col("n_total") - F.col("bad_total"), F.col("n_before") - F.col("bad_before")
    cum = rows.select(
        F.col("value").alias(score),
        "n",
        "bad",
        F.try_divide(F.col("bad_total") - F.col("bad_before"), "bad_total").alias("cum_bad_share"),
        F.try_divide(good_all - good_before, good_all).alias("cum_good_share"),
    )
    return cum.withColumn("gap", F.abs(F.col("cum_bad_share") - F.col("cum_good_share")))
