"""Population stability of columns and of scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scoring import psi_term, to_score
from riskloom.operators.cut import bin_number, interval_label
from riskloom.operators.hist import as_number, text_histogram

# Thirteen score bins of width 50; a score of 950 or more has no bin.
SCORE_EDGES = tuple(range(300, 951, 50))
SUBTOTAL = "[sum]"


def psi_detail(current: DataFrame, base: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, current_share, base_share); null counts as a value.

    One aggregate over both frames: a single shuffle for all columns, combined map-side,
    so a dominating value costs one row per task.
    """
    # The base rows carry a 1 as target: its sum counts them, the rest are current rows.
    sides = current.select(*features, F.lit(0).alias("is_base")).unionByName(base.select(*features, F.lit(1).alias("is_base")))
    counts = text_histogram(sides, features, "is_base").select(
        "feature", "value", (F.col("n") - F.col("bad")).alias("current_n"), F.col("bad").alias("base_n")
    )
    totals = counts.groupBy("feature").agg(
        F.sum("current_n").alias("current_all"), F.sum("base_n").alias("base_all")
    )
    return counts.join(F.broadcast(totals), "feature").select(  # one row per feature
        "feature",
        "value",
        F.when(F.col("current_n") > 0, F.try_divide("current_n", "current_all")).alias("current_share"),
        F.when(F.col("base_n") > 0, F.try_divide("base_n", "base_all")).alias("base_share"),
    )


def psi_of_columns(current: DataFrame, base: DataFrame, features: Sequence[str], epsilon: float | None = None) -> DataFrame:
    """(feature, psi). Values on one side only add nothing, unless ``epsilon`` stands in for their share."""
    detail = psi_detail(current, base, features)
    x, y = F.col("current_share"), F.col("base_share")
    if epsilon:
        x, y = F.coalesce(x, F.lit(epsilon)), F.coalesce(y, F.lit(epsilon))
    return detail.groupBy("feature").agg(F.coalesce(F.sum(psi_term(x, y)), F.lit(0.0)).alias("psi"))


def score_psi_detail(
    df: DataFrame, scores: Sequence[str], batch: str, split: str, splits: Sequence[str] = ("train", "test")
) -> DataFrame:
    """Per (batch, feature, bin): share of each split and its PSI against train, then a subtotal row.

    ``scores`` are probability columns, scaled first. Shares are over scored rows,
    so scores outside all bins stay in the denominator.
    """
    if "train" not in splits:
        raise ValueError("score PSI needs the split 'train'")
    n_bins = len(SCORE_EDGES) - 1
    wide = df.select(batch, split, *[to_score(as_number(df, c)).alias(c) for c in scores])
    long = wide.unpivot([batch, split], list(scores), "feature", "score").where(F.col("score").isNotNull())
    counts = long.groupBy(batch, "feature", split, bin_number(F.col("score"), SCORE_EDGES).alias("bin_id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # From here on at most batches x features x splits x 14 rows.
    held = counts.groupBy(batch, "feature").pivot(split, list(splits)).sum("n")
    held = held.select(batch, "feature", *[F.col(s).alias(f"{s}_all") for s in splits])
    names = F.array(*[F.lit(interval_label(a, b)) for a, b in zip(SCORE_EDGES, SCORE_EDGES[1:])])
    grid = held.withColumn("bin_id", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
    per_bin = counts.where(F.col("bin_id").isNotNull()).groupBy(batch, "feature", "bin_id").pivot(split, list(splits)).sum("n")
    detail = grid.join(per_bin, [batch, "feature", "bin_id"], "left").select(
        batch,
        "feature",
        F.get(names, F.col("bin_id")).alias("bin"),
        *[(F.coalesce(F.col(s), F.lit(0)) / F.col(f"{s}_all")).alias(f"{s}_pct") for s in splits],
    )
    others = [s for s in splits if s != "train"]
    detail = detail.withColumns(
        {f"train_{s}_psi": psi_term(F.col("train_pct"), F.col(f"{s}_pct")) for s in others}
    )
    measures = [f"{s}_pct" for s in splits] + [f"train_{s}_psi" for s in others]
    total = detail.groupBy(batch, "feature").agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures])
    return detail.unionByName(total.withColumn("bin", F.lit(SUBTOTAL)))


def score_psi(
    df: DataFrame, scores: Sequence[str], batch: str, split: str, splits: Sequence[str] = ("train", "test")
) -> DataFrame:
    """(batch, feature, train_<split>_psi...)."""
    detail = score_psi_detail(df, scores, batch, split, splits)
    return detail.where(F.col("bin") == SUBTOTAL).select(
        batch, "feature", *[f"train_{s}_psi" for s in splits if s != "train"]
    )
