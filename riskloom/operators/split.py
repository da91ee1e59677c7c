"""Reproducible splits by hash order: same rows on any partitioning."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.profile import target_by_group
from riskloom.session import materialize

SEED = 1234
# Hex digits of the hash that each level of the search looks at: 16**3 buckets.
BUCKET_DIGITS = 3
HASH_DIGITS = 32
# Most rows that one window ranks, and most classes.
RANKED_ROWS = 1_000_000
MAX_CLASSES = 1000


def hash_order(key: str, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in a declared order.

    Spark applies the rank limit in each task before the shuffle, so a key that holds
    a large part of all rows still sends one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place__", place).where(F.col("place__") == 1).drop("place__")


def hash_cuts(df: DataFrame, key: str, target: str, places: Callable[[int], Sequence[int]], seed: int = SEED) -> dict[object, list[str | None]]:
    """Hashes of the rows at the places (from 1) that ``places(n)`` asks for in a class of n rows, in hash order; None for place 0.

    A radix search for all places of all classes at once: each level counts the next few hash digits of the buckets
    that still hold a wanted place, so it sends back classes x places x 4,096 counts at most. Once no such bucket holds more than RANKED_ROWS
    rows they alone are ranked. Windows stay that small for any table, and nothing is shuffled but counts.
    """
    h = hash_order(key, seed)
    hashed = df.select(F.col(target).alias("cls"), h.alias("h"))
    sizes = hashed.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"{target} has more than {MAX_CLASSES} classes")
    wanted = {r["cls"]: list(places(r["n"])) for r in sizes}
    found: dict[tuple[object, int], str | None] = {(c, p): None for c, ps in wanted.items() for p in ps if p < 1}
    # (class, place): bucket so far, rows before it, rows in it
    open_ = {(c, p): ("", 0) for c, ps in wanted.items() for p in ps if p > 0}
    held = {r["cls"]: r["n"] for r in sizes}
    largest, digits = max(held.values(), default=0), 0
    while open_ and largest > RANKED_ROWS and digits < HASH_DIGITS:
        inside = _inside(hashed, open_, digits)
        digits = min(digits + BUCKET_DIGITS, HASH_DIGITS)
        counts: dict[tuple[object, str], list[tuple[str, int]]] = {}
        before_digits = len(next(iter(open_.values()))[0])
        for r in inside.groupBy("cls", F.substring("h", 1, digits).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault((r["cls"], r["bucket"][:before_digits]), []).append((r["bucket"], r["n"]))
        largest = 0
        for (c, p), (bucket, before) in open_.items():
            for b, n in sorted(counts[c, bucket]):
                if before + n >= p:
                    open_[c, p] = (b, before)
                    largest = max(largest, n)
                    break
                before += n
    if open_ and digits >= HASH_DIGITS:  # rows of one and the same hash
        found |= {place: bucket for place, (bucket, _) in open_.items()}
    elif open_:
        spark = df.sparkSession
        inside = _inside(hashed, open_, digits).withColumn("bucket", F.substring("h", 1, digits))
        ranked = inside.withColumn("place", F.row_number().over(Window.partitionBy("cls", "bucket").orderBy("h")))
        kind = hashed.schema["cls"].dataType
        table = [(c, b, p - before, p) for (c, p), (b, before) in open_.items()]
        asked = spark.createDataFrame(table, T.StructType([T.StructField("c", kind), *T.StructType.fromDDL("b string, nth bigint, wanted bigint")]))
        hit = ranked.join(F.broadcast(asked), F.expr("cls <=> c AND bucket = b AND place = nth"))
        found |= {(r["cls"], r["wanted"]): r["h"] for r in hit.select("cls", "wanted", "h").collect()}  # one row per place
    return {c: [found[c, p] for p in ps] for c, ps in wanted.items()}


def _inside(hashed: DataFrame, open_: dict[tuple[object, int], tuple[str, int]], digits: int) -> DataFrame:
    """Rows in the buckets that hold a wanted place."""
    if not digits:
        return hashed
    kind = hashed.schema["cls"].dataType
    table = sorted({(c, b) for (c, _), (b, _) in open_.items()}, key=str)
    buckets = hashed.sparkSession.createDataFrame(table, T.StructType([T.StructField("c", kind), T.StructField("b", T.StringType())]))
    return hashed.join(F.broadcast(buckets), F.expr(f"cls <=> c AND substring(h, 1, {digits}) = b"), "left_semi")


def split_points(df: DataFrame, key: str, target: str, test_size: float, seed: int = SEED) -> dict[object, str]:
    """Last hash of the test part of each class."""
    cuts = hash_cuts(df, key, target, lambda n: [math.ceil(n * test_size)], seed)
    return {cls: hashes[0] for cls, hashes in cuts.items() if hashes[0] is not None}


def stratified_split(
    df: DataFrame, key: str, target: str, test_size: float = 0.25, split: str = "type", seed: int = SEED
) -> DataFrame:
    """Add train/test with ceil(test_size x n) test rows in each class; keys must be unique.

    Rows without a target are a class of their own.

    After the two cut hashes are known the label is a plain expression: the wide table
    is not shuffled, and rows of a later batch can be labelled the same way.
    """
    points = split_points(df, key, target, test_size, seed)
    h = hash_order(key, seed)
    label = F.lit("train")
    for cls, last in points.items():
        label = F.when(F.col(target).eqNullSafe(cls) & (h <= last), F.lit("test")).otherwise(label)
    return df.withColumn(split, label)


def time_split(df: DataFrame, time: str, train_until: str, test_until: str, split: str = "type") -> DataFrame:
    """train before the first limit, test before the second, oot after; no time gives no label."""
    t = F.col(time)
    return df.withColumn(
        split,
        F.when(t < F.lit(train_until), "train").when(t < F.lit(test_until), "test").when(t.isNotNull(), "oot"),
    )


def split_job(
    df: DataFrame, key: str, target: str, time: str, order: Sequence[str | Column], test_size: float = 0.25
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Deduplicate, keep 0/1 targets, add the month, split.

    Reports: rows per target value before the filter (anything besides 0 and 1 shows
    there), bad rates by month and by split.
    """
    unique, _ = materialize(keep_first(df, [key], order), "sample")  # read by the search for cuts and by all reports
    sample = unique.where(F.col(target).isin(0, 1))
    sample = sample.withColumn("apply_month", F.substring(F.col(time).cast("string"), 1, 7))
    labelled = stratified_split(sample, key, target, test_size)
    reports = {
        "classes": unique.groupBy(target).agg(F.count(F.lit(1)).alias("n")),
        "by_month": target_by_group(labelled, "apply_month", target),
        "by_split": target_by_group(labelled, "type", target),
    }
    return labelled, reports


def split_views(df: DataFrame, split: str = "type") -> dict[str, DataFrame | None]:
    """Frames of all, train, test and oot rows; train and test must have rows, oot may be missing."""
    present = {r[split] for r in df.select(split).distinct().collect()}  # a handful of labels
    for needed in ("train", "test"):
        if needed not in present:
            raise ValueError(f"no rows with {split} = {needed!r}")
    views: dict[str, DataFrame | None] = {"all": df}
    for name in ("train", "test", "oot"):
        views[name] = df.where(F.col(split) == name) if name in present else None
    return views


def stratified_folds(df: DataFrame, key: str, target: str, k: int, fold: str = "fold", seed: int = SEED) -> DataFrame:
    """Add a fold number 0..k-1, balanced to one row within each class: the class in hash order, cut into k stretches.

    Rows without a target are a class of their own. Once the k - 1 cut hashes of each class are known the fold is a plain expression, so the
    wide table is not shuffled.
    """
    cuts = hash_cuts(df, key, target, lambda n: [i * n // k for i in range(1, k)], seed)
    h, out = "fold_hash__", F.lit(0)
    for cls, hashes in cuts.items():
        # A stretch without rows lies before the first row.
        passed = sum((F.lit(1) if x is None else (F.col(h) > x).cast("int") for x in hashes), F.lit(0))
        out = F.when(F.col(target).eqNullSafe(cls), passed).otherwise(out)
    return df.withColumn(h, hash_order(key, seed)).withColumn(fold, out.cast("int")).drop(h)
