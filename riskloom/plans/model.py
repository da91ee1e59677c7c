"""Boosted-tree fits with Spark ML: prediction, importance, search."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskloom.functions.scoring import tuning_objective
from riskloom.operators.hist import numeric_histogram
from riskloom.operators.prefix import rank_histogram
from riskloom.operators.rankm import auc_ks, require_two_classes, score_metrics
from riskloom.operators.select import mean_importance
from riskloom.operators.split import stratified_folds
from riskloom.roles import FILL_VALUE
from riskloom.session import scratch_path

# Jobs submitted side by side; Spark shares the cluster between them.
PARALLEL_FITS = 4
# Each fit keeps its own binned copy of the rows (about 250 bytes a row): at most so many rows in the copies of fits side by side.
ROWS_AT_ONCE = 30_000_000
# Most cells that split points may cut the rows into for the rows to be counted by cell before they are scored.
MAX_CELLS = 100_000

# Search ranges of the parameters that Spark trees have.
SEARCH_RANGES = {
    "min_child_weight": (1, 300),
    "max_depth": (2, 10),
    "n_estimators": (50, 300),
    "learning_rate": (0.01, 0.2),
    "subsample": (0.4, 1.0),
    "colsample_bytree": (0.3, 1.0),
    "gamma": (0, 2.0),
}
INTEGER_PARAMS = ("max_depth", "n_estimators", "min_child_weight")
# Most values of a feature that one task of its fit holds.
FIT_VALUES = 500_000
SWEEP_RATES = tuple(i / 10 for i in range(3, 11))
LEAST_AUC = 0.51


@dataclass(frozen=True)
class TreeParams:
    n_estimators: int = 100
    max_depth: int = 3
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    gamma: float = 0.0
    min_child_weight: int = 1
    seed: int = 1

    def classifier(self, target: str, weight: str | None = None, total: float = 0.0) -> GBTClassifier:
        """With ``weight``, a row stands for that many rows of ``total``, and so does the least child weight."""
        trees = GBTClassifier(
            featuresCol="features__",
            labelCol=target,
            maxIter=int(self.n_estimators),
            maxDepth=int(self.max_depth),
            stepSize=self.learning_rate,
            subsamplingRate=self.subsample,
            featureSubsetStrategy="all" if self.colsample_bytree >= 1 else str(round(self.colsample_bytree, 6)),
            minInfoGain=self.gamma,
            minInstancesPerNode=1 if weight else max(1, int(self.min_child_weight)),
            seed=self.seed,
        )
        if not weight:
            return trees
        share = min(self.min_child_weight / max(total, 1.0), 0.499) if self.min_child_weight > 1 else 0.0
        return trees.setWeightCol(weight).setMinWeightFractionPerNode(share)


@dataclass(frozen=True)
class FittedTrees:
    model: PipelineModel
    features: tuple[str, ...]
    params: TreeParams
    fill: float = FILL_VALUE

    def predict(self, df: DataFrame, out: str = "p") -> DataFrame:
        """Append the probability of the bad class; columns of ``df`` stay as they are."""
        keep = df.columns
        ready = _numeric(df, self.features, self.fill, suffix="__in")
        scored = self.model.transform(ready)
        return scored.select(*keep, vector_to_array("probability")[1].alias(out))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        row = [(list(self.features), float(self.fill), {k: float(v) for k, v in vars(self.params).items()})]
        spark.createDataFrame(row, "features array<string>, fill double, params map<string,double>").coalesce(
            1
        ).write.mode("overwrite").json(f"{path}/about")


def load_trees(spark: SparkSession, path: str) -> FittedTrees:
    about = spark.read.schema("features array<string>, fill double, params map<string,double>").json(f"{path}/about").first()
    whole = {"n_estimators", "max_depth", "min_child_weight", "seed"}
    params = TreeParams(**{k: int(v) if k in whole else v for k, v in about["params"].items()})
    return FittedTrees(PipelineModel.load(f"{path}/model"), tuple(about["features"]), params, about["fill"])


def _numeric(df: DataFrame, features: Sequence[str], fill: float, suffix: str) -> DataFrame:
    """Filled double copies: Spark trees have no branch for missing values."""
    value = {f: F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features}
    return df.withColumns({f + suffix: F.coalesce(v, F.lit(fill)) for f, v in value.items()})


def training_frame(df: DataFrame, features: Sequence[str], target: str, fill: float = FILL_VALUE, keep: Sequence[str] = ()) -> DataFrame:
    """The columns a fit needs, filled, kept in memory and on disk for the passes that follow."""
    ready = _numeric(df, features, fill, "__in").select(*keep, F.col(target).cast("int").alias(target), *[f"{f}__in" for f in features])
    return ready.persist(StorageLevel.MEMORY_AND_DISK)


def fit_trees(
    frame: DataFrame, features: Sequence[str], target: str, params: TreeParams | None = None, fill: float = FILL_VALUE,
    weight: str | None = None, total: float = 0.0,
) -> FittedTrees:
    """Fit on a frame of :func:`training_frame`, or on one whose rows stand for ``weight`` rows of ``total``."""
    params = params or TreeParams()
    assembler = VectorAssembler(inputCols=[f"{f}__in" for f in features], outputCol="features__")
    stages = [assembler, params.classifier(target, weight, total)]
    return FittedTrees(Pipeline(stages=stages).fit(frame), tuple(features), params, fill)


def split_points(spark: SparkSession, fit: FittedTrees, nodes: DataFrame | None = None) -> dict[str, list[float]]:
    """Thresholds of each feature that a split uses, in order; a feature has fewer than the bins of the fit."""
    splits = (node_table(spark, fit) if nodes is None else nodes).where(F.col("feature_index").isNotNull())
    points = splits.groupBy("feature_index").agg(F.array_sort(F.collect_set("threshold")).alias("points"))
    return {fit.features[r["feature_index"]]: r["points"] for r in points.collect()}


def _cells(frame: DataFrame, features: Sequence[str], target: str, points: Mapping[str, Sequence[float]]) -> DataFrame:
    """Features with n and bad. A value becomes the next split point at or above it: rows that no split parts are one row."""
    cells = {}
    for f, cuts in points.items():
        value, cell = F.col(f"{f}__in"), F
        for cut in cuts:
            cell = cell.when(value <= cut, F.lit(cut))
        cells[f] = cell.otherwise(F.lit(float("inf"))).alias(f"{f}__in")
    counted = frame.select(target, *cells.values()).groupBy(*[f"{f}__in" for f in cells]).agg(
        F.count(target).alias("n"), F.coalesce(F.sum(F.col(target).cast("bigint")), F.lit(0)).alias("bad")
    )
    return counted.withColumns({f"{f}__in": F.lit(0.0) for f in features if f not in cells})


def _score_frame(
    fit: FittedTrees, frame: DataFrame, target: str, points: Mapping[str, Sequence[float]] | None = None
) -> tuple[float, float]:
    """AUC and KS. Rows are counted by the cells of the fit's split points, if these are few, and each cell is scored once."""
    points = split_points(frame.sparkSession, fit) if points is None else points
    if math.prod(len(cuts) + 1 for cuts in points.values()) > MAX_CELLS:
        scored = fit.model.transform(frame).select(target, vector_to_array("probability")[1].alias("p"))
        return require_two_classes(score_metrics(scored, "p", target))
    return _score_counts(fit, _cells(frame, fit.features, target, points))


def _score_counts(fit: FittedTrees, counts: DataFrame) -> tuple[float, float]:
    """AUC and KS over rows that stand for n rows with bad ones."""
    scored = fit.model.transform(counts).select(vector_to_array("probability")[1].alias("value"), "n", "bad")
    scores = scored.groupBy(F.lit("all").alias("everything"), "value").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    return require_two_classes(auc_ks(rank_histogram(scores, ["everything"])))


# --- importance -------------------------------------------------------------------------------


def node_table(spark: SparkSession, fit: FittedTrees) -> DataFrame:
    """(tree, weight, node, feature_index, threshold, gain, cover, left, right, prediction) of a fit."""
    path = scratch_path(spark, "trees")
    booster = fit.model.stages[-1]
    booster.write().overwrite().save(path)
    weights = [float(w) for w in booster.treeWeights]
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.when(F.col("nodeData.leftChild") >= 0, F.col("nodeData.split.featureIndex")).alias("feature_index"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("nodeData.gain").alias("gain"),
        F.col("nodeData.rawCount").alias("cover"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.prediction").alias("prediction"),
    )
    return nodes.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("tree")))


def importance(spark: SparkSession, fit: FittedTrees, nodes: DataFrame | None = None) -> DataFrame:
    """(feature, weight, gain, cover): split count and mean gain and cover of features used in a split. ``nodes`` is the :func:`node_table`, if there is one."""
    names = F.array(*map(F.lit, fit.features))
    return (
        (node_table(spark, fit) if nodes is None else nodes)
        .where(F.col("feature_index").isNotNull())
        .groupBy(F.get(names, F.col("feature_index")).alias("feature"))
        .agg(
            F.count(F.lit(1)).alias("weight"),
            F.avg("gain").alias("gain"),
            F.avg(F.col("cover").cast("double")).alias("cover"),
        )
    )


def _side_by_side(work, items: Sequence, rows: int = 0) -> list:
    """Run driver calls that submit Spark jobs a few at a time, fewer if each is a fit on very many rows; errors surface."""
    with ThreadPoolExecutor(max(1, min(PARALLEL_FITS, ROWS_AT_ONCE // max(rows, 1)))) as pool:
        return list(pool.map(work, items))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def sweep_importance(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    target: str,
    rates: Sequence[float] = SWEEP_RATES,
    base: TreeParams | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fits over rising row and column sampling rates.

    Returns (feature, mean_imp) and (rate, train_auc, train_ks, test_auc, test_ks).
    """
    spark = train.sparkSession
    base = base or TreeParams(min_child_weight=10)
    frame = training_frame(train, features, target)
    check = training_frame(test, features, target)
    rows, _ = frame.count(), check.count()  # fill the caches once, before the fits run side by side

    def run(rate: float):
        fit = fit_trees(frame, features, target, TreeParams(**{**vars(base), "subsample": rate, "colsample_bytree": rate}))
        nodes = node_table(spark, fit)
        used = importance(spark, fit, nodes).select(F.lit(rate).alias("run"), "feature", "weight")
        points = split_points(spark, fit, nodes)
        return used, (rate, *_score_frame(fit, frame, target, points), *_score_frame(fit, check, target, points))

    try:
        runs = _side_by_side(run, rates, rows)
    finally:
        frame.unpersist()
        check.unpersist()
    metrics = spark.createDataFrame(
        [m for _, m in runs], "rate double, train_auc double, train_ks double, test_auc double, test_ks double"
    )
    return mean_importance(_union([u for u, _ in runs])), metrics


def fold_importance(
    df: DataFrame, key: str, features: Sequence[str], target: str, k: int = 10, base: TreeParams | None = None
) -> tuple[DataFrame, DataFrame]:
    """One fit per fold on the other folds: (feature, mean_imp) and (fold, train_auc, valid_auc)."""
    spark = df.sparkSession
    frame = training_frame(stratified_folds(df, key, target, k), features, target, keep=["fold"])
    rows = frame.count()

    def run(fold: int):
        inside, outside = frame.where(F.col("fold") != fold), frame.where(F.col("fold") == fold)
        fit = fit_trees(inside, features, target, base)
        nodes = node_table(spark, fit)
        used = importance(spark, fit, nodes).select(F.lit(fold).alias("run"), "feature", "weight")
        points = split_points(spark, fit, nodes)
        return used, (fold, _score_frame(fit, inside, target, points)[0], _score_frame(fit, outside, target, points)[0])

    try:
        runs = _side_by_side(run, range(k), rows)
    finally:
        frame.unpersist()
    metrics = spark.createDataFrame([m for _, m in runs], "fold int, train_auc double, valid_auc double")
    return mean_importance(_union([u for u, _ in runs])), metrics


def single_feature_models(
    train: DataFrame, features: Sequence[str], target: str, base: TreeParams | None = None, least_auc: float = LEAST_AUC,
    fill: float = FILL_VALUE,
) -> DataFrame:
    """(feature, auc, ks) on train of one model per feature, those above ``least_auc``.

    One scan counts all features by value, and each fit and its metrics work on the counts of its own feature: a value with
    its good and bad rows as weights. The trees are those of the rows (row sampling, if asked for, draws values). A feature with
    about as many values as rows is written by several tasks and fitted by several, each with up to FIT_VALUES values.
    """
    spark = train.sparkSession
    path = scratch_path(spark, "feature-counts")
    numbers = {f: i for i, f in enumerate(features)}
    hist = numeric_histogram(train, features, target, fill).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r["feature"]: r["values"] for r in hist.groupBy("feature").agg(F.count(F.lit(1)).alias("values")).collect()}  # one per feature
        parts = {f: max(1, -(-sizes.get(f, 0) // FIT_VALUES)) for f in features}
        places = spark.createDataFrame([(f, i, parts[f]) for f, i in numbers.items()], "feature string, place int, parts int")
        part = F.pmod(F.xxhash64("value"), F.col("parts")).alias("part")
        placed = hist.join(F.broadcast(places), "feature").select("place", "value", "n", "bad", part).repartition("place", "part")
        placed.drop("part").write.partitionBy("place").parquet(path)
    finally:
        hist.unpersist()
    stored = spark.read.schema("value double, n bigint, bad bigint, place int").parquet(path)

    def run(feature: str):
        counts = stored.where(F.col("place") == numbers[feature]).select(F.col("value").alias(f"{feature}__in"), "n", "bad")
        dealt = counts.repartition(parts[feature], f"{feature}__in") if parts[feature] > 1 else counts
        sides = F.array(F.struct(F.lit(1).alias(target), F.col("bad").alias("weight__")), F.struct(F.lit(0).alias(target), (F.col("n") - F.col("bad")).alias("weight__")))
        frame = dealt.select(f"{feature}__in", F.inline(sides)).where("weight__ > 0").withColumn("weight__", F.col("weight__").cast("double"))
        frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            total = frame.agg(F.sum("weight__")).first()[0] or 0.0
            fit = fit_trees(frame, [feature], target, base, fill, "weight__", total)
        finally:
            frame.unpersist()
        return (feature, *_score_counts(fit, counts))

    rows = _side_by_side(run, list(features))
    out = spark.createDataFrame(rows, "feature string, auc double, ks double")
    return out.where(F.col("auc") > least_auc)


def fold_accuracy(
    df: DataFrame, key: str, features: Sequence[str], target: str, k: int = 5, base: TreeParams | None = None
) -> DataFrame:
    """(fold, accuracy) of held-out folds at a probability of one half."""
    frame = training_frame(stratified_folds(df, key, target, k), features, target, keep=["fold"])
    rows = frame.count()

    def run(fold: int):
        fit = fit_trees(frame.where(F.col("fold") != fold), features, target, base)
        held = fit.model.transform(frame.where(F.col("fold") == fold))
        return fold, held.agg(F.avg((F.col("prediction") == F.col(target)).cast("double"))).first()[0]

    try:
        folds = _side_by_side(run, range(k), rows)
    finally:
        frame.unpersist()
    return df.sparkSession.createDataFrame(folds, "fold int, accuracy double")


# --- search -----------------------------------------------------------------------------------


@dataclass
class Trial:
    params: TreeParams
    train_auc: float
    test_auc: float
    objective: float
    fit: FittedTrees = field(repr=False)


def _draw(rng: random.Random, ranges: Mapping[str, tuple[float, float]], around: Mapping[str, float] | None, width: float) -> TreeParams:
    values = {}
    for name, (low, high) in ranges.items():
        if around is None:
            x = rng.uniform(low, high)
        else:
            reach = (high - low) * width
            x = min(high, max(low, around[name] + rng.uniform(-reach, reach)))
        values[name] = int(round(x)) if name in INTEGER_PARAMS else x
    return TreeParams(**values)


def search_trees(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    target: str,
    init_points: int = 5,
    iterations: int = 8,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    seed: int = 1,
) -> tuple[FittedTrees, list[Trial]]:
    """Seeded trials maximising the overfit-penalised test AUC; returns the best fit and all trials.

    First independent draws side by side, then rounds of draws around the best so far in a
    box that halves. All fits share one stored training frame.
    """
    ranges = dict(ranges or SEARCH_RANGES)
    rng = random.Random(seed)
    frame = training_frame(train, features, target)
    check = training_frame(test, features, target)
    rows, _ = frame.count(), check.count()

    def run(params: TreeParams) -> Trial:
        fit = fit_trees(frame, features, target, params)
        points = split_points(frame.sparkSession, fit)
        train_auc, test_auc = _score_frame(fit, frame, target, points)[0], _score_frame(fit, check, target, points)[0]
        return Trial(params, train_auc, test_auc, tuning_objective(train_auc, test_auc), fit)

    try:
        trials = _side_by_side(run, [_draw(rng, ranges, None, 1.0) for _ in range(init_points)], rows)
        width, left = 0.25, iterations
        while left > 0:
            best = max(trials, key=lambda t: t.objective)
            size = min(PARALLEL_FITS, left)
            trials += _side_by_side(run, [_draw(rng, ranges, vars(best.params), width) for _ in range(size)], rows)
            width, left = width / 2, left - size
    finally:
        frame.unpersist()
        check.unpersist()
    return max(trials, key=lambda t: t.objective).fit, trials


def trial_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    rows = [
        (i, t.train_auc, t.test_auc, t.objective, t.params.n_estimators, t.params.max_depth, t.params.learning_rate)
        for i, t in enumerate(trials)
    ]
    return spark.createDataFrame(
        rows,
        "trial int, train_auc double, test_auc double, objective double, n_estimators int, max_depth int, learning_rate double",
    )

