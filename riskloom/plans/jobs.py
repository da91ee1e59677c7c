"""Whole jobs: model statistics, training, batch scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scoring import month_of, to_score
from riskloom.operators.binning import Binning, BinRules, fit_bins
from riskloom.operators.columns import Audit, binary_target_rows, drop_empty_rows, fill_numeric, held_out, with_split
from riskloom.operators.encode import MISSING_TEXT, UNKNOWN, fit_labels
from riskloom.operators.profile import describe_scores, profile, target_by_group
from riskloom.operators.psi import score_psi, score_psi_detail
from riskloom.operators.rankm import metric_report, metrics_by_split, score_metrics
from riskloom.operators.select import dense_columns, drop_correlated, pairwise_corr, top_features, triage
from riskloom.operators.split import split_job, split_views, stratified_split, time_split
from riskloom.operators.woe import MISSING, UNSEEN, category_woe_table, encode_bins, encode_dictionary, top_category_woe_table
from riskloom.plans.model import (
    FittedTrees,
    TreeParams,
    fold_importance,
    importance,
    load_trees,
    node_table,
    search_trees,
    sweep_importance,
    trial_table,
)
from riskloom.roles import FILL_VALUE, Roles
from riskloom.session import materialize
from riskloom.sources.params import (
    BIN_FORMAT,
    bins_from_json,
    bins_to_json,
    read_bins,
    read_categories,
    read_settings,
    write_bins,
    write_categories,
    write_settings,
)
from riskloom.sources.tables import sample_rows, write_keys, write_report, write_scores
from riskloom.sources.treedump import dump_lines, write_dump


def model_statistics(
    scored: DataFrame,
    p: str,
    roles: Roles,
    project: str,
    batch: str,
    n_features: int,
    n_estimators: int,
    splits: Sequence[str] = ("train", "test"),
) -> dict[str, DataFrame]:
    """All reports over a scored frame. Metrics use the integer score, so ranks stay small."""
    frame = scored.select(
        roles.key,
        F.col(roles.target),
        F.lower(F.col(roles.split)).alias(roles.split),
        month_of(F.col(roles.time).cast("string")).alias("month"),
        F.col(p),
        to_score(p).alias("score"),
        F.lit(batch).alias("client_batch"),
    )
    frame, _ = materialize(frame, "scored")
    by_split = metrics_by_split(frame, "score", roles.target, roles.split, bounded=True)
    labels = {
        "project_name": project,
        "client_batch": batch,
        "feature": p,
        "feature_cnt": n_features,
        "n_estimators": n_estimators,
    }
    return {
        "by_split": by_split,
        "by_month": score_metrics(frame, "score", roles.target, ["month"], bounded=True),
        "describe": describe_scores(frame, [p, "score"]),
        "psi": score_psi(frame, [p], "client_batch", roles.split, splits),
        "psi_detail": score_psi_detail(frame, [p], "client_batch", roles.split, splits),
        "report": metric_report(by_split, roles.split, labels),
    }


@dataclass(frozen=True)
class TrainingPlan:
    """Settings of a training run."""

    project: str
    batch: str
    drop: tuple[str, ...] = ()
    test_size: float = 0.25
    missing_limit: float = 0.95
    corr_limit: float = 0.9
    top: int | None = 30
    fill: float = FILL_VALUE
    bin_method: str | None = None
    bin_rules: BinRules = field(default_factory=BinRules)
    sweep: TreeParams = field(default_factory=lambda: TreeParams(min_child_weight=10))
    sweep_rates: tuple[float, ...] = tuple(i / 10 for i in range(3, 11))
    init_points: int = 5
    iterations: int = 8
    ranges: Mapping[str, tuple[float, float]] | None = None
    # Train before the first time, test before the second, oot after, in place of a random split.
    time_limits: tuple[str, str] | None = None
    # 'woe', 'top' (evidence of the most frequent categories, the rest together) or 'label' (ordinal codes).
    encoding: str = "woe"
    top_categories: int = 10
    # 'sweep' over sampling rates or 'folds'.
    importance_by: str = "sweep"
    folds: int = 10

    def __post_init__(self):
        for name, known in (("encoding", ("woe", "top", "label")), ("importance_by", ("sweep", "folds"))):
            if getattr(self, name) not in known:
                raise ValueError(f"{name} must be one of {known}")


@dataclass(frozen=True)
class TrainingResult:
    fit: FittedTrees
    features: list[str]
    categories: list[str]
    binning: Binning | None
    reports: dict[str, DataFrame]
    scored: DataFrame
    audit: list[tuple[int, str, int, int]]


# Text that stands for a missing category, by encoding; evidence of all categories leaves it missing.
GAP_TEXT = {"woe": None, "top": MISSING, "label": MISSING_TEXT}


def fit_categories(train_rows: DataFrame, text: Sequence[str], target: str, plan: TrainingPlan) -> DataFrame | None:
    """(feature, key, woe) of the chosen encoding; for labels the number is the code, -1 for unseen ones."""
    if not text:
        return None
    if plan.encoding == "top":
        table = top_category_woe_table(train_rows, text, target, plan.top_categories)
    elif plan.encoding == "label":
        codes = fit_labels(train_rows.na.fill(MISSING_TEXT, subset=list(text)), text)
        unseen = train_rows.sparkSession.createDataFrame([(f, UNSEEN, float(UNKNOWN)) for f in text], "feature string, key string, woe double")
        table = codes.select("feature", "key", F.col("code").cast("double").alias("woe")).unionByName(unseen)
    else:
        table = category_woe_table(train_rows, text, target)
    return materialize(table, "categories")[0]


def prepare(
    df: DataFrame, dictionary: DataFrame | None, categories: Sequence[str], binning_edges: Mapping | None, bin_woe: Mapping | None,
    numeric: Sequence[str], fill: float, encoding: str = "woe",
) -> DataFrame:
    """The row-wise part shared by training and scoring: fill, encode categories, encode bins."""
    out = fill_numeric(df, numeric, fill)
    if dictionary is not None:
        gap = GAP_TEXT[encoding]
        out = out if gap is None else out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(gap)) for c in categories})
        out = encode_dictionary(out, dictionary, categories)
    return encode_bins(out, binning_edges, bin_woe) if binning_edges else out


def train(raw: DataFrame, roles: Roles, plan: TrainingPlan, folder: str | None = None) -> TrainingResult:
    """From a wide application table to a tuned model, its reports and, with ``folder``, its files."""
    spark = raw.sparkSession
    audit, reports = Audit(), {}
    table = audit.watch(raw.drop(*plan.drop), "read")
    features = roles.features(table)
    table = audit.watch(drop_empty_rows(table, features), "without empty rows")
    table, _ = materialize(table, "wide")  # read, joins and filters happen once, then columnar scans
    reports["profile"] = profile(table, [*features, roles.target])
    if roles.split not in table.columns and plan.time_limits:
        table = time_split(binary_target_rows(table, roles.target), roles.time, *plan.time_limits, roles.split)
        reports["split_rates"] = target_by_group(table, roles.split, roles.target)
    elif roles.split not in table.columns:
        table, split_reports = label_rows(table, roles, plan.test_size)
        reports.update(split_reports)
    train_rows = table.where(F.col(roles.split) == "train")
    reports["train_profile"] = profile(train_rows, [*features, roles.target])

    features = dense_columns(train_rows, features, plan.missing_limit)
    numeric, text, dates = triage(train_rows, features)
    features = [c for c in features if c not in dates]
    woe = fit_categories(train_rows, text, roles.target, plan)
    categories = list(text)
    binning = None
    if plan.bin_method:
        filled = fill_numeric(train_rows, numeric, plan.fill)
        binning = fit_bins(filled, numeric, roles.target, plan.bin_method, plan.bin_rules)
    ready = prepare(table, woe, categories, binning.edges if binning else None, binning.woe() if binning else None, numeric, plan.fill, plan.encoding)
    ready, _ = materialize(ready.select(roles.key, roles.time, roles.target, roles.split, *features), "ready")
    views = split_views(ready, roles.split)
    train_rows, test_rows = views["train"], views["test"]

    def rank(names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        if plan.importance_by == "folds":
            return fold_importance(train_rows, roles.key, names, roles.target, plan.folds, plan.sweep)
        return sweep_importance(train_rows, test_rows, names, roles.target, plan.sweep_rates, plan.sweep)

    first, reports[f"{plan.importance_by}_metrics"] = rank(features)
    first, _ = materialize(first, "importance")
    reports["all_importance"] = first
    weights = {r["feature"]: r["mean_imp"] for r in first.collect()}  # one per feature
    _, dropped = drop_correlated(train_rows.select(*features), weights, plan.corr_limit)
    features = [f for f in features if f not in dropped]
    second, _ = rank(features)
    reports["model_importance"] = second

    def tune(names: Sequence[str]):
        return search_trees(train_rows, test_rows, names, roles.target, plan.init_points, plan.iterations, plan.ranges)

    fit, trials = tune(features)
    split_counts, _ = materialize(importance(spark, fit), "split-counts")
    reports["first_split_counts"] = split_counts
    if plan.top:
        best = top_features(split_counts, plan.top, "weight")
        if best:
            features = best
            fit, trials = tune(features)
    reports["trials"] = trial_table(spark, trials)
    reports["split_counts"] = importance(spark, fit)
    scored, _ = materialize(fit.predict(ready, "p"), "scores")  # read by every report and sink
    reports.update(
        model_statistics(scored, "p", roles, plan.project, plan.batch, len(features), fit.params.n_estimators)
    )
    if len(features) > 0:
        reports["corr"] = pairwise_corr(scored, [*features, "p"])
    result = TrainingResult(fit, features, categories, binning, reports, scored, audit.rows())
    if folder:
        save_training(spark, result, woe, roles, plan, folder)
    return result


def label_rows(table: DataFrame, roles: Roles, test_size: float) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Attach train/test labels from the deduplicated sample.

    With unique keys and clean targets the label is an expression on the wide table;
    only otherwise is the wide table joined to the sample.
    """
    narrow = table.select(roles.key, roles.target, roles.time)
    sample, reports = split_job(narrow, roles.key, roles.target, roles.time, [roles.time, roles.target], test_size)
    target = F.col(roles.target)
    per_key = narrow.groupBy(roles.key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(target.isNull() | ~target.isin(0, 1)).alias("wrong")
    )
    worst = per_key.agg(F.max("n").alias("n"), F.sum("wrong").alias("wrong")).first()
    if worst["n"] == 1 and not worst["wrong"]:
        return stratified_split(table, roles.key, roles.target, test_size, roles.split), reports
    labels = sample.withColumnRenamed("type", roles.split)
    return materialize(with_split(table, labels, roles.key, roles.split), "labelled")[0], reports


def save_training(spark: SparkSession, result: TrainingResult, woe: DataFrame | None, roles: Roles, plan: TrainingPlan, folder: str) -> None:
    batched = result.scored.withColumn("client_batch", F.lit(plan.batch))
    write_scores(batched, roles.key, "p", "client_batch", f"{folder}/score")
    write_keys(result.scored, roles.key, f"{folder}/test_keys", roles.split)
    result.fit.save(f"{folder}/trees")
    write_dump(spark, dump_lines(node_table(spark, result.fit), result.features), f"{folder}/trees.txt")
    if woe is not None:
        write_categories(woe, folder)
    write_settings(spark, {"categories": woe is not None, "bins": bool(result.binning), "bin_format": BIN_FORMAT, "encoding": plan.encoding}, folder)
    if result.binning:
        write_bins(spark, result.binning, f"{folder}/bins")  # what scoring reads
        bins_to_json(spark, result.binning, folder)  # for other tools
    write_report(sample_rows(result.scored, result.features, roles.key), f"{folder}/sample", "csv")
    for name, report in result.reports.items():
        write_report(report, f"{folder}/reports/{name}")


def score_batch(
    spark: SparkSession,
    df: DataFrame,
    folder: str,
    roles: Roles,
    keys: DataFrame | None = None,
    use_bins: bool | None = None,
) -> DataFrame:
    """Score new rows with saved parameters: key filter, encodings, probability, integer score.

    How rows are encoded is read from the folder. ``use_bins`` is for folders written elsewhere, without settings.
    No aggregate is involved, so a stream can go through it as well.
    """
    rows = held_out(df, keys, roles.key) if keys is not None else df
    fit = load_trees(spark, f"{folder}/trees")
    rows = apply_encodings(spark, rows, folder, use_bins, fit.fill)
    return fit.predict(rows, "p").withColumn("score", to_score("p"))


def apply_encodings(spark: SparkSession, df: DataFrame, folder: str, use_bins: bool | None, fill: float) -> DataFrame:
    settings = read_settings(spark, folder) or {"categories": True, "bins": bool(use_bins)}
    use_bins = settings["bins"]
    table = read_categories(spark, folder) if settings["categories"] else None
    # One row per feature.
    names = [r["feature"] for r in table.select("feature").distinct().collect()] if table is not None else []
    categories = sorted(f for f in names if f in df.columns)
    edges, bin_woe = None, None
    if use_bins and settings.get("bin_format", 1) > 1:
        stored = read_bins(spark, f"{folder}/bins")
        edges, bin_woe = stored.edges, stored.woe()
    elif use_bins:
        edges, bin_woe = bins_from_json(spark, folder)
    numeric = [c for c in df.columns if edges and c in edges]
    return prepare(df, table, categories, edges, bin_woe, numeric, fill, settings.get("encoding", "woe"))


def score_report(scored: DataFrame, roles: Roles) -> dict[str, DataFrame]:
    """Describe of the score, and AUC and KS when labels exist."""
    out = {"describe": describe_scores(scored, ["score"])}
    if roles.target in scored.columns:
        out["metrics"] = score_metrics(scored, "score", roles.target, bounded=True)
    return out
