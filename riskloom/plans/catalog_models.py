"""Registered queries: model jobs and streaming. Fits are checked by properties, not by SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scoring import to_score
from riskloom.operators.binning import BinRules
from riskloom.operators.cut import INF, cut_columns
from riskloom.operators.split import stratified_split
from riskloom.operators.woe import category_woe_table, encode_categories, woe_by_category
from riskloom.plans import model
from riskloom.plans.catalog_tables import BALANCE_CUTS, CATEGORY_SQL, EDGES, HASH_SQL, PRICE_CUTS, STRATIFIED_SQL, TREES, TREE_SQL, WITH, WITH_SPLIT
from riskloom.plans.fixtures import TEST_UNTIL, TRAIN_UNTIL, loan_wide, table
from riskloom.plans.jobs import TrainingPlan, apply_encodings, score_batch, score_report, train
from riskloom.plans.registry import N, R, auc_sql, edges_sql, query, rounded, score_sql
from riskloom.roles import Roles
from riskloom.session import materialize, scratch_path
from riskloom.sources.params import categories_to_json
from riskloom.sources.tables import read_keys
from riskloom.sources.treedump import dump_lines, parse_dump, read_dump, score_dump, write_dump
from riskloom.streaming import drift
from riskloom.streaming.scoring import read_arrivals, write_scored

FEATURES = ["f_price", "f_bal", "f_nation"]
SMALL = model.TreeParams(n_estimators=5, max_depth=3)
SMALL_RANGES = {**model.SEARCH_RANGES, "n_estimators": (3, 8), "max_depth": (2, 4)}


def _sample(spark, sf):
    """Labelled frame, stored once for the split and the fits."""
    wide, _ = materialize(loan_wide(spark, sf).select("apply_no", "apply_time", "target", *FEATURES), "model-sample")
    return stratified_split(wide, "apply_no", "target")


def _parts(df):
    return df.where(F.col("type") == "train"), df.where(F.col("type") == "test")


def _small_fit(df, features=FEATURES):
    frame = model.training_frame(_parts(df)[0], features, "target")
    try:
        return model.fit_trees(frame, features, "target", SMALL)
    finally:
        frame.unpersist()


@query("boosted_tree_scores")
def boosted_tree_scores(spark, sf):
    df = _sample(spark, sf)
    return rounded(_small_fit(df).predict(df).select("apply_no", "target", "type", "p", to_score("p").alias("score")))


@query("saved_model_scores", f"{WITH} SELECT apply_no, true AS agrees FROM lw")
def saved_model_scores(spark, sf):
    """Every row scores the same with the fitted and with the stored and loaded model."""
    df = _sample(spark, sf)
    path = scratch_path(spark, "saved-model")
    fit = _small_fit(df)
    fit.save(path)
    both = model.load_trees(spark, path).predict(fit.predict(df, "p"), "stored")
    return both.select("apply_no", (F.col("p") == F.col("stored")).alias("agrees"))


@query("tree_dump_export", f"{WITH} SELECT apply_no, true AS agrees FROM lw")
def tree_dump_export(spark, sf):
    """Export a fitted ensemble as text, read it back: every row scores the same with both."""
    df = _sample(spark, sf)
    fit = _small_fit(df)
    path = scratch_path(spark, "dump")
    write_dump(spark, dump_lines(model.node_table(spark, fit), fit.features), path)
    filled = fit.predict(df.na.fill(fit.fill, subset=FEATURES))
    both = score_dump(filled, read_dump(spark, path), "from_dump")
    return both.select("apply_no", (F.abs(F.col("p") - F.col("from_dump")) < 1e-9).alias("agrees"))


@query("split_importances")
def split_importances(spark, sf):
    return rounded(model.importance(spark, _small_fit(_sample(spark, sf))))


@query("sweep_importance")
def sweep_importance(spark, sf):
    imp, _ = model.sweep_importance(*_parts(_sample(spark, sf)), FEATURES, "target", base=model.TreeParams(5, 3, min_child_weight=10))
    return rounded(imp)


@query("fold_importance")
def fold_importance(spark, sf):
    imp, _ = model.fold_importance(_parts(_sample(spark, sf))[0], "apply_no", FEATURES, "target", 10, model.TreeParams(3, 3))
    return rounded(imp)


@query("fold_accuracy")
def fold_accuracy(spark, sf):
    return rounded(model.fold_accuracy(_parts(_sample(spark, sf))[0], "apply_no", FEATURES, "target", 5, SMALL))


@query("single_feature_models")
def single_feature_models(spark, sf):
    """Every numeric feature by its own counts."""
    wide = loan_wide(spark, sf)
    sample, _ = materialize(stratified_split(wide, "apply_no", "target"), "model-sample")
    return rounded(model.single_feature_models(_parts(sample)[0], [*FEATURES, "f_sparse", "f_price2", "p"], "target", SMALL))


@query("parameter_search")
def parameter_search(spark, sf):
    _, trials = model.search_trees(*_parts(_sample(spark, sf)), FEATURES, "target", 3, 4, SMALL_RANGES)
    return rounded(model.trial_table(spark, trials))


# One tree of one split on features of few values: what it must find can be said in SQL.
STUMP = model.TreeParams(n_estimators=1, max_depth=1)
STEPS = ["f_nation", "s_prio", "s_month"]
STEP_SQL = f"""{WITH}, {STRATIFIED_SQL},
sm AS (SELECT apply_no, target, type, f_nation, CAST(c_prio[1] AS INTEGER) AS s_prio, month(apply_time) AS s_month FROM st),
sf AS (SELECT *, CASE WHEN type = 'train' THEN CAST(len(list_filter(range(1, 5), lambda i: i * n // 5 < place)) AS INTEGER) END AS fold
  FROM (SELECT *, count(*) OVER (PARTITION BY type, target) AS n, row_number() OVER (PARTITION BY type, target ORDER BY {HASH_SQL}) AS place FROM sm)),
sl AS (SELECT apply_no, target, type, fold, unnest({STEPS}) AS feature, unnest([f_nation, s_prio, s_month]) AS v FROM sf)"""


def _stump_sql(rows: str) -> str:
    """The best split of each run in ``rows`` (run, feature, v, target), and the mean of the outcomes as -1 and 1 on either side."""
    return f"""sh AS (SELECT run, feature, v, count(*) AS n, sum(2 * target - 1) AS s FROM ({rows}) GROUP BY ALL),
sc AS (SELECT run, feature, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY run, feature) AS nt, sum(s) OVER (PARTITION BY run, feature) AS st
  FROM sh WINDOW w AS (PARTITION BY run, feature ORDER BY v)),
sb AS (SELECT run, feature, v AS cut, CAST(sl AS DOUBLE) / nl AS below, CAST(st - sl AS DOUBLE) / (nt - nl) AS above FROM sc WHERE nl < nt
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY CAST(sl AS DOUBLE) * sl / nl + CAST(st - sl AS DOUBLE) * (st - sl) / (nt - nl) DESC) = 1)"""


FOLD_SQL = "SELECT r AS run, feature, v, target FROM sl, range(5) x(r) WHERE type = 'train' AND fold <> r"


def _steps(spark, sf):
    wide = loan_wide(spark, sf)
    steps = [F.substring("c_prio", 1, 1).cast("int").alias("s_prio"), F.month("apply_time").alias("s_month")]
    return materialize(stratified_split(wide.select("apply_no", "target", "f_nation", *steps), "apply_no", "target"), "steps")[0]


@query("stump_scores", f"{STEP_SQL}, {_stump_sql('SELECT 0 AS run, feature, v, target FROM sl WHERE type = ' + chr(39) + 'train' + chr(39))} "
       f"SELECT apply_no, {R('1 / (1 + exp(-2 * CASE WHEN v <= cut THEN below ELSE above END))', 'p')} FROM sl JOIN sb USING (feature)")
def stump_scores(spark, sf):
    """Scores of a boosted fit that SQL can repeat."""
    df = _steps(spark, sf)
    frame = model.training_frame(_parts(df)[0], STEPS, "target")
    try:
        fit = model.fit_trees(frame, STEPS, "target", STUMP)
    finally:
        frame.unpersist()
    return rounded(fit.predict(df).select("apply_no", "p"))


@query("stump_fold_accuracy", f"{STEP_SQL}, {_stump_sql(FOLD_SQL)} SELECT CAST(fold AS INTEGER) AS fold, "
       f"{R('avg(CASE WHEN (CASE WHEN v <= cut THEN below ELSE above END > 0) = (target = 1) THEN 1.0 ELSE 0 END)', 'accuracy')} "
       "FROM sl JOIN sb ON sl.feature = sb.feature AND fold = run GROUP BY fold")
def stump_fold_accuracy(spark, sf):
    return rounded(model.fold_accuracy(_parts(_steps(spark, sf))[0], "apply_no", STEPS, "target", 5, STUMP))


@query("stump_fold_importance", f"{STEP_SQL}, {_stump_sql(FOLD_SQL)} SELECT feature, 1.0::DOUBLE AS mean_imp FROM sb GROUP BY feature")
def stump_fold_importance(spark, sf):
    """Features that a split uses in any of five fits; each uses one, so the mean over the runs that use it is one."""
    imp, _ = model.fold_importance(_parts(_steps(spark, sf))[0], "apply_no", STEPS, "target", 5, STUMP)
    return rounded(imp)


@query("single_feature_stumps", f"{STEP_SQL}, {_stump_sql('SELECT feature AS run, feature, v, target FROM sl WHERE type = ' + chr(39) + 'train' + chr(39))}, "
       "sp AS (SELECT feature, target, CASE WHEN v <= cut THEN below ELSE above END AS p FROM sl JOIN sb USING (feature) WHERE type = 'train'), "
       f"{auc_sql('sp', 'feature', 'p', 'm')} SELECT g AS feature, {R('auc', 'auc')}, {R('ks', 'ks')} FROM m WHERE auc > 0.5")
def single_feature_stumps(spark, sf):
    """One-feature models on weighted counts, with AUC and KS that SQL can repeat."""
    return rounded(model.single_feature_models(_parts(_steps(spark, sf))[0], STEPS, "target", STUMP, 0.5))


ALL_SQL = _stump_sql("SELECT 0 AS run, feature, v, target FROM sl WHERE type = 'train'")
P_SQL = "sq AS (SELECT apply_no, target, type, 1 / (1 + exp(-2 * CASE WHEN v <= cut THEN below ELSE above END)) AS p FROM sl JOIN sb USING (feature))"
BY_TYPE = auc_sql("sq", "type", "p", "m")
# Ranges of one point: every trial is the same stump.
STUMP_RANGES = {k: (v, v) for k, v in {"min_child_weight": 1, "max_depth": 1, "n_estimators": 1, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 1.0, "gamma": 0.0}.items()}


def _auc_of(part: str, what: str) -> str:
    return f"max({what}) FILTER (WHERE g = '{part}')"


@query("stump_split_counts", f"""{STEP_SQL}, {ALL_SQL},
t AS (SELECT avg(2 * target - 1) AS m, count(*) AS n FROM sl WHERE type = 'train' AND feature = 'f_nation'),
c AS (SELECT feature, count(*) FILTER (WHERE v <= cut) AS nl, count(*) AS n, any_value(below) AS a, any_value(above) AS b FROM sl JOIN sb USING (feature) WHERE type = 'train' GROUP BY feature)
SELECT feature, CAST(1 AS BIGINT) AS weight, {R('(1 - m * m) - (nl * (1 - a * a) + (c.n - nl) * (1 - b * b)) / c.n', 'gain')}, {R('c.n', 'cover')} FROM c, t""")
def stump_split_counts(spark, sf):
    frame = model.training_frame(_parts(_steps(spark, sf))[0], STEPS, "target")
    try:
        return rounded(model.importance(spark, model.fit_trees(frame, STEPS, "target", STUMP)))
    finally:
        frame.unpersist()


@query("stump_sweep_metrics", f"{STEP_SQL}, {ALL_SQL}, {P_SQL}, {BY_TYPE} SELECT CAST(1.0 AS DOUBLE) AS rate, "
       + ", ".join(R(_auc_of(t, x), f"{t}_{x}") for t in ("train", "test") for x in ("auc", "ks")) + " FROM m")
def stump_sweep_metrics(spark, sf):
    _, metrics = model.sweep_importance(*_parts(_steps(spark, sf)), STEPS, "target", (1.0,), STUMP)
    return rounded(metrics)


@query("stump_search", f"{STEP_SQL}, {ALL_SQL}, {P_SQL}, {BY_TYPE}, o AS (SELECT {_auc_of('train', 'auc')} AS a, {_auc_of('test', 'auc')} AS b FROM m) "
       f"SELECT CAST(i AS INTEGER) AS trial, {R('a', 'train_auc')}, {R('b', 'test_auc')}, {R('100 * b - 2 ** abs(100 * b - 100 * a)', 'objective')} FROM o, range(5) r(i)")
def stump_search(spark, sf):
    """The search over ranges of one point: two independent trials and three around the best."""
    _, trials = model.search_trees(*_parts(_steps(spark, sf)), STEPS, "target", 2, 3, STUMP_RANGES)
    return rounded(model.trial_table(spark, trials).select("trial", "train_auc", "test_auc", "objective"))


def _stump_plan(batch: str) -> TrainingPlan:
    return TrainingPlan("demo", batch, sweep=STUMP, sweep_rates=(1.0,), init_points=1, iterations=0, ranges=STUMP_RANGES, top=None)


def _stump_wide(spark, sf):
    return _steps(spark, sf).drop("type").withColumn("apply_time", F.lit("2024-01-01"))


@query("training_report", f"{STEP_SQL}, {ALL_SQL}, {P_SQL}, ss AS (SELECT type, target, {score_sql('p')} AS score FROM sq), {auc_sql('ss', 'type', 'score', 'm')} "
       "SELECT 'demo' AS project_name, 'report' AS client_batch, 'p' AS feature, "
       + ", ".join(R(_auc_of(t, x), f"{t}_{x}") for x in ("auc", "ks") for t in ("test", "train"))
       + ", 3 AS feature_cnt, 1 AS n_estimators FROM m")
def training_report(spark, sf):
    """Metrics of a whole training run, from the wide table through split, sweeps, pruning and search."""
    return rounded(train(_stump_wide(spark, sf), Roles(), _stump_plan("report")).reports["report"])


@query("held_out_scores", f"{STEP_SQL}, {ALL_SQL}, {P_SQL} SELECT apply_no, {R('p', 'p')}, {score_sql('p')} AS score FROM sq WHERE type = 'test'")
def held_out_scores(spark, sf):
    """The held-out keys of a training run, scored from its folder."""
    folder, wide = scratch_path(spark, "held-out"), _stump_wide(spark, sf)
    train(wide, Roles(), _stump_plan("scored"), folder)
    keys = read_keys(spark, f"{folder}/test_keys", "bigint")
    return rounded(score_batch(spark, wide, folder, Roles(), keys).select("apply_no", "p", "score"))


ROLES = Roles(ignore=("p", "month"))


@query("training_job")
def training_job(spark, sf):
    plan = TrainingPlan(
        "demo", "demo", drop=("p", "month"), sweep=model.TreeParams(3, 3, min_child_weight=10), sweep_rates=(0.5, 1.0),
        init_points=2, iterations=2, ranges=SMALL_RANGES, top=4,
    )
    return rounded(train(loan_wide(spark, sf), ROLES, plan, scratch_path(spark, "training")).reports["report"])


@query("scoring_job")
def scoring_job(spark, sf):
    """Parameters saved from a fit on train, then applied to the held-out keys."""
    folder = scratch_path(spark, "scoring")
    wide = loan_wide(spark, sf).drop("p")
    ready = stratified_split(wide, "apply_no", "target")
    train_rows, test_rows = _parts(ready)
    woe = category_woe_table(train_rows, ["c_prio", "c_seg"], "target")
    categories_to_json(woe, folder)
    features = [*FEATURES, "c_prio", "c_seg"]
    coded = encode_categories(ready, woe_by_category(woe)).select("apply_no", "target", "type", *features)
    _small_fit(coded, features).save(f"{folder}/trees")
    keys = test_rows.select("apply_no")
    return rounded(score_batch(spark, wide, folder, ROLES, keys).select("apply_no", "target", "p", "score"))


@query("training_branches", f"{WITH_SPLIT} SELECT type, CAST(count(*) AS BIGINT) AS n, CAST(sum(target) AS BIGINT) AS bad, true AS agrees FROM ls GROUP BY type")
def training_branches(spark, sf):
    """The other branches of a training run: split by time, ordinal codes, importance over folds; rows of each part, and whether scoring agrees."""
    wide = loan_wide(spark, sf).select("apply_no", "apply_time", "target", "f_price", "f_bal", "c_seg", "c_prio")
    plan = TrainingPlan(
        "demo", "branches", time_limits=(TRAIN_UNTIL, TEST_UNTIL), encoding="label", importance_by="folds", folds=3, sweep=SMALL,
        init_points=1, iterations=1, ranges=SMALL_RANGES,
    )
    folder = scratch_path(spark, "branches")
    result = train(wide, Roles(), plan, folder)
    both = score_batch(spark, wide, folder, Roles()).select("apply_no", F.col("p").alias("q")).join(result.scored, "apply_no")
    agree = both.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("target").cast("bigint")).alias("bad"), F.bool_and(F.col("p") == F.col("q")).alias("agrees"))
    return agree.select("type", "n", "bad", "agrees")


@query("batch_score_report", f"{WITH}, sc AS (SELECT *, {score_sql('p')} AS score FROM lw), {auc_sql('sc', chr(39) + 'all' + chr(39), 'score', 'm')}, "
       f"d AS (SELECT {N('count(score)', 'count')}, {R('avg(score)', 'mean')}, {R('stddev_samp(score)', 'std', 5)}, {R('min(score)', 'min')}, {R('max(score)', 'max')}, "
       f"{R('count(score) / CAST(count(*) AS DOUBLE)', 'coverage')} FROM sc) SELECT {R('auc', 'auc')}, {R('ks', 'ks')}, {N('n', 'n')}, {N('bad', 'bad')}, d.* FROM m, d")
def batch_score_report(spark, sf):
    """Report of a scored batch whose outcomes are known."""
    scored = loan_wide(spark, sf).withColumn("score", to_score("p"))
    report = score_report(scored, ROLES)
    described = report["describe"].select("count", "mean", F.round("std", 5).alias("std"), "min", "max", "coverage")
    return rounded(report["metrics"].select("auc", "ks", "n", "bad").crossJoin(described))  # one row each


# Prices as numbers that agree in four digits, so that bins lie closer than their short labels tell.
NEAR_FEATURE = "f_near"
NEAR_SQL = f"""{WITH}, nw AS (SELECT *, 10 + f_price * 1e-9 AS x FROM lw WHERE f_price IS NOT NULL OR f_bal IS NOT NULL), {STRATIFIED_SQL.replace('FROM lw', 'FROM nw')},
q AS (SELECT list_sort(list_distinct(quantile_cont(x, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])))[2:] AS e FROM st WHERE type = 'train' AND x IS NOT NULL),
nb AS (SELECT st.*, CASE WHEN x IS NULL THEN 0 ELSE 1 + len(list_filter(e, lambda c: c <= x)) END AS bin_id FROM st, q),
ev AS (SELECT bin_id, count(*) AS n, sum(target) AS bad FROM nb WHERE type = 'train' GROUP BY 1),
sh AS (SELECT bin_id, bad, CAST(n - bad AS DOUBLE) / sum(n - bad) OVER () AS gs, CAST(bad AS DOUBLE) / sum(bad) OVER () AS bs, n FROM ev)
SELECT apply_no, {R('CASE WHEN bad = 0 THEN 0 WHEN n = bad THEN NULL ELSE ln(gs / bs) END', 'f_near')}, true AS agrees
FROM nb LEFT JOIN sh USING (bin_id)"""


@query("narrow_bins_scored", NEAR_SQL)
def narrow_bins_scored(spark, sf):
    """Bins a few 1e-5 apart through training, its folder and scoring: the evidence that scoring uses, and whether scores agree with training."""
    wide = loan_wide(spark, sf).select("apply_no", "apply_time", "target", "f_bal", (10 + F.col("f_price") * 1e-9).alias(NEAR_FEATURE))
    plan = TrainingPlan(
        "demo", "near", bin_method="equal_freq", bin_rules=BinRules(monotonic=False), sweep=SMALL, sweep_rates=(0.5,), init_points=1,
        iterations=1, ranges=SMALL_RANGES,
    )
    folder = scratch_path(spark, "near")
    trained = train(wide, Roles(), plan, folder).scored.select("apply_no", F.col("p").alias("fitted"))
    encoded = apply_encodings(spark, wide, folder, None, plan.fill).select("apply_no", NEAR_FEATURE)
    both = score_batch(spark, wide, folder, Roles()).join(trained, "apply_no").select("apply_no", (F.col("p") == F.col("fitted")).alias("agrees"))
    return rounded(encoded).join(both, "apply_no")


# --- streaming: the same apply functions on a stream ------------------------------------------


def _arrivals(spark, sf):
    """The wide table as files arriving in a folder."""
    path = scratch_path(spark, "arrivals")
    loan_wide(spark, sf).write.parquet(path)
    stored = spark.read.parquet(path)
    return stored, read_arrivals(spark, path, stored.schema, files_per_batch=4)


@query("stream_bins_and_lookup", f"""{WITH}, {CATEGORY_SQL.format(src='lw')}
SELECT apply_no, {N(edges_sql('f_price', PRICE_CUTS), 'f_price', 'INTEGER')}, {N(edges_sql('f_bal', BALANCE_CUTS), 'f_bal', 'INTEGER')},
  {R('CASE WHEN c_seg IS NOT NULL THEN coalesce(b.woe, 0) END', 'c_seg')} FROM lw LEFT JOIN cw b ON b.feature = 'c_seg' AND b.key = c_seg""")
def stream_bins_and_lookup(spark, sf):
    stored, stream = _arrivals(spark, sf)
    mapping = woe_by_category(category_woe_table(stored, ["c_seg"], "target"))
    out = scratch_path(spark, "stream-out")
    applied = cut_columns(encode_categories(stream.select("apply_no", "f_price", "f_bal", "c_seg"), mapping), EDGES)
    write_scored(rounded(applied), out).awaitTermination()
    return spark.read.schema(applied.schema).parquet(out)


@query("stream_tree_scores", f"{WITH}, t AS (SELECT apply_no, 1 / (1 + exp(-({TREE_SQL}))) AS q FROM lw) "
       f"SELECT apply_no, {R('q', 'q', 9)}, {score_sql('q')} AS score FROM t")
def stream_tree_scores(spark, sf):
    _, stream = _arrivals(spark, sf)
    out = scratch_path(spark, "stream-scores")
    scored = score_dump(stream, parse_dump(TREES.splitlines()), "q")
    scored = scored.select("apply_no", (F.round("q", 9) + F.lit(0.0)).alias("q"), to_score("q").alias("score"))
    write_scored(scored, out).awaitTermination()
    return spark.read.schema(scored.schema).parquet(out)


VALUE_CUTS = [5.0, 10.0, 20.0, 40.0, 80.0]
DRIFT_SQL = f"""WITH e AS (SELECT date_trunc('day', ts) AS started, CASE WHEN event_id % 9 <> 0 THEN value END AS value FROM events),
b AS (SELECT started, {edges_sql('value', VALUE_CUTS)} AS bin, count(*) AS n FROM e GROUP BY 1, 2),
w AS (SELECT started, bin, n, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY started) AS x FROM b),
s AS (SELECT bin, CAST(sum(n) AS DOUBLE) / sum(sum(n)) OVER () AS y FROM b GROUP BY bin)
SELECT CAST(started AS DATE) AS started, {N('sum(n)', 'n')}, {R('sum((x - y) * ln(x / y))', 'psi', 9)} FROM w JOIN s ON w.bin IS NOT DISTINCT FROM s.bin GROUP BY 1"""


@query("stream_drift", DRIFT_SQL)
def stream_drift(spark, sf):
    """Daily stability of event values against all days, counted by a stateful stream over files that arrive one by one."""
    source, folder = scratch_path(spark, "event-files"), scratch_path(spark, "drift")
    events = table(spark, sf, "events").select("ts", F.when(F.col("event_id") % 9 != 0, F.col("value")).alias("value"))
    events.repartition(4).write.parquet(source)
    edges = [-INF, *VALUE_CUTS, INF]
    stream = read_arrivals(spark, source, events.schema, files_per_batch=1)
    drift.follow_counts(drift.window_counts(stream, "ts", "value", edges, "1 day", "400 days"), folder).awaitTermination()
    counts, _ = materialize(drift.latest_counts(spark, folder), "window-counts")
    base = counts.groupBy("bin").agg(F.sum("n").alias("n"))
    return rounded(drift.window_psi(counts, base).withColumn("started", F.to_date("started")), 9)
