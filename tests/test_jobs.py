import pytest
from pyspark.sql import functions as F

from riskloom.operators.split import stratified_split
from riskloom.plans import model
from riskloom.plans.fixtures import loan_wide
from riskloom.plans.jobs import TrainingPlan, apply_encodings, label_rows, model_statistics, score_batch, score_report, train
from riskloom.roles import Roles
from riskloom.session import scratch_path
from riskloom.streaming.scoring import read_arrivals, write_scored

FEATURES = ["f_price", "f_bal", "f_nation"]
SMALL = model.TreeParams(n_estimators=4, max_depth=3)
RANGES = {**model.SEARCH_RANGES, "n_estimators": (2, 5), "max_depth": (2, 3)}
ROLES = Roles(ignore=("p", "month"))


@pytest.fixture(scope="module")
def wide(spark, sf):
    return loan_wide(spark, sf).cache()


@pytest.fixture(scope="module")
def parts(wide):
    df = stratified_split(wide.select("apply_no", "target", *FEATURES), "apply_no", "target").cache()
    return df.where("type = 'train'"), df.where("type = 'test'")


@pytest.fixture(scope="module")
def trained(spark, wide):
    folder = scratch_path(spark, "test-training")
    plan = TrainingPlan(
        "demo", "demo", drop=("p", "month"), sweep=SMALL, sweep_rates=(0.5, 1.0), init_points=2, iterations=1,
        ranges=RANGES, top=3, bin_method="equal_freq",
    )
    return train(wide, ROLES, plan, folder), folder


def test_single_feature_models_find_the_signal(parts):
    got = {r["feature"]: (r["auc"], r["ks"]) for r in model.single_feature_models(parts[0], FEATURES, "target", SMALL).collect()}
    assert got["f_price"][0] > 0.8 and got["f_price"][1] > 0.5
    assert all(auc > 0.51 for auc, _ in got.values())


def test_single_feature_models_read_the_table_once_and_grow_the_trees_of_the_rows(spark, parts):
    rows = parts[0].select("target", "f_nation", (F.col("f_price") / 40000).cast("int").alias("f_step")).toPandas()
    rows = [tuple(None if x != x else int(x) for x in r) for r in rows.to_numpy()]
    df = spark.createDataFrame(rows, "target int, f_nation int, f_step int")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    params = model.TreeParams(n_estimators=6, max_depth=3, min_child_weight=20)
    plain = model.TreeParams(n_estimators=6, max_depth=3)
    watched = df.mapInPandas(counted, df.schema)
    got = {r["feature"]: (r["auc"], r["ks"]) for r in model.single_feature_models(watched, ["f_nation", "f_step"], "target", plain, 0.0).collect()}
    assert seen.value == len(rows)
    for feature in ("f_nation", "f_step"):
        for setting in (plain, params):
            frame = model.training_frame(df, [feature], "target")
            want = model._score_frame(model.fit_trees(frame, [feature], "target", setting), frame, "target")
            frame.unpersist()
            if setting is plain:
                assert got[feature] == pytest.approx(want)
            else:
                own = model.single_feature_models(df, [feature], "target", setting, 0.0).first()
                assert (own["auc"], own["ks"]) == pytest.approx(want, abs=1e-6)


def test_a_feature_of_many_values_is_fitted_by_several_tasks(spark, monkeypatch):
    rows = [(i % 900 / 7, int(i % 900 > 500) ^ (i % 13 == 0), i % 5) for i in range(1800)]
    df = spark.createDataFrame(rows, "many double, target int, few int")
    fit, held = model.fit_trees, {}

    def watched(frame, features, *rest):
        held[features[0]] = frame.rdd.glom().map(lambda p: len({r[0] for r in p})).collect()
        return fit(frame, features, *rest)

    monkeypatch.setattr(model, "fit_trees", watched)
    monkeypatch.setattr(model, "FIT_VALUES", 100, raising=False)
    spread = {r["feature"]: (r["auc"], r["ks"]) for r in model.single_feature_models(df, ["many", "few"], "target", SMALL, 0.0).collect()}
    assert sum(held["many"]) == 900 and max(held["many"]) < 200 and sum(held["few"]) == 5
    monkeypatch.setattr(model, "FIT_VALUES", 10**6, raising=False)
    for feature, metrics in spread.items():
        whole = model.single_feature_models(df, [feature], "target", SMALL, 0.0).first()
        assert (whole["auc"], whole["ks"]) == pytest.approx(metrics)


def test_importances(spark, parts):
    imp, metrics = model.sweep_importance(*parts, FEATURES, "target", (0.4, 1.0), SMALL)
    weights = {r["feature"]: r["mean_imp"] for r in imp.collect()}
    assert max(weights, key=weights.get) == "f_price"
    assert all(r["train_auc"] > 0.7 for r in metrics.collect()) and metrics.count() == 2
    folds, aucs = model.fold_importance(parts[0], "apply_no", FEATURES, "target", 3, SMALL)
    assert "f_price" in {r["feature"] for r in folds.collect()} and aucs.count() == 3
    accuracy = [r["accuracy"] for r in model.fold_accuracy(parts[0], "apply_no", FEATURES, "target", 3, SMALL).collect()]
    assert len(accuracy) == 3 and min(accuracy) > 0.7


def test_rows_are_scored_once_per_cell(spark, parts, monkeypatch):
    frame = model.training_frame(parts[0], FEATURES, "target")
    fit = model.fit_trees(frame, FEATURES, "target", model.TreeParams(n_estimators=2, max_depth=2))
    points = model.split_points(spark, fit)
    cells = model._cells(frame, FEATURES, "target", points)
    n, bad = cells.agg(F.sum("n"), F.sum("bad")).first()
    assert (n, bad) == tuple(frame.agg(F.count("target"), F.sum("target")).first())
    assert cells.count() < n / 2
    by_cell = model._score_frame(fit, frame, "target")
    monkeypatch.setattr(model, "MAX_CELLS", 0)
    assert by_cell == pytest.approx(model._score_frame(fit, frame, "target"), abs=1e-12)
    frame.unpersist()


def test_fits_on_many_rows_run_one_after_the_other(monkeypatch):
    import threading

    together, most, lock = [0], [0], threading.Lock()

    def work(i):
        with lock:
            together[0] += 1
            most[0] = max(most[0], together[0])
        threading.Event().wait(0.05)
        with lock:
            together[0] -= 1
        return i

    monkeypatch.setattr(model, "ROWS_AT_ONCE", 100)
    assert model._side_by_side(work, range(8), 99) == list(range(8)) and most == [1]
    assert model._side_by_side(work, range(8), 5) == list(range(8)) and 1 < most[0] <= model.PARALLEL_FITS


def test_search_returns_its_best_trial(parts):
    fit, trials = model.search_trees(*parts, FEATURES, "target", 2, 2, RANGES)
    assert len(trials) == 4
    assert fit is max(trials, key=lambda t: t.objective).fit
    assert all(2 <= t.params.n_estimators <= 5 and 2 <= t.params.max_depth <= 3 for t in trials)


def test_split_counts_match_the_node_table(spark, parts):
    frame = model.training_frame(parts[0], FEATURES, "target")
    fit = model.fit_trees(frame, FEATURES, "target", SMALL)
    nodes = model.node_table(spark, fit)
    imp = model.importance(spark, fit)
    assert nodes.where("feature_index is not null").count() == imp.agg(F.sum("weight")).first()[0]
    assert nodes.select("tree").distinct().count() == SMALL.n_estimators
    frame.unpersist()


def test_training_reports(trained):
    result, _ = trained
    report = result.reports["report"].first()
    assert report["train_auc"] > 0.7 and report["test_auc"] > 0.7
    assert report["feature_cnt"] == len(result.features) <= 3
    assert {r["type"] for r in result.reports["by_split"].collect()} == {"train", "test", "oot", "cv"}
    assert "f_sparse" not in result.features  # 98 % missing
    assert set(result.categories) == {"c_prio", "c_seg", "c_nat"}
    assert [step for _, step, _, _ in result.audit] == ["read", "without empty rows"]
    psi = result.reports["psi"].first()["train_test_psi"]
    assert 0 <= psi < 0.1


def test_scoring_reproduces_training_scores(spark, wide, trained):
    result, folder = trained
    keys = result.scored.where("type = 'test'").select("apply_no")
    scored = score_batch(spark, wide.drop("p"), folder, ROLES, keys)
    assert scored.count() == keys.count()
    both = scored.join(result.scored.select("apply_no", F.col("p").alias("q")), "apply_no")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-12
    report = score_report(scored, ROLES)
    assert report["metrics"].first()["auc"] > 0.7 and report["describe"].first()["coverage"] == 1


def test_training_files(spark, trained):
    result, folder = trained
    assert spark.read.parquet(f"{folder}/score").count() == result.scored.count()
    assert spark.read.option("header", True).csv(f"{folder}/test_keys").count() == result.scored.where("type = 'test'").count()
    assert spark.read.option("header", True).csv(f"{folder}/sample").count() == 100
    assert "booster[0]:" in spark.read.text(f"{folder}/trees.txt").first()["value"]
    for name in result.reports:
        assert spark.read.parquet(f"{folder}/reports/{name}").columns


def test_stream_scores_like_a_batch(spark, wide, trained):
    _, folder = trained
    arrivals, out = scratch_path(spark, "arrivals"), scratch_path(spark, "scored")
    wide.drop("p").repartition(5).write.parquet(arrivals)
    stream = read_arrivals(spark, arrivals, spark.read.parquet(arrivals).schema, files_per_batch=2)
    write_scored(score_batch(spark, stream, folder, ROLES).select("apply_no", "p", "score"), out).awaitTermination()
    batch = score_batch(spark, wide.drop("p"), folder, ROLES).select("apply_no", "p", "score")
    got = spark.read.parquet(out)
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0


def test_labels_of_clean_and_of_repeated_keys(spark, wide):
    clean, _ = label_rows(wide, ROLES, 0.25)
    assert "ExistingRDD" not in clean._jdf.queryExecution().toString() and clean.count() == wide.count()
    twice = wide.unionByName(wide)
    labelled, _ = label_rows(twice, ROLES, 0.25)
    assert labelled.count() == twice.count()
    assert labelled.groupBy("apply_no").agg(F.countDistinct("type").alias("n")).where("n > 1").count() == 0
    assert labelled.select("apply_no", "type").distinct().exceptAll(clean.select("apply_no", "type")).count() == 0


def test_statistics_use_lower_case_labels(wide):
    df = stratified_split(wide, "apply_no", "target").withColumn("type", F.upper("type"))
    reports = model_statistics(df, "p", ROLES, "a", "b", 1, 2)
    row = reports["report"].first()
    assert row["train_auc"] is not None and row["test_ks"] is not None
    assert reports["by_month"].count() == wide.select("month").distinct().count()


def test_large_dictionaries_and_null_targets(spark):
    from riskloom.operators.split import stratified_folds, stratified_split
    from riskloom.operators.woe import INLINE_ENTRIES, encode_dictionary

    n = INLINE_ENTRIES + 50
    table = spark.range(n).selectExpr("'c' AS feature", "cast(id AS string) AS key", "id * 0.5D AS woe")
    table = table.unionByName(spark.sql("SELECT 'd' AS feature, 'x' AS key, 2.0D AS woe"))
    rows = spark.createDataFrame([("7", "x"), (str(n - 1), "y"), ("none", None)], "c string, d string")
    got = [tuple(r) for r in encode_dictionary(rows, table, ["c", "d"]).orderBy("c").collect()]
    assert set(got) == {(3.5, 2.0), ((n - 1) * 0.5, None), (None, None)}

    df = spark.range(100).selectExpr("id", "CASE WHEN id % 10 = 0 THEN NULL ELSE cast(id % 3 = 0 AS int) END AS t")
    folds = stratified_folds(df, "id", "t", 5).groupBy("t", "fold").count().collect()
    assert sum(r["count"] for r in folds) == 100
    assert stratified_split(df, "id", "t", 0.3).where("type = 'test' AND t IS NULL").count() == 3


@pytest.mark.parametrize("encoding,by", [("label", "folds"), ("top", "sweep")])
def test_branches_of_a_training_run(spark, wide, encoding, by):
    """Time split, other encodings and importance over folds; scoring repeats them from the folder, unseen and missing categories included."""
    folder = scratch_path(spark, "branches")
    plan = TrainingPlan(
        "demo", "demo", drop=("p", "month", "f_price2"), sweep=SMALL, sweep_rates=(1.0,), init_points=1, iterations=0, ranges=RANGES, top=None,
        time_limits=("1997-01-01", "1999-01-01"), encoding=encoding, top_categories=3, importance_by=by, folds=2,
    )
    result = train(wide, ROLES, plan, folder)
    parts = {r["type"]: r["count"] for r in result.scored.groupBy("type").count().collect()}
    times = wide.selectExpr("CASE WHEN apply_time < '1997-01-01' THEN 'train' WHEN apply_time < '1999-01-01' THEN 'test' ELSE 'oot' END AS t")
    assert parts == {r["t"]: r["count"] for r in times.groupBy("t").count().collect()}
    assert f"{by}_metrics" in result.reports and result.reports["split_rates"].count() == 3
    again = score_batch(spark, wide.drop("p"), folder, ROLES).select("apply_no", F.col("p").alias("q")).join(result.scored.select("apply_no", "p"), "apply_no")
    assert again.count() == wide.count() and again.where("p <> q").count() == 0
    odd = wide.limit(3).withColumn("c_seg", F.lit("never seen"))
    coded = apply_encodings(spark, odd, folder, None, plan.fill)
    if encoding == "label":
        assert {r["c_seg"] for r in coded.select("c_seg").collect()} == {-1.0}
        codes = {r["c_prio"] for r in apply_encodings(spark, wide, folder, None, plan.fill).select("c_prio").distinct().collect()}
        assert codes == {0.0, 1.0, 2.0, 3.0, 4.0}
    else:
        table = {r["key"]: r["woe"] for r in spark.read.parquet(f"{folder}/categories").where("feature = 'c_seg'").collect()}
        assert len(table) == 4 and {r["c_seg"] for r in coded.select("c_seg").collect()} == {table["other"]}


def test_unknown_branches_are_refused():
    with pytest.raises(ValueError, match="encoding"):
        TrainingPlan("a", "b", encoding="hash")
    with pytest.raises(ValueError, match="importance_by"):
        TrainingPlan("a", "b", importance_by="luck")


def test_sketches_of_batches(spark, wide):
    """Merged months equal the whole table, a month that comes again replaces itself, quantiles are near."""
    import numpy as np

    from riskloom.operators import sketches

    folder = scratch_path(spark, "sketches")
    columns = ["f_price", "f_bal", "f_sparse"]
    rows = wide.withColumn("f_bal", F.col("f_bal") + 1e9)
    made = sketches.batch_sketches(rows, columns, "month", 400)
    months = sorted(r["batch"] for r in made.select("batch").distinct().collect())
    for part in (months[:40], months[40:], months[39:41]):
        sketches.store_sketches(made.where(F.col("batch").isin(part)), folder)
    stored = sketches.read_sketches(spark, folder)
    assert stored.count() == 3 * len(months)
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    for r in sketches.describe_sketches(sketches.merge_sketches(stored), probs).collect():
        x = np.sort(np.array([v[0] for v in rows.select(r["feature"]).where(f"{r['feature']} IS NOT NULL").collect()]))
        assert (r["count"], r["min"], r["max"]) == (len(x), x[0], x[-1])
        assert r["mean"] == pytest.approx(x.mean()) and r["std"] == pytest.approx(x.std(ddof=1))
        for p, q in zip(probs, r["quantiles"]):
            assert abs((x <= q).mean() - p) < 0.05
    yearly = sketches.merge_sketches(stored.withColumn("year", F.substring("batch", 1, 4)), ["year"])
    assert yearly.agg(F.sum("n")).first()[0] == stored.agg(F.sum("n")).first()[0] and yearly.count() == 3 * len({m[:4] for m in months})
    empty = sketches.describe_sketches(sketches.merge_sketches(sketches.batch_sketches(rows.where("false"), columns, "month"))).collect()
    assert empty == []


def test_second_stream_run_goes_on(spark, tmp_path):
    from riskloom.streaming.scoring import read_arrivals, write_scored

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for first in (0, 10):
        spark.range(first, first + 10).write.mode("append").parquet(src)
        write_scored(read_arrivals(spark, src, spark.range(1).schema), out).awaitTermination()
    assert spark.read.parquet(out).count() == 20


def test_drift_counts_late_rows_once_after_a_restart(spark, tmp_path):
    """Rows within the watermark are counted whenever they come, later ones are not, and a repeated batch changes nothing."""
    import datetime
    import glob

    from riskloom.operators.cut import INF
    from riskloom.streaming import drift
    from riskloom.streaming.scoring import read_arrivals

    day = datetime.datetime(2024, 3, 1)
    hours = lambda *hs: [(day + datetime.timedelta(hours=h), float(h % 7) if h % 5 else None) for h in hs]
    source, folder, kind = str(tmp_path / "in"), str(tmp_path / "out"), "ts timestamp, value double"
    edges = [-INF, 2.0, 4.0, INF]

    def arrive(rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
        stream = read_arrivals(spark, source, spark.createDataFrame([], kind).schema, files_per_batch=1)
        drift.follow_counts(drift.window_counts(stream, "ts", "value", edges, "6 hours", "24 hours"), folder).awaitTermination()

    def counted():
        return {(r["started"], r["bin"]): r["n"] for r in drift.latest_counts(spark, folder).collect()}

    first, late, far, lost = hours(*range(0, 30)), hours(9, 10, 20, 21), hours(70, 71), hours(1, 2)
    for rows in (first, late, far, lost):
        arrive(rows)
    kept = spark.createDataFrame(first + late + far, kind)
    want = {(r["started"], r["bin"]): r["n"] for r in drift.window_counts(kept, "ts", "value", edges, "6 hours").collect()}
    assert counted() == want
    # A batch that is written again replaces its own folder.
    again = sorted(glob.glob(f"{folder}/counts/batch=*"))[0]
    table = spark.read.parquet(again)
    table.write.parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.mode("overwrite").parquet(again)
    assert counted() == want
    base = spark.createDataFrame([(0, 5), (1, 5), (2, 5), (None, 5)], "bin int, n long")
    out = drift.window_psi(drift.latest_counts(spark, folder), base).collect()
    assert len(out) == len({s for s, _ in want}) and all(r["psi"] >= 0 for r in out) and sum(r["n"] for r in out) == len(first + late + far)
