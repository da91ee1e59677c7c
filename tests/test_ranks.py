import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.hist import histogram, numeric_histogram
from riskloom.operators.prefix import locate, quantiles, rank_histogram
from riskloom.operators.rankm import auc_ks, feature_metrics, metrics_by_split, require_two_classes, running_shares, score_metrics


def rows(n=3000, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hot = rng.random() < 0.35  # a third of all rows share one value
        x = 7.0 if hot else round(rng.gauss(0, 5), 2)
        out.append((i, x, rng.choice([1.0, 2.0, 3.0]), int(rng.random() < 0.3 + 0.02 * x), rng.choice(["train", "test"])))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), "k int, a double, b double, target int, type string").cache()


def brute_auc(x, y):
    bad, good = x[y == 1], x[y == 0]
    return np.mean([(b > good).mean() + 0.5 * (b == good).mean() for b in bad])


def brute_ks(x, y):
    return max(abs((x[y == 1] <= v).mean() - (x[y == 0] <= v).mean()) for v in np.unique(x))


def test_locate_counts_edges_at_or_below(spark):
    edges = [-3.0, 0.0, 0.5, 2.0, 8.0]
    df = spark.createDataFrame([(x,) for x in (-9.0, -3.0, 0.4, 0.5, 7.9, 8.0, 99.0)], "v double")
    for size in (5, 6, 17):
        got = locate(df.withColumn("e", F.lit(edges)), "e", "v", "n", size).collect()
        assert [r["n"] for r in got] == [int(np.searchsorted(edges, r["v"], side="right")) for r in got]


@pytest.mark.parametrize("task_rows", [10**6, 40, 3])
def test_running_counts_do_not_depend_on_buckets(frame, task_rows):
    pdf = frame.toPandas()
    ranked = rank_histogram(numeric_histogram(frame, ["a", "b"], "target"), ["feature"], task_rows=task_rows)
    got = ranked.rows.toPandas()
    for f in ("a", "b"):
        part = got[got.feature == f].sort_values("value").reset_index(drop=True)
        want = pdf.groupby(f)["target"].agg(["count", "sum"])
        assert part["value"].tolist() == want.index.tolist()
        assert part["n_before"].tolist() == (want["count"].cumsum() - want["count"]).tolist()
        assert part["bad_before"].tolist() == (want["sum"].cumsum() - want["sum"]).tolist()
        assert part["next_value"].tolist()[:-1] == want.index.tolist()[1:]
        assert part["next_value"].isna().tolist()[-1]
        assert set(part["n_total"]) == {len(pdf)} and set(part["bad_total"]) == {pdf["target"].sum()}


@pytest.mark.parametrize("task_rows", [10**6, 3])
def test_ranks_of_text(spark, task_rows):
    words = [f"customer#{i:05d}" for i in range(400)] + ["a", "é", "zz"]
    df = spark.createDataFrame([("t", w, 1, 0) for w in words], "feature string, value string, n bigint, bad bigint")
    few = [("u", w, 1, 0) for w in ("q", "p")]  # next to a large group, likely without any splitter
    df = df.union(spark.createDataFrame(few, df.schema))
    got = rank_histogram(df, ["feature"], task_rows=task_rows).rows.select("feature", "value", "n_before").collect()
    want = {("t", w): i for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}
    assert {(r["feature"], r["value"]): r["n_before"] for r in got} == {**want, ("u", "p"): 0, ("u", "q"): 1}


@pytest.mark.parametrize("task_rows", [10**6, 25])
def test_quantiles_are_exact(frame, task_rows):
    probs = [0.0, 0.01, 0.1, 0.5, 0.75, 0.99, 1.0]
    x = np.array([r["a"] for r in frame.select("a").collect()])
    hist = numeric_histogram(frame, ["a"], "target")
    got = {r["prob"]: r["quantile"] for r in quantiles(rank_histogram(hist, ["feature"], task_rows=task_rows), probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(x, p), abs=1e-12)


@pytest.mark.parametrize("task_rows", [10**6, 50])
def test_auc_and_ks_against_brute_force(frame, task_rows):
    pdf = frame.toPandas()
    got = {r["type"]: r for r in score_metrics(frame, "a", "target", ["type"], task_rows=task_rows).collect()}
    for name, part in pdf.groupby("type"):
        x, y = part["a"].to_numpy(), part["target"].to_numpy()
        assert got[name]["auc"] == pytest.approx(brute_auc(x, y))
        assert got[name]["ks"] == pytest.approx(brute_ks(x, y))
    every = feature_metrics(frame, ["a", "b"], "target", task_rows=task_rows).collect()
    for r in every:
        assert r["auc"] == pytest.approx(brute_auc(pdf[r["feature"]].to_numpy(), pdf["target"].to_numpy()))


def test_binary_score_has_ks_two_auc_minus_one(spark):
    df = spark.createDataFrame([(646, 1)] * 12 + [(646, 0)] * 60 + [(643, 1)] * 10 + [(643, 0)] * 70, "s int, target int")
    auc, ks = require_two_classes(score_metrics(df, "s", "target", bounded=True))
    assert ks == pytest.approx(2 * auc - 1)


def test_one_class_gives_null_in_groups_and_raises_alone(spark):
    df = spark.createDataFrame([("2020-01", 0.2, 0), ("2020-01", 0.3, 0), ("2020-02", 0.1, 0), ("2020-02", 0.4, 1)], "m string, p double, target int")
    got = {r["m"]: (r["auc"], r["ks"]) for r in score_metrics(df, "p", "target", ["m"]).collect()}
    assert got == {"2020-01": (None, None), "2020-02": (1.0, 1.0)}
    with pytest.raises(ValueError):
        require_two_classes(score_metrics(df.where("m = '2020-01'"), "p", "target"))
    with pytest.raises(ValueError):
        require_two_classes(score_metrics(df.where("m = 'none'"), "p", "target"))


def test_split_report_lists_all_four_labels(frame):
    got = {r["type"]: r["auc"] for r in metrics_by_split(frame, "a", "target", "type").collect()}
    assert set(got) == {"train", "test", "oot", "cv"} and got["oot"] is None and got["cv"] is None and got["train"] is not None


def test_running_shares_end_at_one(frame):
    got = running_shares(frame, "a", "target").orderBy("a").collect()
    assert got[0]["cum_bad_share"] == 1 and got[0]["cum_good_share"] == 1 and got[0]["gap"] == 0
    _, ks = require_two_classes(score_metrics(frame, "a", "target"))
    assert max(r["gap"] for r in got) == pytest.approx(ks)


def test_missing_scores_are_left_out(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1), (None, 1), (float("nan"), 0)], "p double, target int")
    row = auc_ks(rank_histogram(histogram(df.select(F.lit("x").alias("feature"), F.nanvl("p", F.lit(None).cast("double")).alias("value"), "target"), "target", ["feature"]), ["feature"])).first()
    assert (row["auc"], row["n"]) == (1.0, 2)


@pytest.mark.parametrize("task_rows", [10**6, 30])
def test_evidence_of_raw_values(spark, frame, task_rows):
    """The same table as windows over each feature give, in buckets, and with exchanges computed anew."""
    from riskloom.operators.woe import raw_woe_table, value_counts_as_bins, woe_table

    want = {(r["feature"], r["lo"]): r for r in woe_table(value_counts_as_bins(frame, ["a", "b"], "target")).collect()}
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = raw_woe_table(frame, ["a", "b"], "target", task_rows=task_rows).collect()
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        assert len(got) == len(want)
        for r in got:
            other = want[r["feature"], r["lo"]]
            assert set(r.asDict()) == set(other.asDict())
            for name, x in r.asDict().items():
                assert x == other[name] or x == pytest.approx(other[name], rel=1e-9, abs=1e-12), name


def test_evidence_of_raw_values_is_never_one_task_for_a_feature(spark, frame, monkeypatch):
    import re

    from riskloom.operators import prefix, woe

    plans, keep = [], woe.materialize
    monkeypatch.setattr(woe, "materialize", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, label))
    woe.raw_woe_table(frame, ["a", "b"], "target", task_rows=30).collect()
    assert len(plans) == 1 and prefix.TASK_ROWS > 30
    over_rows = [w for w in re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]", plans[0])]
    assert any("bucket" in keys for keys, _ in over_rows)
    assert all("bucket" in keys or "bucket" in order for keys, order in over_rows if "value" in order or order)
