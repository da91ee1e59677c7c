import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import columns, encode, moments, profile, psi, select, split
from riskloom.operators.woe import (
    UNSEEN,
    category_woe_table,
    encode_categories,
    encode_top_categories,
    encode_with_table,
    top_category_woe_table,
    woe_by_category,
)
from riskloom.session import materialize


# --- categories -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def cats(spark):
    rows = [("a", 1)] * 3 + [("a", 0)] * 2 + [("b", 0)] * 4 + [("other", 1)] * 2 + [(None, 1)]
    return spark.createDataFrame(rows, "c string, target int")


def test_category_evidence_and_lookup(spark, cats):
    table = category_woe_table(cats, ["c"], "target")
    woe = woe_by_category(table)["c"]
    assert woe["a"] == pytest.approx(math.log((2 / 6) / (3 / 5)))
    assert woe["b"] == 0  # no bads
    assert woe["other"] == pytest.approx(math.log(1e-10 / (2 / 5)))  # no goods; a real category of that name keeps its own value
    assert woe[UNSEEN] == 0
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    want = [woe["a"], 0.0, None]
    assert [r["c"] for r in encode_categories(new, {"c": woe}).collect()] == want
    joined = encode_with_table(new.withColumn("i", F.monotonically_increasing_id()), table, ["c"]).orderBy("i")
    assert [r["c"] for r in joined.collect()] == want


def test_dictionaries_made_elsewhere(spark):
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    assert [r["c"] for r in encode_categories(new, {"c": {"a": 1.5, "other": -0.5}}).collect()] == [1.5, -0.5, None]
    assert [r["c"] for r in encode_categories(new, {"c": {"a": 1.5}}).collect()] == [1.5, None, None]


def test_top_category_variant(spark, cats):
    table = top_category_woe_table(cats, ["c"], "target", 2)
    woe = woe_by_category(table)["c"]
    assert set(woe) == {"a", "b", "other"}
    new = spark.createDataFrame([("b",), ("zzz",), (None,)], "c string")
    assert [r["c"] for r in encode_top_categories(new, {"c": woe}).collect()] == [woe["b"], woe["other"], woe["other"]]


def test_label_codes(spark):
    rows = [("10", "x"), ("9", "x"), ("b", None), (None, "Y"), ("9", "y"), ("B", "x")]
    df = spark.createDataFrame(rows, "code string, kind string")
    labels = encode.fit_labels(df, ["code", "kind"]).cache()
    # Text order: numbers as text, capitals first; gaps get no code.
    want = {("code", k): i for i, k in enumerate(["10", "9", "B", "b"])} | {("kind", k): i for i, k in enumerate(["Y", "x", "y"])}
    assert {(r["feature"], r["key"]): r["code"] for r in labels.where("key IS NOT NULL").collect()} == want
    new = spark.createDataFrame([(0, "9", "z"), (1, "99", "Y"), (2, "B", "w"), (3, "10", "y")], "i int, code string, kind string")
    got = encode.apply_labels(new, labels, ["code", "kind"]).orderBy("i").collect()
    assert [(r["code"], r["kind"]) for r in got] == [(1, -1), (-1, 0), (2, -1), (0, 2)]


# --- stability --------------------------------------------------------------------------------


def test_values_on_one_side_add_nothing(spark):
    current = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    base = spark.createDataFrame([("x",), ("z",), (None,)], "c string")
    assert psi.psi_of_columns(current, base, ["c"]).first()["psi"] == 0
    assert psi.psi_of_columns(current, base, ["c"], epsilon=1e-6).first()["psi"] > 1


def test_column_psi_value(spark):
    current = spark.createDataFrame([("x",)] * 8 + [("y",)] * 2, "c string")
    base = spark.createDataFrame([("x",)] * 5 + [("y",)] * 5, "c string")
    want = 0.3 * math.log(0.8 / 0.5) - 0.3 * math.log(0.2 / 0.5)
    assert psi.psi_of_columns(current, base, ["c"]).first()["psi"] == pytest.approx(want)


def test_score_psi_layout(spark):
    # 0.5 scores 795, 0.9 scores 954: above the last bin, yet part of the denominator.
    rows = [("b1", "train", 0.5)] * 6 + [("b1", "train", 0.9)] * 4 + [("b1", "test", 0.5)] * 3 + [("b1", "test", None)]
    df = spark.createDataFrame(rows, "client_batch string, type string, p double")
    detail = {r["bin"]: r for r in psi.score_psi_detail(df, ["p"], "client_batch", "type").collect()}
    assert len(detail) == 14
    hit = detail["[750, 800)"]
    assert (hit["train_pct"], hit["test_pct"]) == (0.6, 1.0)
    assert hit["train_test_psi"] == pytest.approx(-0.4 * math.log(0.6))
    assert detail["[300, 350)"]["train_test_psi"] is None and detail["[300, 350)"]["train_pct"] == 0
    assert detail["[sum]"]["train_pct"] == pytest.approx(0.6)
    assert psi.score_psi(df, ["p"], "client_batch", "type").first()["train_test_psi"] == pytest.approx(-0.4 * math.log(0.6))
    with pytest.raises(ValueError):
        psi.score_psi(df, ["p"], "client_batch", "type", ("test", "oot"))


# --- profile ----------------------------------------------------------------------------------


def test_profile_against_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"x": rng.normal(1e6, 3, 500).round(2), "c": rng.choice(["u", "v", "w", None], 500, p=[0.5, 0.2, 0.2, 0.1])})
    pdf.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, c string").withColumn("flag", F.col("x") > 1e6)
    got = {r["feature"]: r for r in profile.profile(df, task_rows=50).collect()}
    d = pdf["x"].describe(percentiles=list(profile.PERCENTILES))
    for name, column in zip(profile.NUMERIC_NAMES, profile.DETAIL_NAMES):
        assert float(got["x"][column]) == pytest.approx(d[name], rel=1e-9, abs=2e-6)
    assert got["x"]["unique"] == pdf["x"].nunique() and got["x"]["missing"] == f"{pdf['x'].isna().mean():.2%}"
    counts = pdf["c"].value_counts()
    assert got["c"]["mean_or_top1"] == f"{counts.index[0]}:{counts.iloc[0] / 500:.2%}"
    assert got["c"]["max_or_bottom1"].startswith(counts.index[-1]) or counts.iloc[-1] == counts.iloc[-2]
    assert got["c"]["90%_or_bottom3"] is not None and got["c"]["75%_or_bottom4"] is None and got["c"]["10%_or_top5"] is None
    assert got["c"]["value_max_percent"] == pytest.approx(max(pdf["c"].value_counts(dropna=False)) / 500)
    assert got["flag"]["type"] == "boolean" and got["flag"]["mean_or_top1"].split(":")[0] in ("true", "false")


def test_approximate_describe_is_close(spark):
    df = spark.range(10001).select((F.col("id") / 10).alias("x"))
    row = profile.describe_numbers_approx(df, ["x"]).first()
    assert row["quantiles"][2] == pytest.approx(500, abs=1) and row["unique"] == pytest.approx(10001, rel=0.1)


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, c string")
    got = {r["feature"]: r for r in profile.profile(df).collect()}
    assert got["x"]["missing_q"] == 1 and got["x"]["unique"] == 0 and got["x"]["mean_or_top1"] is None
    assert got["c"]["mean_or_top1"] is None and got["c"]["value_max_percent"] == 1


# --- splits -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sample(spark):
    return spark.range(5000).select(
        F.concat(F.lit("key"), "id").alias("apply_no"), F.lit("2023-03-05").alias("apply_time"), (F.col("id") % 7 == 0).cast("int").alias("target")
    )


def test_split_sizes_are_exact_and_ignore_partitioning(sample):
    one = split.stratified_split(sample, "apply_no", "target", 0.25)
    two = split.stratified_split(sample.repartition(7, "target").orderBy(F.rand(3)), "apply_no", "target", 0.25)
    sizes = {(r["target"], r["type"]): r["count"] for r in one.groupBy("target", "type").count().collect()}
    for cls in (0, 1):
        n = sizes[cls, "train"] + sizes[cls, "test"]
        assert sizes[cls, "test"] == math.ceil(n * 0.25)
    assert one.exceptAll(two).count() == 0


def test_extreme_split_sizes(sample):
    few = sample.limit(10)
    assert split.stratified_split(few, "apply_no", "target", 1.0).where("type = 'train'").count() == 0
    assert split.stratified_split(sample.where("target = 5"), "apply_no", "target", 0.25).count() == 0


def test_folds_are_balanced(sample):
    folds = split.stratified_folds(sample, "apply_no", "target", 10)
    counts = folds.groupBy("target", "fold").count().collect()
    for cls in (0, 1):
        n = [r["count"] for r in counts if r["target"] == cls]
        assert len(n) == 10 and max(n) - min(n) <= 1
    assert "Exchange" not in folds._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ranked,digits", [(10**6, 3), (40, 1), (1, 1), (1, 3), (0, 3)])
def test_cuts_by_radix_search(spark, sample, monkeypatch, ranked, digits):
    """Every level of the search, down to single rows, gives the hashes that sorting the classes gives."""
    df = sample.withColumn("target", F.when(F.col("target") == 1, F.lit(None)).otherwise(F.col("target"))).limit(1500)
    df, _ = materialize(df, "radix")
    hashes = {}
    for r in df.select("target", split.hash_order("apply_no").alias("h")).collect():
        hashes.setdefault(r["target"], []).append(r["h"])
    monkeypatch.setattr(split, "RANKED_ROWS", ranked)
    monkeypatch.setattr(split, "BUCKET_DIGITS", digits)
    got = split.hash_cuts(df, "apply_no", "target", lambda n: [0, 1, n // 3, n // 2, n])
    for cls, own in hashes.items():
        own.sort()
        n = len(own)
        assert got[cls] == [None, own[0], own[n // 3 - 1], own[n // 2 - 1], own[-1]]
    folds = split.stratified_folds(df, "apply_no", "target", 7).groupBy("target", "fold").count().collect()
    assert len(folds) == 14
    for cls in hashes:
        n = [r["count"] for r in folds if r["target"] == cls]
        assert max(n) - min(n) <= 1


def test_folds_of_few_rows_and_many_classes(spark, monkeypatch):
    df = spark.range(8).selectExpr("id", "cast(id % 2 AS int) AS t")
    folds = split.stratified_folds(df, "id", "t", 10).groupBy("t", "fold").count().collect()
    assert len(folds) == 8 and all(r["count"] == 1 and 0 <= r["fold"] < 10 for r in folds)
    monkeypatch.setattr(split, "MAX_CLASSES", 1)
    with pytest.raises(ValueError, match="classes"):
        split.stratified_folds(df, "id", "t", 2)


def test_split_job_cleans_the_sample(spark, sample):
    dirty = sample.unionByName(sample.withColumn("apply_time", F.lit("2024-01-01"))).unionByName(
        spark.createDataFrame([("odd", "2019-01-01", 2), ("gap", "2019-01-01", None)], "apply_no string, apply_time string, target int")
    )
    labelled, reports = split.split_job(dirty, "apply_no", "target", "apply_time", ["apply_time"])
    assert labelled.count() == 5000 and {r["apply_month"] for r in labelled.select("apply_month").distinct().collect()} == {"2023-03"}
    assert {r["target"]: r["n"] for r in reports["classes"].collect()} == {0: 4285, 1: 715, 2: 1, None: 1}
    rates = {r["type"]: r["mean"] for r in reports["by_split"].collect()}
    assert rates["train"] == pytest.approx(rates["test"], abs=1e-3)


def test_views_and_time_split(spark):
    df = spark.createDataFrame([("2019-01-01", 1), ("2019-02-15", 0), ("2019-03-01", 1), (None, 1)], "t string, x int")
    out = split.time_split(df, "t", "2019-02-01", "2019-03-01")
    assert [r["type"] for r in out.collect()] == ["train", "test", "oot", None]
    views = split.split_views(out)
    assert views["oot"].count() == 1 and views["all"].count() == 4
    assert split.split_views(out.where("type <> 'oot'"))["oot"] is None
    with pytest.raises(ValueError):
        split.split_views(out.where("type = 'train'"))


# --- selection --------------------------------------------------------------------------------


def test_column_kinds(spark):
    df = spark.sql("""SELECT 1 AS n, '2024-01-01' AS d, 'abc' AS s, CAST(NULL AS STRING) AS empty, true AS b, timestamp'2024-01-01' AS t
                      UNION ALL SELECT 2, NULL, '2024-01-01', NULL, false, NULL""")
    numeric, text, dates = select.triage(df, df.columns)
    assert (numeric, text, dates) == (["n"], ["s", "b"], ["d", "empty", "t"])


def test_missing_limit_is_strict(spark):
    df = spark.createDataFrame([(1.0, None, float("nan")), (None, None, 2.0)], "a double, b double, c double")
    assert select.dense_columns(df, ["a", "b", "c"], 0.5) == []
    assert select.dense_columns(df, ["a", "b", "c"], 0.51) == ["a", "c"]


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 6))
    pdf = pd.DataFrame(x, columns=list("abcdef"))
    pdf["b"] = pdf["a"] * 0.98 + pdf["b"] * 0.05
    pdf["d"] = pdf["a"]
    pdf["e"] = 5000 + pdf["e"] * 0.01
    pdf.loc[::5, "c"] = np.nan
    pdf.loc[::3, "f"] = np.nan
    return pdf, spark.createDataFrame(pdf).select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in pdf.columns]).repartition(3)


@pytest.mark.parametrize("how", [select.pairwise_corr, select.corr_by_products])
def test_pairwise_correlation(wide, how):
    pdf, df = wide
    want = pdf.corr()
    got = how(df, list("abcdef")).collect()
    assert len(got) == 15
    for r in got:
        assert r["corr"] == pytest.approx(want.loc[r["f1"], r["f2"]], abs=1e-9)


def test_filled_correlation(wide, monkeypatch):
    pdf, df = wide
    want = pdf.fillna(-999).corr().abs()
    for pairs in (select.PAIRS, 3):  # built-in aggregates, tiles
        monkeypatch.setattr(select, "PAIRS", pairs)
        got = select.filled_corr_table(df, list("abcdef")).collect()
        assert len(got) == 15
        for r in got:
            assert r["abs_corr"] == pytest.approx(want.loc[r["f1"], r["f2"]], abs=1e-9)


@pytest.mark.parametrize("how", [select.pairwise_corr, select.corr_by_products])
def test_constant_columns_have_no_correlation(spark, how):
    df = spark.createDataFrame([(float(i), 0.3, None if i else 1.0, float(-i)) for i in range(50)], "a double, b double, c double, d double")
    got = {(r["f1"], r["f2"]): r["corr"] for r in how(df, list("abcd")).collect()}
    assert got.pop(("a", "d")) == pytest.approx(-1.0) and set(got.values()) == {None} and len(got) == 5


@pytest.mark.parametrize("tile,fan", [(128, 16), (2, 2), (4, 3)])
def test_tiles_and_levels_of_the_tree(spark, monkeypatch, tile, fan):
    """Gaps, large means, constants and a column without values, over many parts and in several passes."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((700, 9)) @ rng.standard_normal((9, 9)) + 1e6
    pdf = pd.DataFrame(x, columns=list("abcdefghi"))
    pdf.loc[rng.random(700) < 0.3, "b"] = np.nan
    pdf.loc[rng.random(700) < 0.5, "e"] = np.nan
    pdf.loc[3:, "f"] = np.nan
    pdf["g"] = 0.1
    pdf["h"] = np.nan
    monkeypatch.setattr(moments, "TILE", tile)
    monkeypatch.setattr(moments, "FAN", fan)
    monkeypatch.setattr(moments, "STATE_BYTES", 6 * 8 * tile * tile * 4)
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in pdf.to_numpy()]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns)).repartition(7)
    got = {(r["f1"], r["f2"]): r["corr"] for r in select.corr_by_products(df, list(pdf.columns)).collect()}
    want = pdf.corr()
    assert len(got) == 36
    for (a, b), r in got.items():
        if set("gh") & {a, b}:
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-8)
    empty = select.corr_by_products(df.limit(0), ["a", "b"]).collect()
    assert empty == [] or empty[0]["corr"] is None


def test_a_thousand_columns_are_planned_at_once(spark):
    import time

    df = spark.range(50).select(*[(F.col("id") * (i % 7) + F.rand(i)).alias(f"c{i}") for i in range(1000)])
    stored, _ = materialize(df, "thousand")
    start = time.time()
    out = select.corr_by_products(stored, stored.columns)
    made = time.time() - start
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce " not in text and len(text) < 20_000
    assert out.count() == 1000 * 999 // 2
    assert made < 20  # the pass over the rows included; building the plan alone is below 5 s
    start = time.time()
    select.corr_by_products(stored.limit(0), stored.columns)
    assert time.time() - start < 5


def brute_pruning(corr, importance, threshold):
    order = sorted(importance, key=lambda f: (-importance[f], f))
    dropped = []
    for f in order:
        if f not in dropped:
            dropped += [o for o in order if o != f and o not in dropped and corr.loc[f, o] > threshold and importance[o] <= importance[f]]
    return set(dropped)


def test_pruning(spark, wide):
    _, df = wide
    imp = {"a": 3.0, "b": 2.0, "c": 1.0, "d": 3.0, "e": 0.5}
    kept, dropped = select.drop_correlated(df, imp, 0.9)
    assert set(dropped) == {"b", "d"} and kept.columns == ["a", "c", "e", "f"]  # f has no importance and stays
    assert set(select.drop_correlated(df, imp, 0.9, keep_exact=True)[1]) == {"b"}
    assert select.drop_correlated(df, {"a": 1.0}, 0.9) == (df, [])

    def pruned(corr, importance):
        names = list(corr.columns)
        rows = [(a, b, float(corr.loc[a, b])) for i, a in enumerate(names) for b in names[i + 1 :]]
        return select.prune_correlated(select.close_pairs(spark.createDataFrame(rows, "f1 string, f2 string, abs_corr double"), importance, 0.9), importance)

    corr = pd.DataFrame([[1, 0.95, 0.1], [0.95, 1, 0.95], [0.1, 0.95, 1]], index=list("xyz"), columns=list("xyz"))
    assert pruned(corr, {"x": 3, "y": 2, "z": 1}) == ["y"]  # a dropped feature drops nothing
    assert set(pruned(corr, {"x": 1, "y": 2, "z": 1})) == {"x", "z"}
    rng = np.random.default_rng(7)
    names = [f"f{i}" for i in range(60)]
    half = np.triu(rng.random((60, 60)), 1)
    corr = pd.DataFrame(half + half.T + np.eye(60), index=names, columns=names)
    importance = {f: int(rng.integers(0, 8)) for f in names}
    assert set(pruned(corr, importance)) == brute_pruning(corr, importance, 0.9)


def test_forward_selection_counts_dropped_ones(wide):
    _, df = wide
    kept = [r["feature"] for r in select.forward_kept(df, ["a", "b", "d", "e"]).orderBy("position").collect()]
    assert kept == ["a", "e"]


def test_mean_importance(spark):
    runs = spark.createDataFrame([(i, "f", w) for i, w in enumerate([1, 2, 2, 2, 1, 2, 2])] + [(0, "g", 3)], "run int, feature string, weight int")
    imp = select.mean_importance(runs)
    assert {r["feature"]: r["mean_imp"] for r in imp.collect()} == {"f": 12 / 7, "g": 3.0}
    assert select.top_features(imp, 1) == ["g"]


# --- columns ----------------------------------------------------------------------------------


def test_whole_table_steps(spark):
    df = spark.createDataFrame([("k1", 1.0, None, "u"), ("k2", None, float("nan"), "v")], "k string, a double, b double, c string")
    assert columns.drop_empty_rows(df, ["a", "b"]).count() == 1
    assert [(r["a"], r["b"]) for r in columns.fill_numeric(df).orderBy("k").collect()] == [(1.0, -999999.0), (-999999.0, -999999.0)]
    assert columns.rename_known(df, {"a": "x1"}, ["k"]).columns == ["k", "x1"]
    assert columns.key_last(df, "k").columns == ["a", "b", "c", "k"]
    keys = spark.createDataFrame([("k2",), ("k2",), ("k9",)], "any string")
    assert [r["k"] for r in columns.held_out(df, keys, "k").collect()] == ["k2"]
    labelled = df.withColumn("type", F.lit("cv"))
    assert columns.with_split(labelled, keys, "k").first()["type"] == "cv"


def many_dictionaries(spark, n, hot=False):
    rows = [(i, *[f"{(0 if hot and i % 3 else i) * (j + 3) % 700}" if (i + j) % 11 else None for j in range(5)], i % 2 if i % 7 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"f{j} string" for j in range(5)) + ", f5 int").repartition(4)
    entries = [(f"f{j}", str(k), k / 10 + j) for j in range(5) for k in range(600)] + [("f5", "1", -1.0)]
    entries += [(f"f{j}", UNSEEN, j * 100.0) for j in range(4)] + [("f0", "7", None)][:0]
    return df, spark.createDataFrame(entries, "feature string, key string, woe double"), [f"f{j}" for j in range(6)]


@pytest.mark.parametrize("hot", [False, True])
def test_long_form_lookup_equals_joins(spark, monkeypatch, hot):
    from riskloom.operators import woe

    df, table, names = many_dictionaries(spark, 2000, hot)
    long = encode_with_table(df, table, names).orderBy("id").collect()
    monkeypatch.setattr(woe, "LONG_FROM", 99)
    joined = encode_with_table(df, table, names).orderBy("id").collect()
    assert long == joined and len(long) == 2000
    inline = encode_categories(df, woe_by_category(table)).orderBy("id").collect()
    assert long == inline
    for limit in (0, 650, 10**6):  # all in a table, some, none
        monkeypatch.setattr(woe, "INLINE_ENTRIES", limit)
        for start in (1, 99):
            monkeypatch.setattr(woe, "LONG_FROM", start)
            assert woe.encode_dictionary(df, table, names).orderBy("id").collect() == long


def test_long_form_shuffles_the_wide_rows_once(spark):
    df, table, names = many_dictionaries(spark, 500)
    wide = df.select("*", *[F.lit(i).alias(f"other{i}") for i in range(30)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = encode_with_table(wide, table, names)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("row__" in line and "place" not in line for line in tree) <= 2 and text.count("SortMergeJoin") <= 2


def test_categories_travel_to_their_entries_once(spark, monkeypatch):
    """In long form no block is gathered by a shuffle of its own, and no text goes along with the wide rows."""
    df, table, names = many_dictionaries(spark, 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = encode_with_table(df, table, names)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "collect_list" not in text and text.count("Exchange hashpartitioning(place") == 2  # categories and entries


@pytest.mark.parametrize("room", [0, 650, 10**6])
def test_dictionaries_of_middle_size_are_sent_to_the_rows(spark, monkeypatch, room):
    from riskloom.operators import woe

    df, table, names = many_dictionaries(spark, 800)
    want = encode_categories(df, woe_by_category(table)).orderBy("id").collect()
    monkeypatch.setattr(woe, "INLINE_ENTRIES", 0)
    monkeypatch.setattr(woe, "SENT_ENTRIES", room, raising=False)
    coded = woe.encode_dictionary(df, table, names)
    assert coded.columns == df.columns and coded.orderBy("id").collect() == want
    if room == 10**6:
        assert "Exchange hashpartitioning(row__" not in coded._jdf.queryExecution().executedPlan().toString()


def test_totals_of_categories_take_no_shuffle_of_the_categories(spark):
    from riskloom.operators.hist import text_totals

    df = spark.createDataFrame([("x", None, 1), ("y", 2.0, None), (None, float("nan"), 0), ("x", 2.0, 0)], "a string, b double, t int")
    got = {tuple(r) for r in text_totals(df, ["a", "b"], "t").collect()}
    assert got == {("a", 2, 1), ("b", 1, 0)}
    plan = category_woe_table(df, ["a", "b"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(feature") == 2 and sum("Exchange" in x and "value" in x for x in plan.splitlines()) == 1


def test_null_counts_multiply_no_rows(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "x"), (None, None)], "a double, b string")
    monkeypatch.setattr(select, "CHUNK", 1)
    got = {r["feature"]: r["missing_rate"] for r in select.missing_rates(df, ["a", "b"]).collect()}
    assert got == {"a": pytest.approx(2 / 3), "b": pytest.approx(2 / 3)}
    assert "Expand" not in select.missing_rates(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
