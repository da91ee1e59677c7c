import json
import math

import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.functions.scoring import to_score
from riskloom.operators import binning as B
from riskloom.operators.woe import UNSEEN, category_woe_table, encode_bins, woe_by_category
from riskloom.sources import params, tables, treedump


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def test_workspace_comes_from_the_session(spark):
    assert session.workspace(spark) == session.workspace(spark)
    df, rows = session.materialize(spark.range(10), "test")
    assert rows == 10 and df.count() == 10
    assert session.workspace(spark).removeprefix("file:") in df.inputFiles()[0]
    folder = session.scratch_path(spark, "drop-me")
    df.write.parquet(folder)
    assert session.clear_scratch(spark, folder) and not session.clear_scratch(spark, folder)
    with pytest.raises(ValueError):
        session.clear_scratch(spark, session.workspace(spark))


def test_csv_round_trip_with_schema(spark, folder):
    df = spark.createDataFrame([("key1", 17.0, "2023-03-05"), ("key2", None, "2023-03-06")], "apply_no string, x double, t string")
    tables.write_report(df, f"{folder}/wide", "csv")
    back = tables.read_table(spark, f"{folder}/wide", df.schema, "csv")
    assert back.orderBy("apply_no").collect() == df.collect()
    guessed = tables.read_table(spark, f"{folder}/wide", form="csv")
    assert dict(guessed.dtypes)["x"] == "double"


def test_keys_scores_and_samples(spark, folder):
    df = spark.createDataFrame([(f"key{i}", "test" if i % 3 == 0 else "train", i / 10, "b1" if i < 5 else "b2") for i in range(9)], "apply_no string, type string, p double, batch string")
    tables.write_keys(df, "apply_no", f"{folder}/keys")
    keys = tables.read_keys(spark, f"{folder}/keys")
    assert sorted(r["key"] for r in keys.collect()) == ["key0", "key3", "key6"]
    tables.write_scores(df, "apply_no", "p", "batch", f"{folder}/scores")
    tables.write_scores(df.where("batch = 'b2'").withColumn("p", F.lit(0.5)), "apply_no", "p", "batch", f"{folder}/scores")
    back = spark.read.parquet(f"{folder}/scores")
    assert back.count() == 9 and back.where("batch = 'b1'").agg(F.max("p")).first()[0] == 0.4
    sample = tables.sample_rows(df, ["p"], "apply_no", 4)
    assert sample.columns == ["p", "apply_no"] and [r["apply_no"] for r in sample.collect()] == ["key0", "key1", "key2", "key3"]


def test_scores_of_repeated_keys_and_null_batches(spark, folder):
    """A run replaces the batches it holds, the one without a name among them; repeated keys stay as often as they come."""
    rows = [("k1", 0.1, "b1"), ("k1", 0.1, "b1"), ("k2", 0.2, None), (None, 0.3, "b2")]
    tables.write_scores(spark.createDataFrame(rows, "k string, p double, batch string"), "k", "p", "batch", folder)
    again = [("k3", 0.4, None), ("k4", 0.5, "b2")]
    tables.write_scores(spark.createDataFrame(again, "k string, p double, batch string"), "k", "p", "batch", folder)
    got = sorted(tuple(r) for r in spark.read.parquet(folder).select("k", "p", "batch").collect() if r["batch"] is not None)
    assert got == [("k1", 0.1, "b1"), ("k1", 0.1, "b1"), ("k4", 0.5, "b2")]
    assert [tuple(r) for r in spark.read.parquet(folder).where("batch IS NULL").select("k", "p").collect()] == [("k3", 0.4)]


def test_a_dump_is_replaced_as_a_whole(spark, folder):
    for n in (5, 2):
        lines = spark.createDataFrame([(f"booster[{t}]:", t, 0) for t in range(n)] + [(f"0:leaf={t}", t, 1) for t in range(n)], "line string, t int, i int")
        treedump.write_dump(spark, [r["line"] for r in lines.orderBy("t", "i").collect()], f"{folder}/trees.txt")
    trees = treedump.read_dump(spark, f"{folder}/trees.txt")
    out = treedump.score_dump(spark.range(1), trees, "p").first()["p"]
    assert out == pytest.approx(1 / (1 + math.exp(-1)))


def test_category_json(spark, folder):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), ("b", 1), ("b", 0), ("other", 0)], "c string, target int")
    table = category_woe_table(df, ["c"], "target")
    params.categories_to_json(table, folder)
    text = params.read_json(spark, f"{folder}/{params.CATEGORY_FILE}")
    woe = woe_by_category(table)["c"]
    assert text == {"c": {"a": woe["a"], "b": woe["b"], "other": 0.0}}  # the file has one entry of that name
    back = woe_by_category(params.categories_from_json(spark, folder))["c"]
    assert back == {"a": woe["a"], "b": woe["b"], UNSEEN: 0.0}


def test_category_json_as_a_plain_file(spark, tmp_path):
    (tmp_path / params.CATEGORY_FILE).write_text(json.dumps({"c": {"x": 0.5, "other": 0}, "d": {"y": -1.0, "other": 0}}))
    got = woe_by_category(params.categories_from_json(spark, str(tmp_path)))
    assert got == {"c": {"x": 0.5, UNSEEN: 0.0}, "d": {"y": -1.0, UNSEEN: 0.0}}


def test_bin_parameters_as_json_and_parquet(spark, folder):
    df = spark.createDataFrame([(float(i % 10) if i % 11 else None, int(i % 10 > 6 or i % 17 == 0)) for i in range(300)], "f double, target int")
    made = B.fit_bins(df, ["f"], "target", "dt")
    params.bins_to_json(spark, made, folder)
    edges, woe = params.bins_from_json(spark, folder)
    assert edges == made.edges and woe == made.woe()
    params.write_bins(spark, made, f"{folder}/tables")
    stored = params.read_bins(spark, f"{folder}/tables")
    assert stored.edges == made.edges and stored.woe() == made.woe()
    assert encode_bins(df, edges, woe).exceptAll(encode_bins(df, stored.edges, stored.woe())).count() == 0
    assert params.finite(made.edges)["f"] == made.edges["f"][1:-1]


NARROW = [-math.inf, 10.0001, 10.0002, 10.0003, math.inf]


def narrow(spark):
    rows = [(x, int(i % k == 0)) for k, x in enumerate((9.0, 10.00015, 10.00025, 11.0), 2) for i in range(20)] + [(None, 1), (None, 0)]
    return spark.createDataFrame(rows, "f double, target int")


def test_narrow_bins_keep_their_evidence(spark, folder):
    made = B.manual_bins(narrow(spark), {"f": NARROW}, "target")
    assert len(set(made.woe()["f"].values())) == 5
    params.bins_to_json(spark, made, folder)
    assert params.bins_from_json(spark, folder) == (made.edges, made.woe())
    params.write_bins(spark, made, f"{folder}/tables")
    stored = params.read_bins(spark, f"{folder}/tables")
    assert stored.edges == made.edges and stored.woe() == made.woe()
    assert {r["label"] for r in stored.summary.collect()} == {"[-inf, 10.0001)", "[10.0001, 10.0002)", "[10.0002, 10.0003)", "[10.0003, inf)", "nan"}
    labels = {r["f"] for r in made.transform(narrow(spark), labels=True).collect()}
    assert len(labels) == 5


def test_edges_that_differ_in_the_last_bit(spark, folder):
    edges = [-math.inf, 0.1 + 0.2, 0.3, math.inf]
    edges = [-math.inf, *sorted(edges[1:3]), math.inf]
    df = spark.createDataFrame([(0.1, 1), (0.3, 0), (0.3, 1), (0.1 + 0.2, 0), (0.1 + 0.2, 0), (0.1 + 0.2, 1), (0.1, 0)], "f double, target int")
    made = B.manual_bins(df, {"f": edges}, "target")
    params.bins_to_json(spark, made, folder)
    params.write_bins(spark, made, f"{folder}/tables")
    assert params.bins_from_json(spark, folder) == (made.edges, made.woe())
    assert params.read_bins(spark, f"{folder}/tables").woe() == made.woe() and len(made.woe()["f"]) == 3


def test_colliding_or_strange_labels_of_a_foreign_file(spark, tmp_path):
    def write(edges, labels):
        for name, value in ((params.BIN_EDGE_FILE, {"f": edges}), (params.BIN_WOE_FILE, {"f": labels})):
            (tmp_path / name).write_text(json.dumps(value))
        return params.bins_from_json(spark, str(tmp_path))

    with pytest.raises(ValueError, match="do not tell"):
        write(NARROW, {"[-inf, 10)": 0.1, "[10, 10)": 0.2, "[10, inf)": 0.3})
    with pytest.raises(ValueError, match="no bins named"):
        write([-math.inf, 1.0, math.inf], {"[-inf, 1)": 0.1, "[1, 2)": 0.2})
    assert write([-math.inf, 1.0, math.inf], {"[-inf, 1)": 0.1, "nan": 0.3})[1] == {"f": {0: 0.1, None: 0.3}}


def test_bin_tables_that_do_not_belong_together(spark, folder):
    one = B.manual_bins(narrow(spark), {"f": NARROW}, "target")
    two = B.manual_bins(narrow(spark), {"f": [-math.inf, 10.0, math.inf]}, "target")
    params.write_bins(spark, one, f"{folder}/one")
    params.write_bins(spark, two, f"{folder}/two")
    mixed = f"{folder}/mixed"
    spark.read.parquet(f"{folder}/one/edges").write.parquet(f"{mixed}/edges")
    spark.read.parquet(f"{folder}/two/evidence").write.parquet(f"{mixed}/evidence")
    with pytest.raises(ValueError, match="other edges"):
        params.read_bins(spark, mixed)
    later = f"{folder}/later"
    spark.read.parquet(f"{folder}/one/edges").withColumn("format", F.lit(99)).write.parquet(f"{later}/edges")
    spark.read.parquet(f"{folder}/one/evidence").write.parquet(f"{later}/evidence")
    with pytest.raises(ValueError, match="layout"):
        params.read_bins(spark, later)


@pytest.mark.parametrize("files", [1, 4])
def test_large_dictionaries_as_json(spark, folder, monkeypatch, files):
    """One document whatever its size, also in several files, and nothing left of an earlier run."""
    params.write_categories(spark.sql("SELECT 'old' AS feature, 'x' AS key, 1.0D AS woe"), folder)
    monkeypatch.setattr(params, "FILE_ENTRIES", 1200 if files > 1 else 10**6)
    odd = ['say "hi"', "back\\slash", "line\nbreak", "é中", "", "other", "a,b", "{}", " "]
    rows = [("c", f"k{i}", i / 7) for i in range(3000)] + [("d", k, -1.5) for k in odd] + [("d", UNSEEN, 0.25), ("e", UNSEEN, 0.0), ("e", "z", None), ('q"', "w", 1e-12)]
    table = spark.createDataFrame(rows, "feature string, key string, woe double").repartition(5)
    params.write_categories(table, folder)
    parts = sorted((__import__("pathlib").Path(folder) / params.CATEGORY_FILE).glob("part-*"))
    parts = [p for p in parts if p.stat().st_size]
    assert (len(parts) > 1) == (files > 1)
    text = json.loads("".join(p.read_text() for p in parts))
    want = {}
    for f, k, w in sorted(rows, key=lambda r: r[1] == UNSEEN):
        want.setdefault(f, {})["other" if k == UNSEEN else k] = w
    assert text == want
    back = {(r["feature"], r["key"]): r["woe"] for r in params.categories_from_json(spark, folder).collect()}
    assert back == {(f, UNSEEN if k == "other" else k): w for f, e in want.items() for k, w in e.items()}
    params.write_categories(table.limit(0), folder)
    assert params.categories_from_json(spark, folder).collect() == []


# Two splits on one feature at 2.5, missing to the right; the constant stands for all leaf-only trees.
LEFT, RIGHT = (-0.0889847577, -0.072098203), (-0.110835426, -0.0977204815)
CONSTANT = math.log(0.1126526 / (1 - 0.1126526)) - sum(LEFT)
DUMP = f"""booster[0]:
0:leaf={CONSTANT!r}
booster[1]:
0:[xy<2.5] yes=1,no=2,missing=2
\t1:leaf={LEFT[0]}
\t2:leaf={RIGHT[0]}
booster[2]:
0:[xy<2.5] yes=1,no=2,missing=2
\t1:leaf={LEFT[1]}
\t2:leaf={RIGHT[1]}
"""


def test_tree_dump_scores(spark, tmp_path):
    (tmp_path / "dump.txt").write_text(DUMP)
    trees = treedump.read_dump(spark, str(tmp_path / "dump.txt"))
    df = spark.createDataFrame([(2.0,)] * 51 + [(2.5,)] * 20 + [(17.0,)] * 8 + [(None,)] * 21, "xy double")
    out = treedump.score_dump(df, trees).withColumn("score", to_score("p"))
    got = {r["score"]: (r["n"], r["p"]) for r in out.groupBy("score").agg(F.count("*").alias("n"), F.max("p").alias("p")).collect()}
    assert set(got) == {646, 643}
    assert got[646] == (51, pytest.approx(0.1126526, abs=1e-7)) and got[643] == (49, pytest.approx(0.1079937, abs=1e-7))
    with pytest.raises(ValueError):
        treedump.parse_dump(["booster[0]:", "what is this"])


def test_large_ensembles_are_walked_with_the_same_result(spark, monkeypatch):
    text = []
    for t in range(30):
        text += [f"booster[{t}]:", f"0:[a<{t}] yes=1,no=2,missing=1", f"1:[b<{t / 2}] yes=3,no=4,missing=4", f"2:leaf={t / 100}", f"3:leaf={-t / 50}", "4:leaf=0.01"]
    trees = treedump.parse_dump(text)
    df = spark.createDataFrame([(float(i % 31) if i % 5 else None, float(i % 17) if i % 7 else None) for i in range(500)], "a double, b double")
    compiled = treedump.score_dump(df, trees, "p")
    monkeypatch.setattr(treedump, "COMPILED_SPLITS", 10)
    both = treedump.score_dump(compiled, trees, "walked")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("walked")))).first()[0] < 1e-12


def test_delivery(spark):
    df = spark.createDataFrame([("d1", "2019-11-15", 1, 0.5), ("d2", "2019-11-16", 0, 0.7)], "device_id string, apply_time string, target int, x double")
    sent = tables.delivery_sample(df, "device_id", "apply_time", "target", "secret", legacy=True)
    assert sent.columns == ["device_id", "apply_time", "merge"] and {len(r["merge"]) for r in sent.collect()} == {32}
    features = tables.delivery_features(df, "target", "apply_time", "2023-03-05")
    assert features.columns == ["device_id", "apply_time", "x"] and features.select("apply_time").distinct().count() == 1
