import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import scoring, seal
from riskloom.operators.cut import bin_label, bin_number, check_edges, cut_columns, interval_label


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("double").alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("p, score", [(0.0, 297), (0.001, 297), (0.1, 637), (0.5, 795), (0.9, 954), (0.999, 1200), (1.0, 1200), (None, None)])
def test_score_scale(spark, p, score):
    assert one(spark, scoring.to_score("p"), p=p) == score


def test_psi_term(spark):
    assert one(spark, scoring.psi_term(F.col("x"), F.col("y")), x=0.4, y=0.2) == pytest.approx(0.2 * math.log(2))
    assert one(spark, scoring.psi_term(F.col("x"), F.col("y")), x=0.0, y=0.2) is None
    assert one(spark, scoring.psi_term(F.col("x"), F.col("y")), x=None, y=0.2) is None


def test_evidence_guards(spark):
    good, bad = F.col("g"), F.col("b")
    assert one(spark, scoring.bin_woe(good, bad), g=0.5, b=0.0) == 0
    assert one(spark, scoring.bin_woe(good, bad), g=0.0, b=0.5) is None
    assert one(spark, scoring.category_woe(good, bad), g=0.0, b=0.5) == pytest.approx(math.log(1e-10 / 0.5))


def test_objective():
    assert scoring.tuning_objective(0.8, 0.8) == pytest.approx(79)
    assert scoring.tuning_objective(0.83, 0.8) == pytest.approx(80 - 8)


def test_text_pieces(spark):
    df = spark.sql("SELECT 'k' AS a, date'2023-03-05' AS d, 1 AS t, CAST(NULL AS STRING) AS n")
    row = df.select(scoring.joined_text("a", "d", "t").alias("x"), scoring.joined_text("a", "n").alias("y"), scoring.percent_text(F.lit(0.12345)).alias("z")).first()
    assert (row["x"], row["y"], row["z"]) == ("k,2023-03-05,1", None, "12.35%")


def test_cbc_round_trips(spark):
    texts = ["0", "", "1234567890123456", "id-7,2024-01-31,0", "名,é,1", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.withColumn("e", seal.seal_cbc(F.col("t"), "sixteen byte key")).withColumn("d", seal.unseal_cbc(F.col("e"), "sixteen byte key")).collect()
    assert [r["d"] for r in out] == texts
    assert [len(r["e"]) for r in out if r["e"] is not None] == [32, 0, 32, 64, 32]


# Computed with the openssl command line: aes-cbc, zero-padded key and text, the first key block as IV, no padding block.
SEALED = [
    ('0', 'sixteen byte key', "d681274f749ad2aea6541ede3dccf5f2"),
    ('id-7,2024-01-31,0', 'sixteen byte key', "58be92c3f4d54c61629c8f000ddaeef6171c98e7746a80fd346ec38f9fbe23b6"),
    ('1234567890123456', 'short', "51c76190b711bc995eb14cc673c636b5"),
    ('é,中,1', 'a key of twenty bytes', "6d0f5526c423bc5a7aa9927a65b0c2fa"),
]


@pytest.mark.parametrize("text,key,sealed", SEALED)
def test_cbc_agrees_with_another_library(spark, text, key, sealed):
    df = spark.createDataFrame([(text, sealed)], "t string, s string")
    row = df.select(seal.seal_cbc(F.col("t"), key).alias("e"), seal.unseal_cbc(F.col("s"), key).alias("d")).first()
    assert (row["e"], row["d"]) == (sealed, text)


def test_default_seal_is_random_and_round_trips(spark):
    df = spark.createDataFrame([("a,b,1",), ("a,b,1",)], "t string").withColumn("e", seal.seal(F.col("t"), "k" * 16))
    rows = df.withColumn("d", seal.unseal(F.col("e"), "k" * 16)).collect()
    assert {r["d"] for r in rows} == {"a,b,1"}
    assert len({r["e"] for r in df.collect()}) == 2
    with pytest.raises(ValueError):
        seal.seal(F.col("t"), "x" * 40)


def test_intervals_are_closed_on_the_left(spark):
    edges = [0.0, 1.0, 2.5, 10.0]
    df = spark.createDataFrame([(x,) for x in (-0.1, 0.0, 0.999, 1.0, 2.5, 9.9, 10.0, None, float("nan"))], "x double")
    rows = df.select(bin_number(F.col("x"), edges).alias("b"), bin_label(F.col("x"), edges).alias("l")).collect()
    assert [r["b"] for r in rows] == [None, 0, 0, 1, 2, 2, None, None, None]
    assert [r["l"] for r in rows] == ["nan", "[0, 1)", "[0, 1)", "[1, 2.5)", "[2.5, 10)", "[2.5, 10)", "nan", "nan", "nan"]
    assert interval_label(-math.inf, 0.123456) == "[-inf, 0.123)"
    with pytest.raises(ValueError):
        check_edges([1, 1])


def test_cut_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, 5, "a")], "k int, x int, c string")
    assert cut_columns(df, {"x": [0, 5, 9]}).columns == ["k", "x", "c"]
    assert cut_columns(df, {"x": [0, 5, 9]}).first()["x"] == 1
