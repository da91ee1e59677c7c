"""Hard negatives against brute force in whole numbers, and bounds that never rule out what they must not."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from riskloom.llm import segment_filter
from riskloom.llm.queries import HARD_NEGATIVES_SQL, QUERIES

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
KIND = "vec_id long, embedding array<double>, label int, dim int, nth int, scores int"


def brute(rows, is_anchor, k=5, percent=80, scale=256):
    """Rows (id, vector, label), anchors by condition; scores in Python's whole numbers."""
    whole = {}
    for i, v, label in rows:
        if i is None or not v or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = tuple(math.floor(scale * x) for x in v)
        if sum(x * x for x in ints) < 2**62:
            whole[i, str(label), ints] = True
    whole = list(whole)
    out = []
    for a in sorted({i for i, _, _ in whole if is_anchor(i)}):
        _, label, own = min(x for x in whole if x[0] == a)
        scored = [(-sum(x * y for x, y in zip(own, v)), i, other) for i, other, v in whole if i != a and len(v) == len(own)]
        positives = sorted((s, i) for s, i, other in scored if other == label)[:k]
        for s, p in positives:
            found = sorted((t, i) for t, i, other in scored if other != label and percent * s >= 100 * t >= 100 * s)[:k]
            out += [(a, p, r + 1, i, -s, -t) for r, (t, i) in enumerate(found)]
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_whole_table(spark, sf):
    table = pq.read_table(f"{sf}/embeddings.parquet").to_pylist()
    moved = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["label"] is not None and r["vec_id"] % 7 == 0 else r["label"]) for r in table]
    got = QUERIES["op12_hard_negatives"](spark, sf)
    assert dict(got.dtypes)["rank"] == "int"
    assert result(got) == brute(moved, lambda i: i % 100 == 0)


def test_sql_agrees(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    res = con.execute(HARD_NEGATIVES_SQL)
    names = [d[0] for d in res.description]
    rows = [dict(zip(names, r)) for r in res.fetchall()]
    assert sorted(tuple(r[c] for c in COLUMNS) for r in rows) == result(QUERIES["op12_hard_negatives"](spark, sf))


def odd_rows():
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, 0.5, 1.0, 2.0]) for _ in range(7)], rng.randrange(3)) for i in range(160)]  # many ties
    rows += [(200 + i, [1.0, 2.0, 0.5, 0.5, 1.0, 2.0, -1.0], 1) for i in range(40)]  # copies of one vector
    rows += [(300 + i, [rng.gauss(0, 1) for _ in range(3)], i % 2) for i in range(30)]  # another length
    rows += [(400, None, 1), (401, [], 1), (402, [1.0, None], 1), (403, [math.nan] * 7, 1), (404, [math.inf] * 7, 1), (405, [1.0] * 7, None), (None, [1.0] * 7, 1)]
    rows += [(406, [0.0] * 7, 1), (407, [1e300] * 7, 1), (408, [1e18] * 7, 1), (500, [-1.0] * 7, 1)]
    rows += rows[:20] + [(10, [2.0] * 7, 2), (10, [2.0] * 7, 0), (20, [2.0] * 7, 2)]  # repeated rows and repeated ids
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows(spark, monkeypatch, small):
    if small:
        for name, value in (("ANCHORS", 4), ("ROWS", 16), ("STRIDE", 5)):
            monkeypatch.setattr(segment_filter, name, value)
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], KIND)
    assert result(segment_filter.hard_negatives(df, "vec_id % 10 = 0")) == brute(rows, lambda i: i % 10 == 0)


def test_large_numbers(spark):
    """Scores beyond what a double holds without rounding."""
    rng = random.Random(7)
    rows = [(i, [float(rng.randrange(2**28)) for _ in range(6)], i % 2) for i in range(40)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], KIND)
    assert result(segment_filter.hard_negatives(df, "vec_id % 5 = 0", scale=2)) == brute(rows, lambda i: i % 5 == 0, scale=2)


def test_empty_table(spark):
    assert segment_filter.hard_negatives(spark.createDataFrame([], KIND), "vec_id % 10 = 0").collect() == []


@pytest.mark.parametrize("dim", [1, 2, 3, 5, 64, 100])
def test_bounds_hold_and_get_tighter(dim):
    rng = np.random.default_rng(dim)
    v = np.floor(rng.standard_normal((60, dim)) * rng.choice([1, 50], dim) * 20)
    means, rests = segment_filter.summaries(v)
    exact, at, last = v @ v.T, 0, np.inf
    for starts in segment_filter.levels(dim):
        own = slice(at, at + len(starts))
        at += len(starts)
        middle, rest = means[:, own] @ means[:, own].T, rests[:, own] @ rests[:, own].T
        assert (np.abs(exact - middle) <= rest + 1e-6 * np.abs(exact).max()).all()
        assert (middle + rest).sum() <= last + 1e-6
        last = (middle + rest).sum()


def test_vectors_of_unlike_segments_are_ruled_out():
    """Where segments differ in size, few pairs reach the exact step."""
    rng = np.random.default_rng(1)
    v = np.floor(rng.standard_normal((400, 64)) * 10 + np.repeat(rng.standard_normal((400, 8)) * 100, 8, axis=1))
    import pyarrow as pa

    means, rests = segment_filter.summaries(v)
    rows = pa.table({"vec_id": np.arange(400), "label": ["a"] * 400, "vec": v.tolist(), "means": means.tolist(), "rests": rests.tolist()})
    block = segment_filter.Block(rows, "vec_id")
    low = np.sort(v @ v.T, axis=1)[:, -6].astype(float)
    left = segment_filter.survivors(block, block, np.ones((400, 400), bool), low, np.full(400, np.inf))
    assert left[(v @ v.T) >= low[:, None]].all() and left.mean() < 0.05
