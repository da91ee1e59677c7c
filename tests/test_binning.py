import heapq
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import binning as B
from riskloom.operators.woe import bin_counts, encode_bins

SV = -999999.0


def make(n=2500, seed=5):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = rng.uniform(0, 100)
        a = SV if rng.random() < 0.1 else (50.0 if rng.random() < 0.3 else round(x, 1))
        b = float(rng.randint(0, 12))
        c = None if rng.random() < 0.05 else round(rng.expovariate(0.1), 3)
        bad = int(rng.random() < 0.05 + 0.006 * (a if a > 0 else 20) + 0.01 * b)
        rows.append((a, b, c, bad))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(make(), "a double, b double, c double, target int").cache()


@pytest.fixture(scope="module")
def pdf(frame):
    return frame.toPandas()


def judge(x, y, edges, least):
    """(passes, bins) with the lowest bin left out, straight from the rows."""
    number = np.digitize(x, edges[1:-1])
    use = number > 0
    counts = np.bincount(number[use], minlength=len(edges) - 1)[1:]
    bads = np.bincount(number[use], weights=y[use], minlength=len(edges) - 1)[1:]
    if counts.min() == 0 or counts.min() / counts.sum() <= least:
        return False, len(counts)
    rates = bads / counts
    return bool((np.diff(rates) >= 0).all() or (np.diff(rates) <= 0).all()), len(counts)


def pick(x, y, propose, n_bins=10, least=0.05):
    for n in range(n_bins, 1, -1):
        edges = [-math.inf, SV + 0.001, *propose(n), math.inf]
        ok, m = judge(x, y, edges, least)
        if ok or m <= 2:
            return edges
    return edges


def values(pdf, f):
    part = pdf[[f, "target"]].dropna()
    return part[f].to_numpy(), part["target"].to_numpy()


def brute_tree(x, y, leaves, least):
    """Best-first tree by trying every midpoint of every leaf."""
    need = max(1, math.ceil(least * len(x)))

    def best(xs, ys):
        n, bad = len(xs), ys.sum()
        if n < 2 * need or bad in (0, n):
            return None
        found = None
        points = np.unique(xs)
        for lo, hi in zip(points, points[1:]):
            left = xs <= lo
            nl, nr = left.sum(), n - left.sum()
            if nl < need or nr < need:
                continue
            bl, br = ys[left].sum(), ys[~left].sum()
            score = (bl**2 + (nl - bl) ** 2) / nl + (br**2 + (nr - br) ** 2) / nr
            if found is None or score > found[0]:
                found = (score, (lo + hi) / 2)
        if found is None:
            return None
        return found[0] - (bad**2 + (n - bad) ** 2) / n, found[1]

    heap, tick, cuts = [], 0, []
    start = best(x, y)
    if start:
        heap.append((-start[0], tick, start[1], x, y))
    while heap and len(cuts) < leaves - 1:
        _, _, cut, xs, ys = heapq.heappop(heap)
        cuts.append(cut)
        for side in (xs < cut, xs >= cut):
            b = best(xs[side], ys[side])
            if b:
                tick += 1
                heapq.heappush(heap, (-b[0], tick, b[1], xs[side], ys[side]))
    return sorted(cuts)


@pytest.mark.parametrize("task_rows", [10**6, 60])
def test_decision_tree_against_brute_force(frame, pdf, task_rows):
    made = B.fit_bins(frame, ["a", "b", "c"], "target", "dt", B.BinRules(task_rows=task_rows))
    for f in ("a", "b", "c"):
        x, y = values(pdf, f)
        fit = x != SV
        want = pick(x, y, lambda n: brute_tree(x[fit], y[fit], n, 0.05))
        assert made.edges[f] == pytest.approx(want)


def test_equal_frequency_against_brute_force(frame, pdf):
    made = B.fit_bins(frame, ["a", "b", "c"], "target", "equal_freq", B.BinRules(task_rows=100))
    for f in ("a", "b", "c"):
        x, y = values(pdf, f)
        fit = x[x != SV]
        want = pick(x, y, lambda n: np.unique(np.quantile(fit, [i / n for i in range(n)]))[1:])
        assert made.edges[f] == pytest.approx(want)


def brute_k_means(x, k):
    """Lloyd on the raw rows from the same start."""
    centres = np.unique(np.quantile(x, [(2 * i + 1) / (2 * k) for i in range(k)]))
    while len(centres) > 1:
        owner = np.searchsorted((centres[:-1] + centres[1:]) / 2, x, side="right")
        new = np.array([x[owner == i].mean() if (owner == i).any() else c for i, c in enumerate(centres)])
        moved = ((new - centres) ** 2).sum()
        centres = new
        if moved <= B.KMEANS_TOLERANCE * x.var():
            break
    return np.unique((centres[:-1] + centres[1:]) / 2)


def test_k_means_against_brute_force(frame, pdf):
    made = B.fit_bins(frame, ["a", "b", "c"], "target", "kmeans")
    for f in ("a", "b", "c"):
        x, y = values(pdf, f)
        want = pick(x, y, lambda n: brute_k_means(x[x != SV], n))
        assert made.edges[f] == pytest.approx(want)


def brute_chi(x, y, top, least):
    """Cut lists for every bin number, merging neighbours on plain lists."""
    coarse = len(np.unique(x)) >= 100
    if coarse:
        size = (x.max() - x.min()) / 100
        points = [x.min() + i * size for i in range(1, 101)]
        key = np.array([next((p for p in points if v < p), math.inf) for v in x])
    else:
        key = x
    bins = [[k, (key == k).sum(), y[key == k].sum()] for k in np.unique(key)]

    def chi(p, q):
        n, bad = p[1] + q[1], p[2] + q[2]
        if bad in (0, n):
            return 0.0
        return sum((o - e) ** 2 / e for b in (p, q) for o, e in ((b[2], b[1] * bad / n), (b[1] - b[2], b[1] * (n - bad) / n)))

    out = {}
    for wanted in range(top, 1, -1):
        while len(bins) > 1 and (len(bins) > wanted or min(b[1] for b in bins) / len(x) <= least):
            scores = [chi(p, q) for p, q in zip(bins, bins[1:])]
            i = scores.index(min(scores))
            left, right = bins[i], bins.pop(i + 1)
            bins[i] = [right[0] if coarse else left[0], left[1] + right[1], left[2] + right[2]]
        out[wanted] = [b[0] for b in bins][:-1] if coarse else [b[0] for b in bins][1:]
    return out


def test_chi_merge_against_brute_force(frame, pdf):
    made = B.fit_bins(frame, ["a", "b", "c"], "target", "chi")
    for f in ("a", "b", "c"):
        x, y = values(pdf, f)
        fit = x != SV
        ladder = brute_chi(x[fit], y[fit], 10, 0.05)
        assert made.edges[f] == pytest.approx(pick(x, y, ladder.__getitem__))


def test_chi_merge_with_left_labels(frame, pdf):
    """The compatible variant keeps the left point of a merged pair, as a plain list merge shows."""
    rules = B.BinRules(monotonic=False, n_bins=4, reference_labels=True)
    x, _ = values(pdf, "a")
    x = x[x != SV]
    size = (x.max() - x.min()) / 100
    points = [x.min() + i * size for i in range(1, 101)]
    left = B.fit_bins(frame, ["a"], "target", "chi", rules).edges["a"]
    right = B.fit_bins(frame, ["a"], "target", "chi", B.BinRules(monotonic=False, n_bins=4)).edges["a"]
    assert len(left) == len(right) and left[2] == pytest.approx(points[0]) and left != right


@pytest.mark.parametrize("method", sorted(B.METHODS))
def test_summary_covers_all_rows(frame, method):
    made = B.fit_bins(frame, ["a", "b", "c"], "target", method)
    totals = made.summary.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).collect()
    rows, bad = frame.count(), frame.agg(F.sum("target")).first()[0]
    assert {(r["n"], r["bad"]) for r in totals} == {(rows, bad)}
    counted = {(r["feature"], r["bin_id"]): (r["n"], r["bad"]) for r in bin_counts(frame, made.edges, "target").collect()}
    assert counted == {(r["feature"], r["bin_id"]): (r["n"], r["bad"]) for r in made.summary.collect()}


@pytest.mark.parametrize("method", sorted(B.METHODS))
def test_odd_features(spark, method):
    rows = [(1.0, SV, float(i % 2), i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "single double, special double, two double, target int")
    made = B.fit_bins(df, [], "target", method)
    assert list(made.edges) == ["single", "special", "two"]
    assert made.edges["single"] == [-math.inf, SV + 0.001, math.inf]
    assert made.edges["special"] == [-math.inf, SV + 0.001, math.inf]
    assert len(made.edges["two"]) == 4 and 0 < made.edges["two"][2] <= 1


def test_preconditions(spark, frame):
    with pytest.raises(ValueError, match="unknown binning method"):
        B.fit_bins(frame, ["a"], "target", "magic")
    empty = frame.withColumn("e", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="without any value"):
        B.fit_bins(empty, ["a", "e"], "target", "dt")
    with pytest.raises(ValueError, match="outside 0/1"):
        B.fit_bins(frame.withColumn("target", F.col("target") + 1), ["a"], "target", "dt")
    with pytest.raises(ValueError, match="outside 0/1"):
        B.fit_bins(frame.withColumn("target", F.when(F.col("a") > 99, None).otherwise(F.col("target"))), ["a"], "target", "dt")


def test_without_special_value_and_with_quantile_list(frame, pdf):
    rules = B.BinRules(special=(), monotonic=False, quantile_list=(0, 0.2, 0.5))
    made = B.fit_bins(frame, ["c"], "target", "equal_freq", rules)
    x = pdf["c"].dropna().to_numpy()
    assert made.edges["c"] == pytest.approx([-math.inf, *np.quantile(x, [0.2, 0.5]), math.inf])


def test_quality_rule(spark):
    edges = {"f": [-math.inf, 0, 1, 2, 3, math.inf]}
    rules = B.BinRules(min_share=0.05)

    def check(counts):
        df = spark.createDataFrame([("f", i, n, b) for i, n, b in counts], "feature string, bin_id int, n bigint, bad bigint")
        r = B.quality(spark, df, edges, rules).first()
        return r["ok"], r["n_bins"]

    assert check([(1, 100, 10), (2, 100, 10), (3, 100, 30), (4, 100, 30)]) == (True, 4)  # equal neighbours are fine
    assert check([(0, 3, 3), (1, 100, 10), (2, 100, 10), (3, 100, 30), (4, 100, 30)]) == (True, 4)  # special bin is left out
    assert check([(1, 100, 10), (3, 100, 30), (4, 100, 40)]) == (False, 4)  # an empty bin fails
    assert check([(1, 100, 10), (2, 100, 30), (3, 100, 20), (4, 100, 40)]) == (False, 4)
    assert check([(1, 5, 0), (2, 35, 10), (3, 30, 12), (4, 30, 20)]) == (False, 4)  # exactly the limit is too small


def test_manual_bins_and_encoding(spark):
    df = spark.createDataFrame([(1.0, 0, "k"), (1.5, 1, "l"), (2.0, 1, "m"), (2.0, 0, "n"), (None, 1, "o")], "f double, target int, id string")
    made = B.manual_bins(df, {"f": [-math.inf, 1.2, 2.0, math.inf]}, "target")
    woe = made.woe()["f"]
    assert woe[0] == 0 and woe[None] is None and woe[1] is None and woe[2] == pytest.approx(math.log((1 / 2) / (1 / 3)))
    coded = encode_bins(df, made.edges, made.woe())
    assert coded.columns == ["f", "target", "id"]
    assert [r["f"] for r in coded.orderBy("id").collect()] == [0.0, None, woe[2], woe[2], None]
    wider = B.update_bins(made, B.manual_bins(df.withColumn("g", F.col("f")), {"g": [0, 5]}, "target"))
    assert set(wider.edges) == {"f", "g"} and wider.summary.where("feature = 'f'").count() == 4


@pytest.mark.parametrize("method", sorted(B.METHODS))
def test_infinite_values_have_no_say_in_the_edges(spark, method):
    rows = [(x, y) for x, _, _, y in make(600)]
    plain = spark.createDataFrame(rows, "a double, target int")
    odd = spark.createDataFrame([*rows, (math.inf, 1), (math.inf, 0), (-math.inf, 1), (float("nan"), 1)], "a double, target int")
    rules = B.BinRules(monotonic=False, n_bins=4)
    one, two = (B.fit_bins(df, ["a"], "target", method, rules) for df in (plain, odd))
    assert two.edges == one.edges and len(two.edges["a"]) > 4
    last = len(two.edges["a"]) - 2
    count = {r["bin_id"]: r["n"] for r in one.summary.collect()}
    more = {r["bin_id"]: r["n"] - count.get(r["bin_id"], 0) for r in two.summary.collect()}
    assert {i: n for i, n in more.items() if n} == {0: 1, last: 2, None: 1}
    # The row-wise cut puts them into the same bins.
    again = {r["bin_id"]: r["n"] for r in bin_counts(odd, two.edges, "target").collect()}
    assert again == {r["bin_id"]: r["n"] for r in two.summary.collect()}


def test_k_means_reads_do_not_grow_with_its_rounds(spark, monkeypatch):
    """Hundreds of rounds, a handful of reads; the same bins whether pages are held by the driver or asked for."""
    from riskloom.operators import prefix

    rng = random.Random(2)
    rows = [(round(rng.lognormvariate(0, 2), 4), int(rng.random() < 0.3)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, target int").cache()
    made, counted = [], []

    class Counted(prefix.PrefixPages):
        rounds = 0

        def __init__(self, *args):
            super().__init__(*args)
            counted.append(self)

        def below(self, points):
            self.rounds += 1
            return super().below(points)

    monkeypatch.setattr(B, "PrefixPages", Counted)
    monkeypatch.setattr(B, "KMEANS_TOLERANCE", 1e-12)
    for page, cached in ((16_384, 10**6), (256, 10**6), (256, 0), (256, 1000)):
        monkeypatch.setattr(prefix, "PAGE_ROWS", page)
        monkeypatch.setattr(prefix, "CACHED_ROWS", cached)
        rules = B.BinRules(monotonic=False, n_bins=6, task_rows=300 if cached else 10**6)
        if cached == 0:
            rules = B.BinRules(monotonic=False, n_bins=2)
        made.append(B.fit_bins(df, ["a"], "target", "kmeans", rules).edges["a"])
        if cached == 10**6:
            pages = counted[-1]
            assert pages.rounds > 15 and pages.reads <= len(pages.begins["a"])
            assert page == 256 or pages.reads == 1
    assert made[1] == pytest.approx(made[0]) and made[3] == pytest.approx(made[0])
    x = np.array([r[0] for r in rows])
    assert made[0][2:-1] == pytest.approx(brute_k_means(x, 6)) and made[2][2:-1] == pytest.approx(brute_k_means(x, 2))


def test_lookups_of_running_sums(spark, monkeypatch):
    from riskloom.operators import prefix
    from riskloom.operators.hist import numeric_histogram

    rows = [(float(i % 37), float(-(i % 11)), i % 2) for i in range(500)]
    hist = numeric_histogram(spark.createDataFrame(rows, "a double, b double, target int"), ["a", "b"], "target")
    points = {"a": np.array([-1.0, 0.0, 0.5, 17.0, 36.0, 99.0]), "b": np.array([-20.0, -10.0, -3.5, 0.0, 0.1])}
    for page, cached in ((4, 1000), (4, 0), (4, 9), (1000, 1000)):
        monkeypatch.setattr(prefix, "PAGE_ROWS", page)
        monkeypatch.setattr(prefix, "CACHED_ROWS", cached)
        pages = prefix.PrefixPages(hist)
        for _ in range(2):
            got = pages.below(points)
            for i, f in enumerate("ab"):
                x = np.array([r[i] for r in rows])
                assert got[f][0].tolist() == [(x < p).sum() for p in points[f]]
                assert got[f][1].tolist() == [x[x < p].sum() for p in points[f]]


def test_best_cuts_are_hashed_not_sorted(spark, frame):
    from riskloom.operators.prefix import rank_histogram
    from riskloom.operators.hist import numeric_histogram

    ranked = rank_histogram(numeric_histogram(frame, ["a", "b"], "target"), ["feature"]).rows
    nodes = [(f, 1, 0, 0, 2000, 600, 10) for f in "ab"]
    found = B._best_cuts(spark, ranked, nodes)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text.split("Exchange hashpartitioning(node_feature")[0]
    found.collect()
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_tree_opens_only_nodes_that_can_be_next(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(x := rng.random(), int(rng.random() < (0.1 + 0.8 * (int(x * 16) % 2)))) for _ in range(4000)]
    opened, ask = [], B._best_cuts
    monkeypatch.setattr(B, "_best_cuts", lambda spark, runs, nodes: opened.append([n[:2] for n in nodes]) or ask(spark, runs, nodes))
    rules = B.BinRules(n_bins=6, min_share=0.001, monotonic=False)
    made = B.fit_bins(spark.createDataFrame(rows, "a double, target int"), ["a"], "target", "dt", rules)
    assert len(made.edges["a"]) == 8
    every = [n for step in opened for n in step]
    assert len(every) == len(set(every)) and all(len(step) <= 2 * 5 for step in opened) and len(opened) <= 6
