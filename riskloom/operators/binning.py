"""Automatic and manual binning of numeric features, all features together.

Every method works on one stored histogram (feature, value, n, bad) and proposes
edges for each bin number from the wanted one down to two. All proposals are then
judged in a single pass: the histogram is cut once at the union of a feature's
proposed edges, and the few resulting cells are regrouped per proposal. The largest
bin number that passes is kept.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.scoring import chi_square
from riskloom.operators.cut import cut_columns
from riskloom.operators.hist import numeric_histogram
from riskloom.operators.prefix import TASK_ROWS, PrefixPages, locate, quantiles, rank_histogram
from riskloom.operators.woe import _quality, bin_counts, bin_quality, describe_bins, woe_by_bin, woe_table
from riskloom.roles import FILL_VALUE, numeric_columns
from riskloom.session import materialize

SPECIAL_WIDTH = 0.001
CHI_POINTS = 100
CANDIDATE_SCHEMA = "feature string, n_bins int, splits array<double>"


@dataclass(frozen=True)
class BinRules:
    n_bins: int = 10
    min_share: float | None = 0.05
    special: tuple[float, ...] = (FILL_VALUE,)
    monotonic: bool = True
    quantile_list: tuple[float, ...] | None = None
    reference_labels: bool = False
    task_rows: int = TASK_ROWS

    @property
    def floor(self) -> list[float]:
        """Upper edge of the special bin; only the first special value gets one."""
        return [self.special[0] + SPECIAL_WIDTH] if self.special else []


@dataclass(frozen=True)
class Binning:
    """Fitted edges per feature and the evidence table of the fit."""

    edges: dict[str, list[float]]
    summary: DataFrame

    def transform(self, df: DataFrame, labels: bool = False) -> DataFrame:
        return cut_columns(df, self.edges, labels)

    def woe(self) -> dict[str, dict[int | None, float | None]]:
        return woe_by_bin(self.summary)


def fit_bins(
    df: DataFrame, features: Sequence[str] | None, target: str, method: str = "dt", rules: BinRules | None = None
) -> Binning:
    """Fit edges by 'equal_freq', 'dt', 'kmeans' or 'chi'; without a list, of all numeric columns but the target.

    Missing, special and infinite values have no say in the edges. Special ones fall into the lowest bin, infinite ones into the outer
    bins, missing ones into a bin of their own.
    """
    features = list(features or [c for c in numeric_columns(df) if c != target])
    if method not in METHODS:
        raise ValueError(f"unknown binning method {method!r}, use one of {sorted(METHODS)}")
    rules = rules or BinRules()
    seen = Observation()  # the target check rides on the histogram pass
    t = F.col(target)
    checked = df.select(*features, target).observe(seen, F.count_if(t.isNull() | ~t.isin(0, 1)).alias("wrong"))
    hist, rows = materialize(numeric_histogram(checked, features, target), "bin-histogram")
    if seen.get["wrong"]:
        raise ValueError(f"{seen.get['wrong']} rows have a {target} outside 0/1")
    present = hist.groupBy("feature").agg(F.count("value").alias("values")).collect()  # one per feature
    empty = sorted(set(features) - {r["feature"] for r in present if r["values"]})
    if empty:
        raise ValueError(f"features without any value: {empty}")
    usable = hist.where(F.abs("value") < math.inf)
    if rules.special:
        usable = usable.where(~F.col("value").isin(*rules.special))
    candidates = METHODS[method](usable, rules, rows)
    edges = choose_edges(hist, candidates, features, rules)
    return Binning(edges, woe_table(histogram_bins(hist, edges)))


def manual_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], target: str) -> Binning:
    """Given edges, with the evidence table recomputed."""
    fixed = {f: [float(x) for x in e] for f, e in edges.items()}
    return Binning(fixed, woe_table(bin_counts(df, fixed, target)))


def update_bins(base: Binning, manual: Binning) -> Binning:
    """Manual bins replace the automatic ones of the same features."""
    kept = base.summary.where(~F.col("feature").isin(*manual.edges)) if manual.edges else base.summary
    return Binning({**base.edges, **manual.edges}, kept.unionByName(manual.summary))


def edge_table(spark: SparkSession, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    return spark.createDataFrame([(f, [float(x) for x in e]) for f, e in edges.items()], "feature string, edges array<double>")


def bin_list(spark: SparkSession, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Every (feature, bin_id) of the edges, empty bins included."""
    return spark.createDataFrame(
        [(f, i) for f, e in edges.items() for i in range(len(e) - 1)], "feature string, bin_id int"
    )


def quality(spark: SparkSession, counts: DataFrame, edges: Mapping[str, Sequence[float]], rules: BinRules) -> DataFrame:
    return bin_quality(counts, bin_list(spark, edges), rules.min_share, bool(rules.special))


def histogram_bins(hist: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Bin counts from a histogram by a search in each feature's edges."""
    table = edge_table(hist.sparkSession, edges)
    width = max(len(e) for e in edges.values())
    cells = locate(hist.join(F.broadcast(table), "feature"), "edges", "value", "spot", width)
    # Infinity lies in the last bin if that is open.
    last = F.size("edges") - F.when(F.element_at("edges", -1) == math.inf, 1).otherwise(0)
    spot = F.least(F.col("spot"), last)
    number = F.when(F.col("value").isNotNull() & (spot > 0) & (spot < F.size("edges")), spot - 1)
    counts = cells.groupBy("feature", number.alias("bin_id")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    return describe_bins(counts, edges)


def choose_edges(
    hist: DataFrame, candidates: DataFrame, features: Sequence[str], rules: BinRules
) -> dict[str, list[float]]:
    """The largest bin number per feature whose bins pass (or that has at most two).

    The proposals are parameters (features x bin numbers, ten cuts each), so they pass
    through the driver; the counts behind every judgement come from one pass over the histogram.
    """
    plans = {
        (r["feature"], r["n_bins"]): [*rules.floor, *(s for s in r["splits"] if not rules.floor or s > rules.floor[0])]
        for r in candidates.collect()
    }
    if rules.monotonic and plans:
        passing = _passing(hist, plans, rules)
    else:
        passing = {f: max(n for g, n in plans if g == f) for f in {f for f, _ in plans}}
    bare = list(rules.floor)  # only special values present
    return {f: [-math.inf, *(plans[f, passing[f]] if f in passing else bare), math.inf] for f in features}


def _passing(hist: DataFrame, plans: dict[tuple[str, int], list[float]], rules: BinRules) -> dict[str, int]:
    spark = hist.sparkSession
    # Cells: the histogram cut at the union of all proposed edges, under 60 per feature.
    union: dict[str, set[float]] = {}
    for (feature, _), cuts in plans.items():
        union.setdefault(feature, set()).update(cuts)
    atoms = spark.createDataFrame([(f, sorted(u)) for f, u in union.items()], "feature string, atoms array<double>")
    known = hist.where(F.col("value").isNotNull()).join(F.broadcast(atoms), "feature")
    cells = (
        locate(known, "atoms", "value", "atom", max(len(u) for u in union.values()))
        .groupBy("feature", "atom")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )
    # Where each proposed bin takes its cells: a cell belongs to the bin its lower edge falls in.
    slots = []
    for (feature, wanted), cuts in plans.items():
        starts = [-math.inf, *sorted(union[feature])]
        owner = np.searchsorted(cuts, starts, side="right")
        slots += [(feature, wanted, int(b), i) for i, b in enumerate(owner)]
    table = spark.createDataFrame(slots, "feature string, wanted int, bin_id int, atom int")
    full = (
        table.join(cells, ["feature", "atom"], "left")
        .groupBy("feature", "wanted", "bin_id")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )
    if rules.special:
        full = full.where(F.col("bin_id") > 0)
    judged = _quality(full, ["feature", "wanted"], rules.min_share)
    best = F.expr("coalesce(max(IF(ok OR n_bins <= 2, wanted, NULL)), min(wanted))").alias("wanted")
    return {r["feature"]: r["wanted"] for r in judged.groupBy("feature").agg(best).collect()}  # one per feature


# --- equal frequency --------------------------------------------------------------------------


def equal_frequency(usable: DataFrame, rules: BinRules, rows: int) -> DataFrame:
    """Exact quantiles for every bin number at once; ties collapse, the minimum is dropped."""
    ladder = {n: [i / n for i in range(n)] for n in range(2, rules.n_bins + 1)}
    if rules.quantile_list:
        ladder = {n: p for n, p in ladder.items() if n < len(rules.quantile_list)}
        ladder[len(rules.quantile_list)] = sorted(rules.quantile_list)
    if not ladder:
        ladder = {1: [0.0]}
    wanted = sorted({p for probs in ladder.values() for p in probs})
    found = quantiles(rank_histogram(usable, ["feature"], task_rows=rules.task_rows, stored_rows=rows), wanted)
    steps = F.explode(
        F.array(*[F.struct(F.lit(n).alias("n_bins"), F.lit(p).alias("prob")) for n, ps in ladder.items() for p in ps])
    )
    spec = usable.sparkSession.range(1).select(steps.alias("s")).select("s.n_bins", "s.prob")
    return (
        found.join(F.broadcast(spec), "prob")
        .groupBy("feature", "n_bins")
        .agg(F.array_sort(F.collect_set("quantile")).alias("q"))
        .select("feature", "n_bins", F.slice("q", F.lit(2), F.greatest(F.size("q"), F.lit(1))).alias("splits"))
    )


# --- decision tree ----------------------------------------------------------------------------


def decision_tree(usable: DataFrame, rules: BinRules, rows: int) -> DataFrame:
    """Best-first Gini tree with at most n leaves, exact over all distinct values.

    Running counts make the two sides of any cut a subtraction, so one round of all
    trees is two scans with a hashed map-side maximum per node. A round opens only nodes that
    can be next, at most two for each cut taken. The driver keeps only the
    chosen cuts. Fewer leaves are a prefix of the best-first order, so the tree is
    grown once for all bin numbers.
    """
    spark = usable.sparkSession
    ranked = rank_histogram(usable, ["feature"], task_rows=rules.task_rows, stored_rows=rows)
    runs, _ = materialize(ranked.rows.select("feature", "value", "n", "bad", "n_before", "bad_before", "next_value"), "ranked")
    totals = ranked.totals().collect()  # one per feature
    leaf = {r["feature"]: max(1, math.ceil((rules.min_share or 0) * r["n_total"])) for r in totals}
    nodes = {(r["feature"], 1): (0, 0, r["n_total"], r["bad_total"]) for r in totals}
    cuts: dict[tuple[str, int], tuple[float, float]] = {}
    looked_at: set[tuple[str, int]] = set()
    splits = max(rules.n_bins, 2) - 1
    orders: dict[str, list[float]] = {}
    frontier = list(nodes)
    while frontier:
        open_nodes = []
        for key in frontier:
            looked_at.add(key)
            n0, bad0, n1, bad1 = nodes[key]
            n, bad = n1 - n0, bad1 - bad0
            if n >= 2 * leaf[key[0]] and 0 < bad < n:
                open_nodes.append((key[0], key[1], n0, bad0, n1, bad1, leaf[key[0]]))
        for r in _best_cuts(spark, runs, open_nodes).collect() if open_nodes else []:  # one per open node
            key = (r["node_feature"], r["node"])
            n0, bad0, n1, bad1 = nodes[key]
            n, bad = n1 - n0, bad1 - bad0
            gain = r["score"] - (bad * bad + (n - bad) * (n - bad)) / n
            cuts[key] = (gain, r["cut"])
            middle_n, middle_bad = r["n_left"] + n0, r["bad_left"] + bad0
            nodes[key[0], 2 * key[1]] = (n0, bad0, middle_n, middle_bad)
            nodes[key[0], 2 * key[1] + 1] = (middle_n, middle_bad, n1, bad1)
        frontier = []
        for feature in leaf.keys() - orders.keys():
            order, unseen = _best_first(cuts, looked_at, feature, splits)
            if unseen:
                frontier += [(feature, node) for node in unseen]
            else:
                orders[feature] = order
    proposals = []
    for feature, order in orders.items():
        proposals += [(feature, n, sorted(order[: n - 1])) for n in range(splits + 1, 1, -1)]
    return spark.createDataFrame(proposals, CANDIDATE_SCHEMA)


def _best_cuts(spark: SparkSession, rows: DataFrame, open_nodes: list[tuple]) -> DataFrame:
    """Per open node its best score and the lowest cut that reaches it.

    Two hashed steps, the highest score and then the least of the cuts that have it, so nothing is sorted. Counts to
    the left rise with the cut, so the least ones belong to the lowest cut.
    """
    nodes = spark.createDataFrame(
        open_nodes, "node_feature string, node bigint, n0 bigint, bad0 bigint, n1 bigint, bad1 bigint, leaf bigint"
    )
    sides = (
        rows.join(F.broadcast(nodes), F.expr("feature = node_feature AND n_before >= n0 AND n_before + n < n1"))
        .selectExpr(
            "node_feature",
            "node",
            "leaf",
            "IF((value + next_value) / 2 > value, (value + next_value) / 2, next_value) AS cut",
            "n_before + n - n0 AS n_left",
            "bad_before + bad - bad0 AS bad_left",
            "n1 - n_before - n AS n_right",
            "bad1 - bad_before - bad AS bad_right",
        )
        .where("n_left >= leaf AND n_right >= leaf")
    )

    def purity(n: str, bad: str) -> str:
        # The optimizer may score rows before it drops those without a side.
        return f"try_divide(CAST({bad} AS DOUBLE) * {bad} + CAST({n} - {bad} AS DOUBLE) * ({n} - {bad}), {n})"

    scored = sides.withColumn("score", F.expr(f"{purity('n_left', 'bad_left')} + {purity('n_right', 'bad_right')}"))
    best = scored.groupBy("node_feature", "node").agg(F.max("score").alias("top"))
    best = best.select(F.col("node_feature").alias("f"), F.col("node").alias("m"), "top")  # one row per open node
    reached = scored.join(F.broadcast(best), F.expr("node_feature = f AND node = m AND score = top"))
    return reached.groupBy("node_feature", "node").agg(
        F.max("score").alias("score"), *[F.min(c).alias(c) for c in ("cut", "n_left", "bad_left")]
    )


def _best_first(
    cuts: dict[tuple[str, int], tuple[float, float]], looked_at: set[tuple[str, int]], feature: str, splits: int
) -> tuple[list[float], list[int]]:
    """Cut points in the order a best-first tree takes them, and the nodes to look at before that order is settled.

    Those are the unseen children of the cuts taken so far, the last one's left out: they alone could be next, at most two per cut.
    """
    order: list[float] = []
    heap: list[tuple[float, int]] = []
    unseen: list[int] = []
    fresh = [1]
    while True:
        unseen += [node for node in fresh if (feature, node) not in looked_at]
        for node in fresh:
            if (feature, node) in cuts:
                heapq.heappush(heap, (-cuts[feature, node][0], node))
        if not heap:
            return order, unseen
        _, node = heapq.heappop(heap)
        order.append(cuts[feature, node][1])
        if len(order) == splits:
            return order, unseen
        fresh = [2 * node, 2 * node + 1]


# --- k-means ----------------------------------------------------------------------------------

KMEANS_TOLERANCE = 1e-4


def k_means(usable: DataFrame, rules: BinRules, rows: int) -> DataFrame:
    """One-dimensional k-means for every feature and cluster number together.

    Start: equal-frequency centres, so the result does not depend on partitioning.
    A cluster is a stretch between two midpoints, so its weight and sum are differences of running sums, which are
    stored once (:class:`PrefixPages`). A round looks up the midpoints of all open problems; it scans no values. Rounds
    go on until the centres move no more than the tolerance: each lowers the spread inside the clusters, so they end.
    """
    spark = usable.sparkSession
    spread = {
        r["feature"]: r["spread"]
        for r in _moments(usable).collect()  # one per feature
    }
    top = max(rules.n_bins, 2)
    starts = {n: [(2 * i + 1) / (2 * n) for i in range(n)] for n in range(2, top + 1)}
    at: dict[tuple[str, float], float] = {}
    ranked = rank_histogram(usable, ["feature"], task_rows=rules.task_rows, stored_rows=rows)
    for r in quantiles(ranked, sorted({p for ps in starts.values() for p in ps})).collect():
        at[r["feature"], r["prob"]] = r["quantile"]
    centres = {
        (f, n): np.unique([at[f, p] for p in probs]) for f in spread for n, probs in starts.items()
    }
    open_problems = {key for key, c in centres.items() if len(c) > 1}
    pages = PrefixPages(usable, rules.task_rows, rows) if open_problems else None
    while open_problems:
        middles = {key: (centres[key][:-1] + centres[key][1:]) / 2 for key in open_problems}
        points = {
            f: np.unique(np.concatenate([m for key, m in middles.items() if key[0] == f])) for f in {key[0] for key in open_problems}
        }
        below = pages.below(points)
        for key in list(open_problems):
            old = centres[key]
            rows_at = np.searchsorted(points[key[0]], middles[key])
            weight, mass = (
                np.diff(np.concatenate([[0.0], sums[rows_at], [total]])) for sums, total in zip(below[key[0]], pages.totals[key[0]])
            )
            centres[key] = np.sort(np.where(weight > 0, mass / np.maximum(weight, 1), old))
            if np.sum((centres[key] - old) ** 2) <= KMEANS_TOLERANCE * spread[key[0]]:
                open_problems.discard(key)
    proposals = []
    for (feature, n), c in centres.items():
        splits = np.unique((c[:-1] + c[1:]) / 2)
        proposals.append((feature, n, [float(x) for x in splits]))
    return spark.createDataFrame(proposals, CANDIDATE_SCHEMA)


def _moments(usable: DataFrame) -> DataFrame:
    weight, x = F.col("n").cast("double"), F.col("value")
    mean = usable.groupBy("feature").agg((F.sum(weight * x) / F.sum(weight)).alias("mean"))
    return (
        usable.join(F.broadcast(mean), "feature")
        .groupBy("feature")
        .agg((F.sum(weight * (x - F.col("mean")) * (x - F.col("mean"))) / F.sum(weight)).alias("spread"))
    )


# --- chi-merge --------------------------------------------------------------------------------


def chi_points(usable: DataFrame) -> DataFrame:
    """(feature, key, n, bad, coarse): features with 100 or more distinct values are first
    grouped at equal-width points, each under the point on its right."""
    x, low, size = F.col("value"), F.col("low"), F.col("size")
    stats = usable.groupBy("feature").agg(
        F.min("value").alias("low"),
        ((F.max("value") - F.min("value")) / CHI_POINTS).alias("size"),
        F.count(F.lit(1)).alias("n_values"),
    )
    guess = F.floor(F.try_divide(x - low, size)).cast("int")
    # The quotient can be off by one at a point; comparing with the points themselves settles it.
    passed = F.when(x >= low + (guess + 1) * size, guess + 1).when(x < low + guess * size, guess - 1).otherwise(guess)
    spot = F.least(passed, F.lit(CHI_POINTS))
    point = F.when(spot >= CHI_POINTS, F.lit(math.inf)).otherwise(low + (spot + 1) * size)
    coarse = F.col("n_values") >= CHI_POINTS
    return (
        usable.join(F.broadcast(stats), "feature")  # one row per feature
        .groupBy("feature", F.when(coarse, point).otherwise(x).alias("key"))
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.first(coarse).alias("coarse"))
    )


def adjacent_chi(points: DataFrame) -> DataFrame:
    """Chi-square of each point with its right neighbour, before any merge."""
    along = Window.partitionBy("feature").orderBy("key")
    nxt = {c: F.lead(c).over(along) for c in ("key", "n", "bad")}
    return (
        points.select("feature", "key", "n", "bad", *[v.alias(f"next_{c}") for c, v in nxt.items()])
        .where(F.col("next_key").isNotNull())
        .withColumn("chi", chi_square(F.col("n"), F.col("bad"), F.col("next_n"), F.col("next_bad")))
    )


def _pair_chi(n: np.ndarray, bad: np.ndarray) -> np.ndarray:
    n, bad = n.astype(float), bad.astype(float)
    both = n[:-1] + n[1:]
    rate = (bad[:-1] + bad[1:]) / both
    spread = (bad[:-1] - n[:-1] * rate) ** 2 / n[:-1] + (bad[1:] - n[1:] * rate) ** 2 / n[1:]
    flat = (rate == 0) | (rate == 1)
    safe = np.where(flat, 0.5, rate)
    return np.where(flat, 0.0, spread / safe + spread / (1 - safe))


def chi_merge(usable: DataFrame, rules: BinRules, rows: int) -> DataFrame:
    """Merge the least different neighbours; one group holds at most 101 points."""
    least = rules.min_share or 0.0
    top = max(rules.n_bins, 2)
    reference_labels = rules.reference_labels

    def merge(points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("key")
        feature, coarse = points["feature"].iloc[0], bool(points["coarse"].iloc[0])
        key, n, bad = (points[c].to_numpy().copy() for c in ("key", "n", "bad"))
        total, rows = n.sum(), []
        keep_left = reference_labels or not coarse
        for wanted in range(top, 1, -1):
            while len(n) > 1 and (len(n) > wanted or n.min() / total <= least):
                i = int(np.argmin(_pair_chi(n, bad)))
                n[i] += n[i + 1]
                bad[i] += bad[i + 1]
                if not keep_left:
                    key[i] = key[i + 1]
                n, bad = np.delete(n, i + 1), np.delete(bad, i + 1)
                key = np.delete(key, i + 1)
            splits = key[:-1] if coarse else key[1:]
            rows.append((feature, wanted, [float(s) for s in np.unique(splits)]))
        return pd.DataFrame(rows, columns=["feature", "n_bins", "splits"])

    return chi_points(usable).groupBy("feature").applyInPandas(merge, CANDIDATE_SCHEMA)


METHODS = {"equal_freq": equal_frequency, "dt": decision_tree, "kmeans": k_means, "chi": chi_merge}
