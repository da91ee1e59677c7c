"""Exact ranks over sorted values without a one-task window.

A running count over a continuous feature would pull every distinct value of
that feature into one window partition. Here the sorted axis of each group is cut
into buckets at quantile splitters first; running counts are taken inside
(group, bucket) and shifted by the bucket's offset. The bucket is a pure function
of the value, so a recomputed task gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import materialize, scratch_path

# Largest number of distinct values of one group left to a single window task.
TASK_ROWS = 1_000_000
# Most buckets per group; with the accuracy below the splitter sketch stays a few hundred kB per group.
MAX_BUCKETS = 4096
# Bound on splitters sent to every task (8 bytes each).
MAX_SPLITTERS = 4_000_000


@dataclass(frozen=True)
class Ranked:
    """rows: (by..., value, n, bad, n_before, bad_before, next_value, n_total, bad_total); other summed columns alike."""

    rows: DataFrame
    by: tuple[str, ...]
    hist: DataFrame

    def totals(self) -> DataFrame:
        return self.hist.groupBy(*self.by).agg(
            F.sum("n").alias("n_total"),
            F.sum("bad").alias("bad_total"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.count(F.lit(1)).alias("n_values"),
        )


def locate(df: DataFrame, edges: str, value: str, out: str, size: int) -> DataFrame:
    """``out`` = number of entries of the sorted array ``edges`` that are <= ``value``.

    A binary search unrolled into about log2(size) projections, all inside code
    generation; ``size`` is an upper bound of the array length.
    """
    df = df.withColumn(out, F.lit(0))
    step = 1 << max(size, 1).bit_length() - 1
    while step:
        found = f"CASE WHEN get({edges}, {out} + {step - 1}) <= {value} THEN {out} + {step} ELSE {out} END"
        df = df.withColumn(out, F.expr(found))
        step >>= 1
    return df


def _splitters(hist: DataFrame, by: Sequence[str], task_rows: int) -> tuple[DataFrame | None, int]:
    sizes = hist.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    top = sizes.agg(F.max("rows").alias("top"), F.count(F.lit(1)).alias("groups")).first()
    if not top["groups"] or top["top"] <= task_rows:
        return None, 1
    buckets = min(-(-top["top"] // task_rows), MAX_BUCKETS, max(2, MAX_SPLITTERS // top["groups"]))
    if isinstance(hist.schema["value"].dataType, T.StringType):
        edges = _text_splitters(hist, by, buckets, top["top"])
    else:
        edges = _number_splitters(hist, by, buckets)
    # Stored: they are approximate, and all that reads them must see the same ones.
    edges, _ = materialize(edges, "splitters")
    # Few groups: send the splitters to every task. Very many: let Spark choose the join by size.
    return (F.broadcast(edges) if top["groups"] * buckets <= MAX_SPLITTERS else edges), buckets


def _number_splitters(hist: DataFrame, by: Sequence[str], buckets: int) -> DataFrame:
    probs = [i / buckets for i in range(1, buckets)]
    return hist.groupBy(*by).agg(
        F.array_sort(
            F.array_distinct(
                F.percentile_approx("value", F.array(*map(F.lit, probs)), F.lit(max(10000, 4 * buckets)))
            )
        ).alias("edges")
    )


def _text_splitters(hist: DataFrame, by: Sequence[str], buckets: int, top: int) -> DataFrame:
    """Splitters from a hash sample of the distinct texts. They only steer balance: the
    ranks are exact for any splitters."""
    wanted = 32 * buckets
    every = max(1, top // wanted)
    sample = hist.where(F.pmod(F.xxhash64("value"), F.lit(every)) == 0)
    listed = sample.groupBy(*by).agg(F.array_sort(F.collect_list("value")).alias("s"))
    at = [F.floor(F.size("s") * F.lit(i / buckets)).cast("int") for i in range(1, buckets)]
    return listed.select(*by, F.array_distinct(F.filter(F.array(*[F.get("s", a) for a in at]), lambda e: e.isNotNull())).alias("edges"))


def rank_histogram(
    hist: DataFrame,
    by: Sequence[str],
    bounded: bool = False,
    task_rows: int = TASK_ROWS,
    stored_rows: int | None = None,
    more: Sequence[str] = (),
) -> Ranked:
    """Running counts over ``value`` within ``by`` for a histogram (by..., value, n, bad).

    ``bounded`` states that the value domain itself is small (integer scores, bin
    numbers); otherwise the histogram is stored once, counted, and bucketed if any
    group is larger than one task should hold. ``stored_rows`` says that it is stored
    already, with an upper bound of its rows. ``more`` names further columns to sum.
    """
    by = list(by)
    sums = ["n", "bad", *more]
    hist = hist.where(F.col("value").isNotNull() & (F.col("n") > 0))
    edges = None
    if not bounded:
        rows = stored_rows
        if rows is None:
            hist, rows = materialize(hist, "histogram")
        if rows > task_rows:
            edges, buckets = _splitters(hist, by, task_rows)
    whole = Window.partitionBy(*by)

    def running(window, suffix: str):
        return [F.coalesce(F.sum(c).over(window), F.lit(0)).alias(f"{c}_{suffix}") for c in sums]

    if edges is None:
        order = whole.orderBy("value")
        rows_df = hist.select(
            "*",
            *running(order.rowsBetween(Window.unboundedPreceding, -1), "before"),
            F.lead("value").over(order).alias("next_value"),
            *[F.sum(c).over(whole).alias(f"{c}_total") for c in sums],
        )
        return Ranked(rows_df, tuple(by), hist)

    stored = hist
    # A group without splitters (too small to be sampled) stays in one bucket.
    hist = locate(hist.join(edges, by, "left"), "edges", "value", "bucket", buckets).drop("edges")
    # Per (group, bucket): at most groups x buckets rows, so these windows stay small.
    along = whole.orderBy("bucket")
    shift = (
        hist.groupBy(*by, "bucket")
        .agg(*[F.sum(c).alias(c) for c in sums], F.min("value").alias("first_value"))
        .select(
            *by,
            "bucket",
            *running(along.rowsBetween(Window.unboundedPreceding, -1), "shift"),
            F.lead("first_value").over(along).alias("next_first"),
            *[F.sum(c).over(whole).alias(f"{c}_total") for c in sums],
        )
    )
    inside = Window.partitionBy(*by, "bucket").orderBy("value")
    rows_df = (
        hist.select(
            *by,
            "bucket",
            "value",
            *sums,
            *running(inside.rowsBetween(Window.unboundedPreceding, -1), "in"),
            F.lead("value").over(inside).alias("next_in"),
        )
        .join(shift, [*by, "bucket"])
        .select(
            *by,
            "value",
            *sums,
            *[(F.col(f"{c}_in") + F.col(f"{c}_shift")).alias(f"{c}_before") for c in sums],
            F.coalesce("next_in", "next_first").alias("next_value"),
            *[f"{c}_total" for c in sums],
        )
    )
    return Ranked(rows_df, tuple(by), stored)


# Rows of a page of stored running sums, most pages of all features, and rows of pages held by the driver.
PAGE_ROWS = 16_384
MAX_PAGES = 16_384
CACHED_ROWS = 2_000_000


class PrefixPages:
    """Running sums of n and n * value over the sorted values of each feature, stored in pages for lookups of single points.

    Every page is a folder of its own, so a lookup reads the pages that hold its points and no others. The driver knows
    where each page begins (at most MAX_PAGES and one per feature) and keeps the last pages read, up to CACHED_ROWS rows; points in
    pages that do not fit are answered by a join that sends back one row for each point.
    """

    def __init__(self, hist: DataFrame, task_rows: int = TASK_ROWS, stored_rows: int | None = None):
        self.spark = hist.sparkSession
        summed = hist.withColumns({"mass": F.col("n") * F.col("value"), "one": F.lit(1).cast("bigint")})
        ranked = rank_histogram(summed, ["feature"], task_rows=task_rows, stored_rows=stored_rows, more=("mass", "one"))
        totals = ranked.hist.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"), F.count(F.lit(1)).alias("values"))
        rows = totals.collect()  # one per feature
        self.totals = {r["feature"]: (r["n"], r["mass"]) for r in rows}
        self.page_rows = max(PAGE_ROWS, -(-sum(r["values"] for r in rows) // MAX_PAGES))
        base, table = 0, []
        for r in sorted(rows, key=lambda r: r["feature"]):
            table.append((r["feature"], base))
            base += -(-r["values"] // self.page_rows)
        bases = self.spark.createDataFrame(table, "feature string, base bigint")
        page = (F.col("base") + F.floor(F.col("one_before") / self.page_rows)).cast("int").alias("page")
        rows = ranked.rows.join(F.broadcast(bases), "feature").select("feature", "value", "n", "mass", "n_before", "mass_before", page)
        self.path = scratch_path(self.spark, "prefix-pages")
        rows.repartition("page").write.partitionBy("page").parquet(self.path)
        self.schema = "feature string, value double, n bigint, mass double, n_before bigint, mass_before double, page int"
        begins = self._read().groupBy("feature", "page").agg(
            F.min("value").alias("first"), F.min("n_before").alias("n"), F.min_by("mass_before", "value").alias("mass"), F.count(F.lit(1)).alias("rows")
        )
        self.begins = {f: part.sort_values("page") for f, part in begins.toPandas().groupby("feature")}
        self.held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.reads = 0  # jobs that read pages

    def _read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def below(self, points: Mapping[str, np.ndarray]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Per feature (n, n * value) summed over the values smaller than each point."""
        spots = {}
        for feature, x in points.items():
            begins = self.begins[feature]
            spots[feature] = np.searchsorted(begins["first"].to_numpy(), x, side="left") - 1
        needed = {
            int(self.begins[f]["page"].iloc[k]): int(self.begins[f]["rows"].iloc[k]) for f, spot in spots.items() for k in np.unique(spot[spot >= 0])
        }
        self._hold(needed)
        far = [
            (f, int(self.begins[f]["page"].iloc[k]), float(x)) for f, spot in spots.items() for k, x in zip(spot, points[f])
            if k >= 0 and int(self.begins[f]["page"].iloc[k]) not in self.held
        ]
        answers = self._ask(far) if far else {}
        out = {}
        for feature, x in points.items():
            begins, n, mass = self.begins[feature], np.zeros(len(x)), np.zeros(len(x))
            for i, (k, p) in enumerate(zip(spots[feature], x)):
                if k < 0:
                    continue
                page = int(begins["page"].iloc[k])
                if page in self.held:
                    values, counts, masses = self.held[page]
                    at = np.searchsorted(values, p, side="left")
                    inside = counts[at], masses[at]
                else:
                    inside = answers[feature, page, float(p)]
                n[i], mass[i] = begins["n"].iloc[k] + inside[0], begins["mass"].iloc[k] + inside[1]
            out[feature] = n, mass
        return out

    def _hold(self, needed: Mapping[int, int]) -> None:
        """Read the pages that are not held, as far as they fit; others make room if all needed ones then fit."""
        new = [p for p in needed if p not in self.held]
        if not new:
            return
        if sum(len(v[0]) for v in self.held.values()) + sum(needed[p] for p in new) > CACHED_ROWS:
            self.held = {p: v for p, v in self.held.items() if p in needed}
        room, take = CACHED_ROWS - sum(len(v[0]) for v in self.held.values()), []
        for p in sorted(new):
            if needed[p] <= room:
                take.append(p)
                room -= needed[p]
        if take:
            self.reads += 1
            rows = self._read().where(F.col("page").isin(take)).select("page", "value", "n", "mass").toPandas()
            for p, part in rows.groupby("page"):
                part = part.sort_values("value")
                sums = [np.concatenate([[0], np.cumsum(part[c].to_numpy())]) for c in ("n", "mass")]
                self.held[int(p)] = part["value"].to_numpy(), *sums

    def _ask(self, far: list[tuple[str, int, float]]) -> dict[tuple[str, int, float], tuple[float, float]]:
        self.reads += 1
        asked = self.spark.createDataFrame(sorted(set(far)), "feature string, in_page int, point double")
        pages = sorted({p for _, p, _ in far})
        rows = self._read().where(F.col("page").isin(pages)).drop("feature")
        met = rows.join(F.broadcast(asked), (F.col("page") == F.col("in_page")) & (F.col("value") < F.col("point")))
        sums = met.groupBy("feature", "in_page", "point").agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"))
        return {(r["feature"], r["in_page"], r["point"]): (r["n"], r["mass"]) for r in sums.collect()}  # one per point


def quantiles(ranked: Ranked, probs: Sequence[float]) -> DataFrame:
    """(by..., prob, quantile): exact, linearly interpolated, for every group in one pass.

    Each row of the histogram covers a run of ranks; the wanted ranks (two per
    probability and group) are broadcast and matched to the run that holds them.
    """
    by = list(ranked.by)
    position = F.col("prob") * (F.col("n_total") - 1)
    wanted = (
        ranked.totals()
        .select(*by, "n_total", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
        .select(*by, "prob", F.floor(position).alias("low"), (position - F.floor(position)).alias("part"))
        .select(
            *by,
            "prob",
            "part",
            "low",
            F.explode(
                F.when(F.col("part") > 0, F.array(F.col("low"), F.col("low") + 1)).otherwise(F.array("low"))
            ).alias("rank"),
        )
    )
    runs = ranked.rows.select(*by, "value", "n_before", (F.col("n_before") + F.col("n")).alias("n_after"))
    w = wanted.select(*[F.col(k).alias(f"w_{k}") for k in by], "prob", "part", "low", "rank")
    same = [F.col(k) == F.col(f"w_{k}") for k in by]
    inside = (F.col("n_before") <= F.col("rank")) & (F.col("rank") < F.col("n_after"))
    cond = inside
    for part in same:
        cond = part & cond
    low = F.max(F.when(F.col("rank") == F.col("low"), F.col("value")))
    high = F.max(F.when(F.col("rank") > F.col("low"), F.col("value")))
    return (
        runs.join(F.broadcast(w), cond)
        .groupBy(*by, "prob")
        .agg(low.alias("a"), high.alias("b"), F.max("part").alias("part"))
        .select(*by, "prob", (F.col("a") + F.coalesce((F.col("b") - F.col("a")) * F.col("part"), F.lit(0.0))).alias("quantile"))
    )
