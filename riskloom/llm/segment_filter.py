"""Hard negatives by exact inner products behind a filter of segment summaries.

Vectors become whole numbers, floor(scale * x), and scores are their inner products. Every vector is cut into 1, 2, 4, ... segments,
and for each segment its mean and its deviation (the length of what is left without the mean) are stored. Over a segment of w
components the inner product of two vectors is w * mean * mean plus the product of what is left, which lies between minus and
plus the product of the deviations; summed over segments this bounds the score from both sides. Pairs are looked at with one segment
first and with twice as many at each step, and only those that a bound cannot rule out go on. What is left after the finest step is scored exactly.

Anchors are cut into blocks of ANCHORS, rows into blocks of ROWS (fewer if vectors are long), and each pair of blocks is a task group of its
own, whatever ids, labels or vectors repeat. Positives come first: inside a block rows are taken STRIDE at a time, and a pair is ruled out once
its upper bound is below the k-th best score that the anchor has there. Their scores then bound the negatives from both sides. Best rows of all blocks meet in
a ranked group limit that Spark applies before the shuffle.

How much the bounds rule out depends on the vectors: much where segments differ in mean or size, little for directions spread
evenly, where nearly all pairs are scored. The result is exact either way, and work grows with anchors times rows.

Rows with a null id, a null label, a null or empty vector, or a null or non-finite component take no part, nor do vectors whose whole numbers have a
squared length of 2^62 or more (scores must fit a long). Scores compare vectors of one length. Rows that repeat id, label and numbers are one row; a row never
finds rows of its own id; if an anchor's id has several rows, the least (label, numbers) asks. Ties go to the smaller id. An empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import flat_lists
from riskloom.session import materialize

ANCHORS = 512
ROWS = 4096
STRIDE = 1024
BLOCK_NUMBERS = 1 << 20
DENSE = 0.1
EXACT = 2.0**52


def levels(dim: int) -> list[np.ndarray]:
    """Starts of 1, 2, 4, ... segments; each level halves the segments of the one before, down to two components."""
    out, starts = [], np.zeros(1, np.int64)
    while True:
        out.append(starts)
        ends = np.append(starts[1:], dim)
        if (ends - starts).max() <= 3:
            return out
        middle = (starts + ends) // 2
        starts = np.unique(np.concatenate([starts, middle]))


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of all levels, side by side; scaled so that a product of means counts its width."""
    dim = vectors.shape[1]
    means, rests = [], []
    for starts in levels(dim):
        width = np.diff(np.append(starts, dim))
        mean = np.add.reduceat(vectors, starts, axis=1) / width
        left = vectors - np.repeat(mean, width, axis=1)
        rests.append(np.sqrt(np.add.reduceat(left * left, starts, axis=1)))
        means.append(mean * np.sqrt(width))
    return np.concatenate(means, axis=1), np.concatenate(rests, axis=1)


class Block:
    """Rows of one block: ids, labels, whole numbers and the summaries of every level."""

    def __init__(self, table: pa.Table, id_col: str):
        column = lambda c: table.column(c).combine_chunks()
        self.ids = column(id_col).to_numpy()
        self.labels = column("label")
        dim = len(column("vec")[0])
        read = lambda c: flat_lists(column(c))[0].reshape(len(self.ids), -1)
        self.vectors, self.means, self.rests = read("vec"), read("means"), read("rests")
        self.size = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.levels = [len(s) for s in levels(dim)]

    def part(self, rows: slice) -> Block:
        out = object.__new__(Block)
        out.ids, out.labels, out.levels = self.ids[rows], self.labels.slice(rows.start, rows.stop - rows.start), self.levels
        out.vectors, out.means, out.rests, out.size = self.vectors[rows], self.means[rows], self.rests[rows], self.size[rows]
        return out


def survivors(a: Block, b: Block, open_: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of the open pairs (anchor, row) may have a score from ``low`` to ``high`` (one each per anchor), level after level."""
    at = 0
    # Rounding of the bounds, in units of the largest score that two vectors can have.
    slack = 1e-9 * np.multiply.outer(a.size, b.size) + 1e-6
    for n in a.levels:
        own = slice(at, at + n)
        at += n
        if open_.mean() > DENSE:
            middle, rest = a.means[:, own] @ b.means[:, own].T, a.rests[:, own] @ b.rests[:, own].T + slack
            open_ &= (middle + rest >= low[:, None]) & (middle - rest <= high[:, None])
        else:
            i, j = np.nonzero(open_)
            middle = np.einsum("ij,ij->i", a.means[i, own], b.means[j, own])
            rest = np.einsum("ij,ij->i", a.rests[i, own], b.rests[j, own]) + slack[i, j]
            out = (middle + rest < low[i]) | (middle - rest > high[i])
            open_[i[out], j[out]] = False
    return open_


def exact(a: Block, b: Block, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the open pairs; scores are whole numbers without rounding."""
    i, j = np.nonzero(open_)
    if a.size.max(initial=0) * b.size.max(initial=0) < EXACT:
        if len(i) > DENSE * open_.size:
            return i, j, np.rint((a.vectors @ b.vectors.T)[i, j]).astype(np.int64)
        return i, j, np.einsum("ij,ij->i", a.vectors[i], b.vectors[j]).astype(np.int64)
    one, two = a.vectors.astype(np.int64), b.vectors.astype(np.int64)
    score = [int(one[x] @ two[y]) for x, y in zip(i, j)]
    return i, j, np.array(score, np.int64)


def _same(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Same label, same id, for every pair."""
    known = a.labels.dictionary_encode()
    one = known.indices.to_numpy()
    two = pc.fill_null(pc.index_in(b.labels, value_set=known.dictionary), -1).to_numpy(zero_copy_only=False)
    return one[:, None] == two[None, :], a.ids[:, None] == b.ids[None, :]


def _best(i: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each anchor, best score first, then smaller id."""
    order = np.lexsort((ids, -score, i))
    first = np.searchsorted(i[order], i[order])
    return order[np.arange(len(order)) - first < k]


def _positives(asked: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of the anchor's label in a block, for every anchor of a block."""
    kinds = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
    if not len(asked) or not len(rows):
        return kinds.empty_table()
    a, whole = Block(asked, "anchor_id"), Block(rows, "vec_id")
    i, ids, score = (np.empty(0, np.int64) for _ in range(3))
    low, high = np.full(len(a.ids), -np.inf), np.full(len(a.ids), np.inf)
    for start in range(0, len(whole.ids), STRIDE):
        b = whole.part(slice(start, min(start + STRIDE, len(whole.ids))))
        label, own = _same(a, b)
        x, y, s = exact(a, b, survivors(a, b, label & ~own, low, high))
        i, ids, score = np.concatenate([i, x]), np.concatenate([ids, b.ids[y]]), np.concatenate([score, s])
        keep = _best(i, ids, score, k)
        i, ids, score = i[keep], ids[keep], score[keep]
        full = np.bincount(i, minlength=len(a.ids)) >= k
        worst = np.full(len(a.ids), np.iinfo(np.int64).max)
        np.minimum.at(worst, i, score)
        low = np.where(full, worst.astype(np.float64), -np.inf)
    return pa.Table.from_arrays([pa.array(a.ids[i]), pa.array(ids), pa.array(score)], schema=kinds)


def _negatives(asked: pa.Table, rows: pa.Table, k: int, percent: int) -> pa.Table:
    """For each positive of every anchor its k best rows of other labels in a block."""
    kinds = pa.schema([(c, pa.int64()) for c in ("anchor_id", "nth", "negative_id", "negative_score")])
    if not len(asked) or not len(rows):
        return kinds.empty_table()
    a, whole = Block(asked, "anchor_id"), Block(rows, "vec_id")
    limits = asked.column("scores").combine_chunks()
    limit, offsets = flat_lists(limits)
    held = np.repeat(np.arange(len(a.ids)), np.diff(offsets))
    nth = np.arange(len(limit)) - offsets[held]
    # Least whole score of each window, in whole numbers.
    least = np.array([-(-percent * s // 100) for s in limit.tolist()], np.int64)
    low, high = np.full(len(a.ids), np.inf), np.full(len(a.ids), -np.inf)
    np.minimum.at(low, held, least)
    np.maximum.at(high, held, limit)
    out = [np.empty(0, np.int64) for _ in range(4)]
    for start in range(0, len(whole.ids), STRIDE):
        b = whole.part(slice(start, min(start + STRIDE, len(whole.ids))))
        label, own = _same(a, b)
        x, y, s = exact(a, b, survivors(a, b, ~label & ~own & (low <= high)[:, None], low, high))
        # Every window of the anchor.
        for n in range(int(np.diff(offsets).max(initial=0))):
            has = np.flatnonzero(np.diff(offsets) > n)
            window = np.full(len(a.ids), -1)
            window[has] = offsets[:-1][has] + n
            w = window[x]
            inside = (w >= 0) & (s >= least[w]) & (s <= limit[w])
            found = [w[inside], b.ids[y[inside]], s[inside]]
            keep = _best(*found, k)
            for c, v in zip((0, 2, 3), found):
                out[c] = np.concatenate([out[c], v[keep]])
        keep = _best(out[0], out[2], out[3], k)
        for c in (0, 2, 3):
            out[c] = out[c][keep]
    w = out[0]
    return pa.Table.from_arrays([pa.array(a.ids[held[w]]), pa.array(nth[w].astype(np.int64)), pa.array(out[2]), pa.array(out[3])], schema=kinds)


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the summaries; vectors of different lengths apart."""
    for batch in batches:
        values, offsets = flat_lists(batch.column("vec"))
        dims = np.diff(offsets)
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            vectors = values[offsets[rows][:, None] + np.arange(dim)]
            ok = (vectors * vectors).sum(axis=1) < 2.0**62
            rows, vectors = rows[ok], vectors[ok]
            made = [
                pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())) for x in summaries(vectors)
            ]
            kept = [c.take(pa.array(rows)) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*batch.schema.names, "means", "rests"])


def whole_rows(df: DataFrame, scale: int, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vec, means, rests) of the rows that take part; labels as text."""
    ok = f"size(vec) > 0 AND vec_id IS NOT NULL AND label IS NOT NULL AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    rows = df.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("vec")
    ).where(ok)
    # floor gives a long; numbers near its limits are whole already and fail the check of squared length.
    whole = rows.withColumn("vec", F.expr(f"transform(vec, x -> CASE WHEN abs({scale} * x) < 9e15D THEN cast(floor({scale} * x) AS double) ELSE {scale} * x END)"))
    return whole.dropDuplicates(["vec_id", "label", "vec"]).mapInArrow(
        _summarised, "vec_id bigint, label string, vec array<double>, means array<double>, rests array<double>"
    )


def _met(anchors: DataFrame, rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on every pair of a block of anchors and a block of rows with vectors of one length."""
    per_block = F.greatest(F.lit(1), F.least(F.lit(ROWS), F.floor(F.lit(BLOCK_NUMBERS) / F.col("dim")))).cast("int")
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    asked = anchors.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n_asked"))
    # One row per length of vector.
    cut = sizes.join(asked, "dim").select("dim", F.expr(f"cast(ceil(n_asked / {ANCHORS}) AS int)").alias("sa"), F.ceil(F.col("n") / per_block).cast("int").alias("sr"))
    cut, _ = materialize(cut, "blocks")
    one = anchors.withColumn("dim", F.size("vec")).join(cut, "dim").withColumns(
        {"block_a": F.expr("cast(pmod(xxhash64(anchor_id), sa) AS int)"), "block_r": F.explode(F.expr("sequence(0, sr - 1)"))}
    ).drop("sa", "sr")
    two = rows.withColumn("dim", F.size("vec")).join(cut, "dim").withColumns(
        {"block_r": F.expr("cast(pmod(xxhash64(vec_id, vec), sr) AS int)"), "block_a": F.explode(F.expr("sequence(0, sa - 1)"))}
    ).drop("sa", "sr")
    keys = ["dim", "block_a", "block_r"]
    return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(work, schema)


def hard_negatives(
    df: DataFrame, anchors: str, positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = 256,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors``: SQL condition on vec_id. An anchor's positives are its best other rows of the same label. For each, the best rows of other labels
    whose score is from ``percent`` of the positive's score to that score.
    """
    rows, _ = materialize(whole_rows(df, scale, id_col, vec_col, label_col), "summarised")
    asked = rows.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "vec", "means", "rests")).alias("row"))
    asked, _ = materialize(asked.select(F.col("vec_id").alias("anchor_id"), "row.*"), "anchors")
    found = _met(asked, rows, lambda a, r: _positives(a, r, positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best, _ = materialize(
        found.withColumn("nth", F.row_number().over(first) - 1).where(F.col("nth") < positives), "positives"
    )
    limits = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("nth", "positive_score"))).alias("x"))
    limits = limits.select("anchor_id", F.col("x.positive_score").alias("scores"))
    seen = _met(
        asked.join(limits, "anchor_id"), rows, lambda a, r: _negatives(a, r, negatives, percent),
        "anchor_id bigint, nth bigint, negative_id bigint, negative_score bigint",
    )
    first = Window.partitionBy("anchor_id", "nth").orderBy(F.desc("negative_score"), "negative_id")
    ranked = seen.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return ranked.join(best.withColumn("nth", F.col("nth").cast("bigint")), ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
