"""Quality classifier: naive Bayes log-count ratios as feature scales of a linear hinge-loss model.

Features are indicators of n-grams: single words, and runs of one to three word shapes (letter case and trailing signs,
with a mark of its own for a word that repeats the one before). They are hashed into a fixed number of buckets.
The log-count ratio of each bucket is counted over all labelled training rows. The linear model is fitted on at most about FIT_ROWS
of them (chosen by hash, a documented bound) by dual coordinate descent; a fifth of these is held back to turn
margins into probabilities. Every text is then scored whole.

Null, empty and white-space texts have no features and get the score of the bias alone. Rows without a quality label
are not learned from; if there is one class only, or none, every row gets the same score. Repeated rows count each in the ratios and once in
the sample; ties in the order of the sample are repeats. An empty table gives an empty result; other columns stay as they are, and ``out`` must name none of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_if_small, flat_lists, hash_share, slices
from riskloom.llm.words import mix, split_words, word_hashes
from riskloom.session import materialize

WORD_BUCKETS = 1 << 17
SHAPE_BUCKETS = 1 << 14
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
FIT_ROWS = 8_000
SHAPE_RUN = 3
# Rows of each class that the held-back fifth needs; with fewer, margins are calibrated on all sampled rows.
LEAST_HELD = 5
# Bytes of text whose features are in memory at once.
SLICE = 1 << 20
REPEATED = np.uint64(0xD6E8FEB86659FD93)


def _shapes(words: pa.Array) -> np.ndarray:
    """A hash of each word's case and trailing signs."""
    coded = words.dictionary_encode()
    w = coded.dictionary
    body = pc.utf8_rtrim(w, "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    tails = pc.utf8_slice_codeunits(w, -3)
    plain = pc.equal(pc.binary_length(body), pc.binary_length(w))
    tails = pc.if_else(plain, "", pc.if_else(pc.less(pc.subtract(pc.utf8_length(w), pc.utf8_length(body)), 3), pc.utf8_slice_codeunits(w, -1), tails))
    tails = tails.dictionary_encode()
    ends = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in tails.dictionary.to_pylist()), np.uint64)
    kind = np.zeros(len(w), np.uint64)
    tests = (pc.utf8_is_upper(body), pc.utf8_is_lower(body), pc.utf8_is_title(body), pc.utf8_is_alpha(body), pc.utf8_is_alnum(body), pc.less(pc.utf8_length(body), 2))
    for bit, flag in enumerate(tests):
        kind |= flag.to_numpy(zero_copy_only=False).astype(np.uint64) << np.uint64(bit)
    each = mix(ends[tails.indices.to_numpy()] + kind) if len(w) else kind
    return each[coded.indices.to_numpy()]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets of each text in a row, offsets)."""
    words, offsets = split_words(texts)
    if not len(words):
        return np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    hashes, shapes = word_hashes(pc.utf8_lower(words)), _shapes(words)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    shapes = np.where(again, REPEATED, shapes)
    keys = [(owner, (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64))]
    run = np.zeros(len(shapes), np.uint64)
    for n in range(1, SHAPE_RUN + 1):
        last = len(shapes) - n + 1
        if last <= 0:
            break
        run = mix(run[:last] * np.uint64(0x9E3779B97F4A7C15) + shapes[n - 1 :] + np.uint64(n))
        inside = owner[:last] == owner[n - 1 :]
        keys.append((owner[:last][inside], WORD_BUCKETS + (run[inside] % np.uint64(SHAPE_BUCKETS)).astype(np.int64)))
    both = np.unique(np.concatenate([o * BUCKETS + b for o, b in keys]))
    return both % BUCKETS, np.searchsorted(both, np.arange(len(texts) + 1) * BUCKETS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each label that hold each bucket; bucket -1 counts all rows. One array per task."""
    total = np.zeros((2, BUCKETS + 1), np.int64)
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            found, offsets = features(rows.column("text"))
            label = rows.column("label").to_numpy()
            each = np.repeat(label, np.diff(offsets))
            for y in (0, 1):
                total[y, :-1] += np.bincount(found[each == y], minlength=BUCKETS)
                total[y, -1] += int((label == y).sum())
    held = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.where(held == BUCKETS, -1, held).astype(np.int32)), pa.array(total[0, held]), pa.array(total[1, held])],
        ["bucket", "n0", "n1"],
    )


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            found, offsets = features(rows.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([rows.column("h"), rows.column("label"), lists], ["h", "label", "buckets"])


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: float = 1.0, epochs: int = 20, seed: int = 0) -> np.ndarray:
    """Weights of the L1-loss linear support vector machine, one dual variable at a time."""
    rng = np.random.default_rng(seed)
    w, alpha = np.zeros(size), np.zeros(len(y))
    square = np.array([float(v @ v) for v in values])
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            if not square[i]:
                continue
            gradient = y[i] * float(w[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return w


def _sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities (Platt's targets, Newton steps)."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, float(np.log((up + 1) / (down + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        d, s = p - target, p * (1 - p) + 1e-9
        g = np.array([(d * margin).sum() + 1e-3 * a, d.sum()])
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass
class Model:
    """weight: the linear model times the ratio of each bucket, for indicators; scale: the ratios, for the norm."""

    weight: np.ndarray
    scale: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of unit-length rows of scaled indicators."""
        sums = [np.concatenate([[0.0], np.cumsum(x[found])]) for x in (self.weight, self.scale**2)]
        dot, square = (s[offsets[1:]] - s[offsets[:-1]] for s in sums)
        return np.where(square > 1e-12, dot / np.sqrt(np.maximum(square, 1e-12)), 0.0) + self.bias

    def scores(self, found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(found, offsets) + self.offset, -35, 35)))


def fit(df: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, cost: float = 1.0) -> Model:
    """Learn label 1 against 0 from rows of ``df`` (doc_id, text) joined to ``labels`` (doc_id, label)."""
    known, n = materialize(labels.select("doc_id", F.col("label").cast("int").alias("label")).where("label IN (0, 1)"), "labels")
    rows = df.select("doc_id", "text").join(broadcast_if_small(known, n), "doc_id")
    each = rows.select("label", "text").mapInArrow(_counts, "bucket int, n0 bigint, n1 bigint")
    # At most one row per bucket, a fixed number.
    counts = each.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    bucket, n0, n1 = (counts.column(c).to_numpy() for c in ("bucket", "n0", "n1"))
    all0, all1 = (int(x[bucket < 0].sum()) for x in (n0, n1))
    if not all0 or not all1:
        odds = float(np.log((all1 + 1) / (all0 + 1)))
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, odds)
    p, q = np.ones(BUCKETS), np.ones(BUCKETS)
    p[bucket[bucket >= 0]] += n1[bucket >= 0]
    q[bucket[bucket >= 0]] += n0[bucket >= 0]
    ratio = np.log((p / (all1 + 2)) / (q / (all0 + 2)))
    picked = hash_share(F.col("h"), fit_rows / (all0 + all1))
    # Repeats of a row count once here (the ratios count all), so the sample stays bounded whatever repeats.
    sample = rows.withColumn("h", F.xxhash64("doc_id", "text")).where(picked).groupBy("h", "label").agg(F.first("text").alias("text"))
    table = sample.mapInArrow(_sampled, "h bigint, label int, buckets array<int>").toArrow()
    order = np.argsort(table.column("h").to_numpy(), kind="stable")
    lists = table.column("buckets").combine_chunks()
    found, offsets = flat_lists(lists)
    index = [found[offsets[i] : offsets[i + 1]] for i in order]
    y = np.where(table.column("label").to_numpy()[order] == 1, 1.0, -1.0)
    values = [ratio[x] for x in index]
    values = [v / max(np.sqrt(float(v @ v)), 1e-6) for v in values]
    # The bias is one more feature of every row.
    index = [np.append(x, BUCKETS) for x in index]
    values = [np.append(v, 1.0) for v in values]
    back = np.arange(len(y)) % 5 == 0
    own = [i for i in range(len(y)) if not back[i]]
    w = dual_descent([index[i] for i in own], [values[i] for i in own], y[own], BUCKETS + 1, cost)
    if min((y[back] > 0).sum(), (y[back] < 0).sum()) < LEAST_HELD:
        back = np.ones(len(y), bool)
    margin = np.array([float(w[index[i]] @ values[i]) for i in np.flatnonzero(back)])
    slope, offset = _sigmoid(margin, y[back]) if len(margin) else (1.0, 0.0)
    return Model(w[:BUCKETS] * ratio, ratio, float(w[BUCKETS]), slope, offset)


def _scored(batches: Iterator[pa.RecordBatch], model: Model, out: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            score = pa.array(model.scores(*features(rows.column("text"))))
            yield pa.RecordBatch.from_arrays([*rows.columns, score], [*rows.schema.names, out])


def score(df: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """The rows of ``df`` (it must hold ``text`` and no column ``out``) with a score from 0 to 1. The model has a fixed size."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.mapInArrow(partial(_scored, model=model, out=out), f"{kinds}, `{out}` double")


def held_out() -> Column:
    """Rows kept away from learning: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit_quality(df: DataFrame, labels: DataFrame) -> Model:
    """Learn ``quality`` from the rows that are not held out."""
    learned = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out())
    return fit(df, learned)
