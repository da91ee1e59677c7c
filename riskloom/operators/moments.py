"""Correlation of many columns by tiles of sums of products, merged in a tree.

Every task runs over its rows once and keeps, for each pair of column tiles, six matrices: how many rows hold both columns, the means of
either over those rows, and the centred sums of squares and products. Two such sets merge exactly (the pairwise update of
means and centred sums), so batches, tasks and levels of the tree use one and the same step, and nothing loses digits
to large means. A set travels as one binary value per tile pair; FAN of them meet at a node of the tree, so no task holds more
than FAN sets whatever the number of tasks. Column names come from a small table at the end: the plan does not grow with the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize

TILE = 128
FAN = 16
# Bytes of sums that a task holds; tables with more columns are read once for each share of the tile pairs.
STATE_BYTES = 256 << 20
STATE = "part int, i int, j int, state binary"


def tile_sums(x: np.ndarray, y: np.ndarray, shift_x: np.ndarray, shift_y: np.ndarray) -> np.ndarray:
    """(n, mean x, mean y, xx, yy, xy) for every pair of a column of x and one of y, over the rows that hold both."""
    here, there = ~np.isnan(x), ~np.isnan(y)
    a, b = np.where(here, x - shift_x, 0.0), np.where(there, y - shift_y, 0.0)
    p, q = here.astype(float), there.astype(float)
    n, sx, sy = p.T @ q, a.T @ q, p.T @ b
    some = np.maximum(n, 1.0)
    xx, yy, xy = (a * a).T @ q - sx * sx / some, p.T @ (b * b) - sy * sy / some, a.T @ b - sx * sy / some
    return np.stack([n, shift_x[:, None] + sx / some, shift_y[None, :] + sy / some, np.maximum(xx, 0), np.maximum(yy, 0), xy])


def merged(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The sums over the rows of both."""
    n = one[0] + two[0]
    share = two[0] / np.maximum(n, 1.0)
    dx, dy = (np.where(one[0] > 0, two[k] - one[k], 0.0) for k in (1, 2))
    weight = one[0] * share
    mean = [np.where(one[0] > 0, one[k] + d * share, two[k]) for k, d in ((1, dx), (2, dy))]
    return np.stack([n, *mean, one[3] + two[3] + weight * dx * dx, one[4] + two[4] + weight * dy * dy, one[5] + two[5] + weight * dx * dy])


def _tiles(p: int) -> list[tuple[int, int]]:
    n = -(-p // TILE)
    return [(i, j) for i in range(n) for j in range(i, n)]


def _states(batches: Iterator[pa.RecordBatch], p: int, pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(0)
        x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, p)
        known = ~np.isnan(x)
        shift = np.where(known, x, 0.0).sum(axis=0) / np.maximum(known.sum(axis=0), 1)
        shift = np.where(np.isfinite(shift), shift, 0.0)
        for i, j in pairs:
            a, b = slice(i * TILE, (i + 1) * TILE), slice(j * TILE, (j + 1) * TILE)
            new = tile_sums(x[:, a], x[:, b], shift[a], shift[b])
            held[i, j] = merged(held[i, j], new) if (i, j) in held else new
    part = TaskContext.get().partitionId()
    for (i, j), state in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([state.tobytes()], pa.binary())],
            ["part", "i", "j", "state"],
        )


def _met(rows: pa.Table, p: int) -> np.ndarray:
    i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    shape = (6, min(TILE, p - i * TILE), min(TILE, p - j * TILE))
    # The order of parts decides the last digits only; sorted, so that a repeated task agrees.
    order = np.argsort(rows.column("part").to_numpy(), kind="stable")
    total = None
    for k in order.tolist():
        state = np.frombuffer(rows.column("state")[k].as_py(), float).reshape(shape)
        total = state if total is None else merged(total, state)
    return total


def _node(rows: pa.Table, p: int) -> pa.Table:
    return pa.table({
        "part": pa.array([rows.column("node")[0].as_py()], pa.int32()), "i": rows.column("i").slice(0, 1), "j": rows.column("j").slice(0, 1),
        "state": pa.array([_met(rows, p).tobytes()], pa.binary()),
    })


def _corr(rows: pa.Table, p: int) -> pa.Table:
    """(left, right, corr) of the pairs of a tile pair, the left column before the right one."""
    n, mx, my, xx, yy, xy = _met(rows, p)
    i, j = rows.column("i")[0].as_py() * TILE, rows.column("j")[0].as_py() * TILE
    # A constant column has no spread but for rounding.
    flat = (xx <= 1e-28 * n * mx * mx) | (yy <= 1e-28 * n * my * my) | (xx == 0) | (yy == 0) | (n < 2)
    with np.errstate(all="ignore"):
        corr = np.where(flat, np.nan, xy / np.sqrt(xx * yy))
    left, right = np.meshgrid(np.arange(n.shape[0]) + i, np.arange(n.shape[1]) + j, indexing="ij")
    use = left < right
    value = np.clip(corr[use], -1.0, 1.0)
    return pa.table({
        "left": pa.array(left[use].astype(np.int32)), "right": pa.array(right[use].astype(np.int32)), "corr": pa.array(value, pa.float64(), mask=flat[use]),
    })


def tiled_corr(values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(f1, f2, corr) for f1 before f2 of a frame with one column, an array with a number or null for each of ``columns``."""
    spark, p = values.sparkSession, len(columns)
    pairs = _tiles(p)
    share = max(1, STATE_BYTES // (6 * 8 * TILE * TILE))
    states = None
    for k in range(0, len(pairs), share):
        made = values.mapInArrow(partial(_states, p=p, pairs=pairs[k : k + share]), STATE)
        states = made if states is None else states.unionByName(made)
    states, _ = materialize(states, "tile-sums")
    parts = (states.agg(F.max("part")).first()[0] or 0) + 1
    while parts > FAN:
        nodes = states.withColumn("node", F.expr(f"part div {FAN}").cast("int"))
        states = nodes.groupBy("i", "j", "node").applyInArrow(lambda rows: _node(rows, p), STATE)
        parts = -(-parts // FAN)
    corr = states.groupBy("i", "j").applyInArrow(lambda rows: _corr(rows, p), "left int, right int, corr double")
    names = spark.createDataFrame(list(enumerate(columns)), "place int, name string")
    one, two = (F.broadcast(names.toDF(side, f)) for side, f in (("left", "f1"), ("right", "f2")))
    return corr.join(one, "left").join(two, "right").select("f1", "f2", "corr")
