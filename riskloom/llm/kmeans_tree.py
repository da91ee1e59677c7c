"""Approximate nearest neighbours by cosine in a hierarchical k-means tree.

The tree is fitted on a bounded sample (FIT_ROWS rows in expectation, chosen by hash) and at most
FIT_ROWS / LEAF_SAMPLE leaves, so it is small whatever the table; every vector is then indexed under
its leaf. A query walks the tree best bin first: a priority queue holds the nodes seen so far, nearest centre
first, and hands out leaves in that order.

How many leaves to visit is calibrated: the true neighbours of CALIBRATION queries are found by brute force over all
vectors, and visits are widened until leaves visited so far hold ``recall`` of them. Each query also goes on
until its leaves hold enough vectors of other ids for a full answer.

Leaves stand side by side on shelves of a bounded size, a large leaf by pieces on several, so a hot leaf is not one task. A query goes
once to each shelf that has a leaf for it, with one bit for each leaf there, never once for each leaf. A task holds one shelf and takes its
queries block by block. Quick scores in single precision leave out what cannot be among the nearest, by a margin above their
error; the others are scored in double precision on the original vectors. Where much is to be compared, the first leaves of all queries are
searched before the others, which then need a look only at what is as near as the answers so far. Many queries go in rounds, so that their
copies stay in proportion to the rows.

Vectors that are null, zero or hold null or non-finite components take no part. Vectors of each length have a tree of their own, so a
query finds those of its length. A query never finds rows of its own id. If rows repeat an id, its query is asked once (least vector).
Equal scores go by the smaller id. An empty table has no trees and gives no answers; other columns are not read. In the sample repeats of a row count once.
"""

from __future__ import annotations

import heapq
import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial, reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_BYTES, flat_lists, give_back, hash_share, release
from riskloom.llm.projection_passes import vector_ok
from riskloom.session import materialize

FIT_ROWS = 20_000
LEAF_SAMPLE = 16
LEAF_ROWS = 1024
BRANCH = 8
CALIBRATION = 256
SPARE = 32
# Shelves of a table, as far as a shelf keeps at least SHELF_ROWS rows and its vectors take at most SHELF_BYTES.
SHELVES = 64
SHELF_ROWS = 1024
SHELF_BYTES = 32 << 20
# Queries and rows that are compared at once.
BLOCK = 1024
# In one round the copies of queries that go to shelves take at most so many bytes, or are COPIES times the rows if that is more.
COPY_BYTES = 1 << 30
COPIES = 2
# From so many pairs of rows and queries on, one in EARLY of a query's leaves is searched before the others.
EARLY_PAIRS = 1 << 34
EARLY = 16
# The place of queries on a shelf: after all rows.
ASKING = 2**31 - 1


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


@dataclass
class Tree:
    centres: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)  # number of the leaf, -1 for inner nodes

    @property
    def n_leaves(self) -> int:
        return sum(x >= 0 for x in self.leaf)

    def assign(self, units: np.ndarray) -> np.ndarray:
        """Leaf number of each vector: from the root always to the nearest child."""
        node = np.zeros(len(units), np.int64)
        out = np.full(len(units), -1, np.int64)
        todo = np.arange(len(units))
        while len(todo):
            kinds = node[todo]
            for k in np.unique(kinds):
                rows = todo[kinds == k]
                if self.leaf[k] >= 0:
                    out[rows] = self.leaf[k]
                else:
                    kids = np.array(self.children[k])
                    node[rows] = kids[np.argmax(units[rows] @ self.centres[kids].T, axis=1)]
            todo = todo[out[todo] < 0]
        return out

    def best_first(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        return self.below(0, self.centres @ query)

    def below(self, node: int, near: np.ndarray) -> Iterator[int]:
        """Leaves below a node, best bin first; ``near``: how near each centre is."""
        queue = [(0.0, node)]
        while queue:
            _, k = heapq.heappop(queue)
            if self.leaf[k] >= 0:
                yield self.leaf[k]
            else:
                for c in self.children[k]:
                    heapq.heappush(queue, (-near[c], c))

    def paths(self) -> np.ndarray:
        """For each leaf the nodes from below the root to itself, filled up with the number of nodes."""
        found, todo = {}, [(0, [])]
        while todo:
            k, path = todo.pop()
            if self.leaf[k] >= 0:
                found[self.leaf[k]] = path
            todo += [(c, [*path, c]) for c in self.children[k]]
        out = np.full((len(found), max(1, *map(len, found.values()))), len(self.leaf))
        for leaf, path in found.items():
            out[leaf, : len(path)] = path
        return out

    def first_leaves(self, near: np.ndarray, paths: np.ndarray, visits: int, enough: int, sizes: np.ndarray) -> np.ndarray:
        """The first ``visits`` leaves of best_first, and more until they hold ``enough`` vectors.

        A leaf comes up when the farthest node of its path does, so leaves go by that; only those that share the node at which the
        answer ends are put in order by the queue.
        """
        where = np.append(near, np.inf)[paths]
        key = where.min(axis=1)
        order = np.argsort(-key, kind="stable")

        def end() -> int:
            return max(visits, int(np.searchsorted(np.cumsum(sizes[order]), enough)) + 1)

        if (stop := end()) >= len(order):
            return order
        if key[order[stop]] == key[order[stop - 1]]:
            a, b = (np.searchsorted(-key[order], -key[order[stop]], side=x) for x in ("left", "right"))
            node = paths[order[a], where[order[a]].argmin()]
            order[a:b] = list(islice(self.below(node, near), int(b - a)))
            stop = end()
        return order[:stop]


def _split(units: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = units[rng.choice(len(units), k, replace=False)]
    for _ in range(rounds):
        near = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        size = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], centres)
    return centres, np.argmax(units @ centres.T, axis=1)


def fit_tree(units: np.ndarray, leaf_rows: int, branch: int = BRANCH, seed: int = 0) -> Tree:
    """Split nodes of more than ``leaf_rows`` sample vectors; copies of one vector are not split."""
    rng = np.random.default_rng(seed)
    tree = Tree(np.zeros((1, units.shape[1])), [[]], [-1])
    centres, leaves = [tree.centres[0]], 0
    todo = [(0, np.arange(len(units)))]
    while todo:
        k, rows = todo.pop()
        distinct = len(np.unique(units[rows], axis=0)) if len(rows) > leaf_rows else 0
        parts = []
        if distinct > 1:
            found, near = _split(units[rows], min(branch, len(rows)), rng)
            parts = [(found[c], rows[near == c]) for c in range(len(found)) if (near == c).any()]
        if len(parts) < 2:
            tree.leaf[k] = leaves
            leaves += 1
            continue
        for centre, own in parts:
            tree.children[k].append(len(centres))
            todo.append((len(centres), own))
            centres.append(centre)
            tree.children.append([])
            tree.leaf.append(-1)
    tree.centres = np.stack(centres)
    return tree


def _matrix(column: pa.Array) -> np.ndarray:
    values, _ = flat_lists(column)
    return values.reshape(len(column), -1).astype(np.float64)


def _parts(batch: pa.RecordBatch, column: str, most: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of vectors of one length, each with at most ``most`` rows and SLICE_BYTES of doubles, or one row."""
    if batch.num_rows:
        length = len(batch.column(column)[0])
        step = max(1, min(most, SLICE_BYTES // (8 * length)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _assigned(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _parts(batch, "vec"):
            leaf = pa.array(tree.assign(unit(_matrix(part.column("vec")))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*part.columns, leaf], [*part.schema.names, "leaf"])
    give_back()


def _nearest(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, near: np.ndarray, k: int):
    """The k best of a block, exactly scored; ``near`` are its quick scores."""
    near = np.where(ids == query_id, -np.inf, near)
    if len(near) > k:
        rows = np.flatnonzero(near >= np.partition(near, -k)[-k] - 1e-9)
    else:
        rows = np.arange(len(near))
    rows = rows[np.isfinite(near[rows])]
    v = vectors[rows]
    score = (v * query).sum(axis=1) / np.sqrt((v * v).sum(axis=1) * (query * query).sum())
    order = np.lexsort((ids[rows], -score))[:k]
    return rows[order], score[order]


def _truth(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Of each batch the nearest k to each calibration query, with their leaves."""
    asked = unit(queries)
    for batch in (part for whole in batches for part in _parts(whole, "vec")):
        own, vectors, leaf = batch.column("vec_id").to_numpy(), _matrix(batch.column("vec")), batch.column("leaf").to_numpy()
        near = unit(vectors) @ asked.T
        out = [[], [], [], []]
        for j in range(len(ids)):
            rows, score = _nearest(own, vectors, ids[j], queries[j], near[:, j], k)
            for column, x in zip(out, (np.full(len(rows), j), own[rows], leaf[rows], score)):
                column.append(x)
        columns = [np.concatenate(x) for x in out]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q", "vec_id", "leaf", "score"])


@dataclass
class Shelves:
    """Slots, one for each leaf or piece of a leaf, on shelves of consecutive slots."""

    leaf: np.ndarray  # of each slot
    first: np.ndarray  # slot of each shelf, and the number of slots

    @classmethod
    def of(cls, sizes: np.ndarray, most: int) -> Shelves:
        """Shelves of about ``most`` rows at most; ``sizes``: rows of each leaf."""
        leaves, first, held = [], [], np.inf
        for leaf, n in enumerate(sizes):
            pieces = -(-n // most)
            for _ in range(pieces):
                if held + n / pieces > most:
                    first.append(len(leaves))
                    held = 0
                leaves.append(leaf)
                held += n / pieces
        return cls(np.array(leaves, np.int64), np.array([*first, len(leaves)], np.int64))

    def __len__(self) -> int:
        return len(self.first) - 1

    def shelf(self) -> np.ndarray:
        """Shelf of each slot."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def starts(self) -> np.ndarray:
        """In a row of bits, where each shelf has whole bytes: the first byte of each shelf, and the number of bytes."""
        return np.concatenate([[0], np.cumsum(-(-np.diff(self.first) // 8))])

    def bits(self, visited: np.ndarray) -> np.ndarray:
        """Bytes of rows of (leaf is visited)."""
        starts, shelf = self.starts(), self.shelf()
        out = np.zeros((len(visited), 8 * starts[-1]), bool)
        out[:, 8 * starts[shelf] + np.arange(len(self.leaf)) - self.first[shelf]] = visited[:, self.leaf]
        return np.packbits(out, axis=1)


def _bytes(column: pa.Array) -> np.ndarray:
    """Matrix of binary values of one length."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _visits(
    batches: Iterator[pa.RecordBatch], tree: Tree, visits: int, sizes: np.ndarray, k: int, shelves: Shelves, early: bool
) -> Iterator[pa.RecordBatch]:
    """Each query with the bits of its leaves, those searched early on their own."""
    paths = tree.paths()
    for batch in (part for whole in batches for part in _parts(whole, "vec", BLOCK // 4)):
        # Rows of its own id do not count towards a full answer.
        enough = k + np.maximum(SPARE, batch.column("own").to_numpy())
        seen = np.zeros((2, batch.num_rows, len(sizes)), bool)
        for i, near in enumerate(unit(_matrix(batch.column("vec"))) @ tree.centres.T):
            leaves = tree.first_leaves(near, paths, visits, enough[i], sizes)
            stop = -(-len(leaves) // EARLY) if early else 0
            seen[0, i, leaves[:stop]] = seen[1, i, leaves[stop:]] = True
        bits = [pa.array([x.tobytes() for x in shelves.bits(part)], pa.binary()) for part in seen]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vec"), *bits], ["query_id", "query", "early", "seen"])
    give_back()


def _any_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of all bits that are set in each column."""
    any_of = None
    for batch in batches:
        if batch.num_rows:
            own = [np.bitwise_or.reduce(_bytes(c), axis=0) for c in batch.columns]
            any_of = own if any_of is None else [x | y for x, y in zip(any_of, own)]
    if any_of is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in any_of], batch.schema.names)


def _dealt(batches: Iterator[pa.RecordBatch], shelves: Shelves) -> Iterator[pa.RecordBatch]:
    """Each query once for each of its shelves, with its bits there and the score below which nothing is asked."""
    starts = shelves.starts()
    for batch in (part for whole in batches for part in _parts(whole, "query", BLOCK)):
        seen = _bytes(batch.column("seen"))
        for shelf in range(len(shelves)):
            own = seen[:, starts[shelf] : starts[shelf + 1]]
            if len(who := np.flatnonzero(own.any(axis=1))):
                take = pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(who), shelf, np.int32)), pa.array(np.full(len(who), ASKING, np.int32)),
                        batch.column("query_id").take(take), batch.column("query").take(take),
                        pa.array([x.tobytes() for x in own[who]], pa.binary()), batch.column("floor").take(take),
                    ],
                    ["shelf", "slot", "id", "vec", "seen", "floor"],
                )
    give_back()


class Shelf:
    """Rows of one shelf in the order of their slots, and the nearest of them to queries."""

    def __init__(self, first: int, slots: int, k: int):
        self.first, self.slots, self.k, self.parts = first, slots, k, []

    def add(self, batch: pa.RecordBatch) -> None:
        values, _ = flat_lists(batch.column("vec"))
        ids, slots = batch.column("id").to_numpy(), batch.column("slot").to_numpy()
        self.parts.append((ids.copy(), slots - self.first, values.reshape(len(ids), -1).copy()))

    def close(self) -> None:
        """No more rows."""
        self.ids, slots = (np.concatenate([x[i] for x in self.parts]) for i in (0, 1))
        self.rows = np.concatenate([x[2] for x in self.parts])
        self.parts = None
        n, length = self.rows.shape
        self.units, self.squares = np.empty((n, length), np.float32), np.empty(n)
        step = max(1, SLICE_BYTES // (8 * length))
        for a in range(0, n, step):
            v = self.rows[a : a + step].astype(np.float64)
            with np.errstate(all="ignore"):
                self.units[a : a + step], self.squares[a : a + step] = unit(v), (v * v).sum(axis=1)
        fine = np.isfinite(self.units).all(axis=1)
        if not fine.all():  # vectors so short that their length is lost
            self.ids, slots, self.rows, self.units, self.squares = (x[fine] for x in (self.ids, slots, self.rows, self.units, self.squares))
            n = len(slots)
        # Twice the error of a single precision score, and more.
        self.margin = (length + 8) * 2.0**-22
        self.by_id = np.argsort(self.ids, kind="stable")
        self.sorted_ids = self.ids[self.by_id]
        # Bundles of at most BLOCK rows: (first row, end, [(slot, first row, end)]).
        self.bundles, edges = [], [*np.flatnonzero(np.diff(slots, prepend=-1)).tolist(), n]
        for a, b in zip(edges, edges[1:]):
            for x in range(a, b, BLOCK):
                y, slot = min(b, x + BLOCK), int(slots[a])
                if self.bundles and y - self.bundles[-1][0] <= BLOCK:
                    start, _, held = self.bundles.pop()
                    self.bundles.append((start, y, [*held, (slot, x, y)]))
                else:
                    self.bundles.append((x, y, [(slot, x, y)]))

    def answers(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.parts == []:  # all rows of the leaf are in other pieces
            return
        if self.parts:
            self.close()
        for part in _parts(batch, "vec", BLOCK):
            seen = np.unpackbits(_bytes(part.column("seen")), axis=1, count=self.slots).astype(bool)
            ids = part.column("id").to_numpy()
            best = Best(self, ids, _matrix(part.column("vec")), part.column("floor").to_numpy(zero_copy_only=False))
            for i, (a, b, held) in enumerate(self.bundles):
                best.look(a, b, held, seen)
                if i & (i + 1) == 0:  # the bar is raised each time that twice the rows are seen
                    best.settle()
            best.settle()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[best.full.nonzero()[0]]), pa.array(best.ids[best.full]), pa.array(best.scores[best.full])],
                ["query_id", "vec_id", "score"],
            )


class Best:
    """The k nearest so far to each query of a block."""

    def __init__(self, shelf: Shelf, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray):
        self.shelf, self.queries, n = shelf, queries, len(ids)
        with np.errstate(all="ignore"):
            self.units, self.squares = unit(queries).astype(np.float32), (queries * queries).sum(axis=1)
        self.ids, self.scores = np.zeros((n, shelf.k), np.int64), np.zeros((n, shelf.k))
        self.full = np.zeros((n, shelf.k), bool)
        # Quick scores below it need no look.
        self.bar = np.where(np.isnan(floor), -2, np.maximum(floor - shelf.margin, -2)).astype(np.float32)
        self.found, self.held = [], 0
        # Rows of a query's own id.
        start, end = (np.searchsorted(shelf.sorted_ids, ids, side=x) for x in ("left", "right"))
        count = end - start
        asking = np.repeat(np.arange(n), count)
        own = shelf.by_id[np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)]
        order = np.argsort(own, kind="stable")
        self.own_rows, self.own_queries = own[order], asking[order]

    def look(self, a: int, b: int, held: list[tuple[int, int, int]], seen: np.ndarray) -> None:
        """Note rows from a to b that may be among the nearest; ``seen``: whether a query visits a slot."""
        slots = [x[0] for x in held]
        who = np.flatnonzero(seen[:, slots].any(axis=1))
        if not len(who):
            return
        near = self.units[who] @ self.shelf.units[a:b].T
        if len(slots) > 1:
            for slot, x, y in held:
                hidden = ~seen[who, slot]
                if hidden.any():
                    near[hidden, x - a : y - a] = -np.inf
        x, y = np.searchsorted(self.own_rows, [a, b])
        if y > x:
            place = np.full(len(self.queries), -1)
            place[who] = np.arange(len(who))
            at = place[self.own_queries[x:y]]
            near[at[at >= 0], self.own_rows[x:y][at >= 0] - a] = -np.inf
        bar = self.bar[who]
        new = bar <= -2
        if new.any() and b - a > self.shelf.k:
            least = np.partition(near[new], b - a - self.shelf.k, axis=1)[:, -self.shelf.k]
            bar[new] = np.maximum(least - self.shelf.margin, -2)
        some = np.flatnonzero(near.max(axis=1) >= bar)
        at = np.flatnonzero(near[some] >= bar[some, None])
        self.found.append((who[some[at // (b - a)]], at % (b - a) + a))
        self.held += len(at)
        if self.held > BLOCK * 64:
            self.settle()

    def settle(self) -> None:
        """Score the noted rows and keep the nearest."""
        if not self.held:
            return
        asking, rows = (np.concatenate([x[i] for x in self.found]) for i in (0, 1))
        self.found, self.held = [], 0
        order = np.argsort(asking, kind="stable")
        step = max(1, SLICE_BYTES // (8 * self.queries.shape[1]))
        for start in range(0, len(order), step):
            part = order[start : start + step]
            self._keep(asking[part], rows[part])

    def _keep(self, asking: np.ndarray, rows: np.ndarray) -> None:
        """``asking`` goes up."""
        shelf, k = self.shelf, self.shelf.k
        with np.errstate(all="ignore"):
            score = (shelf.rows[rows].astype(np.float64) * self.queries[asking]).sum(axis=1)
            score /= np.sqrt(shelf.squares[rows] * self.squares[asking])
        new = np.diff(asking, prepend=-1) > 0
        who = asking[new]
        kept, place = self.full[who].nonzero()
        query = np.concatenate([np.cumsum(new) - 1, kept])
        ids = np.concatenate([shelf.ids[rows], self.ids[who[kept], place]])
        score = np.concatenate([score, self.scores[who[kept], place]])
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, np.arange(len(who)))[query]
        best = rank < k
        at = who[query[best]], rank[best]
        self.full[at], self.ids[at], self.scores[at] = True, ids[best], score[best]
        done = who[self.full[who, k - 1]]
        self.bar[done] = np.fmax(self.scores[done, k - 1] - shelf.margin, self.bar[done])


def _answers(batches: Iterator[pa.RecordBatch], k: int, first: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows come by shelf and slot, the queries of a shelf after its rows."""
    at, shelf = -1, None
    for batch in batches:
        if not batch.num_rows:
            continue
        shelves, asks = batch.column("shelf").to_numpy(), batch.column("slot").to_numpy() == ASKING
        cuts = (np.flatnonzero((shelves[1:] != shelves[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if shelves[a] != at:
                at = int(shelves[a])
                shelf = Shelf(int(first[at]), int(first[at + 1] - first[at]), k)
            part = batch.slice(a, b - a)
            if asks[a]:
                yield from shelf.answers(part)
            else:
                shelf.add(part)
    give_back()


class LengthIndex:
    """Index of rows (vec_id, vec) whose vectors all have one length."""

    def __init__(self, rows: DataFrame, n: int, fit_rows: int, seed: int):
        self.spark = rows.sparkSession
        # Repeats of a row are one row of the sample, so it stays bounded whatever repeats.
        # As doubles, so that the sample and its order do not depend on how the numbers are stored.
        doubles = rows.select("vec_id", F.col("vec").cast("array<double>").alias("vec"))
        picked = doubles.where(hash_share(F.xxhash64("vec_id", "vec"), fit_rows / max(n, 1))).dropDuplicates(["vec_id", "vec"])
        sample = picked.select("vec").toArrow().column("vec").combine_chunks()
        if not len(sample):  # a short table whose rows all hash low
            sample = rows.select("vec").limit(1).toArrow().column("vec").combine_chunks()
        matrix = _matrix(sample)
        leaf_rows = max(LEAF_SAMPLE, round(LEAF_ROWS * len(matrix) / n))
        self.tree = fit_tree(unit(matrix), leaf_rows, seed=seed)
        kept = rows.withColumn("n", F.monotonically_increasing_id())
        self.rows, self.n_rows = materialize(
            kept.mapInArrow(partial(_assigned, tree=self.tree), f"vec_id bigint, vec {_kind(rows, 'vec')}, n bigint, leaf int"), "index"
        )
        # One number per leaf, bounded by the tree.
        self.sizes = {r["leaf"]: r["count"] for r in self.rows.groupBy("leaf").count().collect()}

    def calibrate(self, queries: DataFrame, k: int, recall: float, most: int = CALIBRATION) -> int:
        """Leaves to visit so that ``recall`` of the true neighbours of a bounded set of queries are in them."""
        n = queries.count()
        asked = queries.where(hash_share(F.xxhash64("vec_id"), most / max(n, 1))).select("vec_id", "vec").toArrow()
        if not len(asked):
            return self.tree.n_leaves
        ids, vectors = asked.column("vec_id").to_numpy(), _matrix(asked.column("vec").combine_chunks())
        near = self.rows.select("vec_id", "vec", "leaf").mapInArrow(
            partial(_truth, ids=ids, queries=vectors, k=k), "q bigint, vec_id bigint, leaf int, score double"
        )
        first = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        true = near.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k).select("q", "leaf").collect()
        place = [{leaf: i for i, leaf in enumerate(self.tree.best_first(q))} for q in unit(vectors)]
        ranks = np.array([place[r["q"]][r["leaf"]] for r in true])
        for visits in range(1, self.tree.n_leaves + 1):
            if not len(ranks) or (ranks < visits).mean() >= recall:
                return visits
        return self.tree.n_leaves

    def search(self, asked: DataFrame, k: int, recall: float) -> DataFrame:
        """query_id, vec_id, score: the k nearest of each shelf for each row (vec_id, vec) of ``asked``, whose ids differ."""
        schema = "query_id bigint, vec_id bigint, score double"
        own = self.rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("own"))
        asked, n_asked = materialize(asked.join(own, "vec_id", "left").withColumn("own", F.coalesce("own", F.lit(0))), "queries")
        visits = self.calibrate(asked, k, recall)
        sizes = np.array([self.sizes.get(i, 0) for i in range(self.tree.n_leaves)])
        kind = _kind(self.rows, "vec") if _kind(self.rows, "vec") == _kind(asked, "vec") else "array<double>"
        width = self.tree.centres.shape[1] * (4 if kind == "array<float>" else 8)
        shelves = Shelves.of(sizes, max(1, min(SHELF_BYTES // width, max(SHELF_ROWS, -(-self.n_rows // SHELVES)))))
        early = n_asked * self.n_rows >= EARLY_PAIRS and visits >= EARLY
        visited, _ = materialize(
            asked.withColumn("vec", F.col("vec").cast(kind)).mapInArrow(
                partial(_visits, tree=self.tree, visits=visits, sizes=sizes, k=k, shelves=shelves, early=early),
                f"query_id bigint, query {kind}, early binary, seen binary",
            ),
            "visits",
        )
        # One row per task, as many bits as there are slots.
        bits = visited.select("early", "seen").mapInArrow(_any_bits, "early binary, seen binary").collect()
        if not bits:
            return self.spark.createDataFrame([], schema)
        rows = {
            part: self._on_shelves(shelves, np.bitwise_or.reduce([np.frombuffer(r[part], np.uint8) for r in bits]), kind)
            for part in (("early", "seen") if early else ("seen",))
        }

        def look(queries: DataFrame, part: str) -> DataFrame:
            dealt = queries.select("query_id", "query", F.col(part).alias("seen"), "floor").mapInArrow(
                partial(_dealt, shelves=shelves), f"shelf int, slot int, id bigint, vec {kind}, seen binary, floor double"
            )
            # A task may get several shelves by chance; it holds one at a time.
            by_shelf = rows[part].unionByName(dealt).repartition(2 * len(shelves), "shelf").sortWithinPartitions("shelf", "slot")
            return by_shelf.mapInArrow(partial(_answers, k=k, first=shelves.first), schema)

        rounds = -(-n_asked * len(shelves) // max(COPY_BYTES // width, COPIES * self.n_rows))
        found = []
        for i in range(rounds):
            some = visited.where(F.expr(f"pmod(xxhash64(query_id), {rounds}) = {i}")) if rounds > 1 else visited
            some = some.withColumn("floor", F.lit(None).cast("double"))
            parts = []
            if early:
                first, _ = materialize(_nearest_of(look(some, "early"), k), "early")
                _let_go(self.spark)
                floors = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
                parts, some = [first.drop("rank")], some.drop("floor").join(floors, "query_id", "left")
            found.append(reduce(DataFrame.unionByName, [*parts, look(some, "seen")]))
            if rounds > 1:
                found[i], _ = materialize(_nearest_of(found[i], k).drop("rank"), "found")
                _let_go(self.spark)
        return reduce(DataFrame.unionByName, found)

    def _on_shelves(self, shelves: Shelves, seen: np.ndarray, kind: str) -> DataFrame:
        """Rows of the leaves that are asked, with their shelves and slots; ``seen``: bytes of the slots' bits."""
        # One row per leaf, bounded by the tree, and per piece: where its rows go.
        places: dict[int, list[tuple[int, int]]] = {}
        starts, shelf = shelves.starts(), shelves.shelf()
        asked = np.unpackbits(seen)[8 * starts[shelf] + np.arange(len(shelf)) - shelves.first[shelf]]
        for slot in np.flatnonzero(asked).tolist():
            places.setdefault(int(shelves.leaf[slot]), []).append((int(shelf[slot]), slot))
        where = self.spark.createDataFrame(list(places.items()), "leaf int, places array<struct<shelf: int, slot: int>>")
        at = F.expr("places[cast(pmod(xxhash64(n), size(places)) AS int)]")
        return self.rows.join(F.broadcast(where), "leaf").withColumn("at", at).select(
            "at.shelf", "at.slot", F.col("vec_id").alias("id"), F.col("vec").cast(kind),
            F.lit(None).cast("binary").alias("seen"), F.lit(None).cast("double").alias("floor"),
        )


class TreeIndex:
    """Index of all usable rows of a table of (id, vector), each length on its own."""

    def __init__(self, df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", fit_rows: int = FIT_ROWS, seed: int = 0):
        self.spark = df.sparkSession
        rows = usable(df, id_col, vec_col)
        lengths = rows.groupBy(F.size("vec").alias("dim")).count().collect()
        self.parts = {r["dim"]: LengthIndex(rows.where(F.size("vec") == r["dim"]), r["count"], fit_rows, seed) for r in lengths}

    def search(self, queries: DataFrame, k: int = 5, recall: float = 0.97) -> DataFrame:
        """query_id, rank, vec_id, score of the k nearest found for each row (vec_id, vec) of ``queries``."""
        asked, _ = materialize(queries.groupBy("vec_id").agg(F.min("vec").alias("vec")), "asked")
        found = self.spark.createDataFrame([], "query_id bigint, vec_id bigint, score double")
        for dim, part in sorted(self.parts.items()):
            found = found.unionByName(part.search(asked.where(F.size("vec") == dim), k, recall))
        return _nearest_of(found, k)


def _nearest_of(found: DataFrame, k: int) -> DataFrame:
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _let_go(spark: SparkSession) -> None:
    """Drop the shuffle files of what is stored by now: the plan of a join goes only with the second collection."""
    for _ in range(2):
        release(spark)
        time.sleep(0.3)


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec) of the rows that can ask; vec holds floats or else doubles."""
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("vec"))
    if _kind(rows, "vec") != "array<float>":
        rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))
    return rows.where("vec_id IS NOT NULL").where(vector_ok("vec"))
