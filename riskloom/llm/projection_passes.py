"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets a key of KEY_BITS signs of fresh random projections, and the vectors of a label are put in the lexicographic
order of their keys. Each is compared with the WINDOW ones after it, and beyond them for as long as neighbours still share their first
``prefix_bits`` signs. Pairs are verified by their inner product as unit vectors of 16-bit numbers, whose rounding is bounded and
let through; verified pairs of all passes are united to components. Inside each component all vectors are compared by cosine in
double precision on the original vectors, block against block; that gives the links, their number for every row, and the final components.

The number of passes follows the length of the prefix, so that a pair right at the threshold shares no prefix in any pass with a
probability below LOST, whatever the other vectors are. A prefix shared by more than PART vectors (a dense label) is cut into parts of PART rows,
and every two parts meet in a task of their own. A label in which the windows of all passes would hold more pairs than the label has, a small one or
one whose vectors are all but alike, is put in order once and compared whole. So the pairs compared grow nearly in proportion to the vectors where directions
are spread, and with the square in a label whose vectors all lie not far below the threshold, where no order of signs tells
links from others. Vectors that only look alike are never united, so such a label without links costs nothing after the passes.

Equal vectors of one label are one class from the start and never compared. Vectors that are null, zero or hold null or
non-finite components, and rows without a label, link with nothing. Labels of any type are compared as text. Vectors of different lengths never link. Rows with
the same id are separate rows; a component is named after its smallest id; ties do not arise, for a link is one or none. An empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_if_small, flat_lists
from riskloom.llm.graph import components
from riskloom.session import materialize

WINDOW = 8
PROBES = 3
KEY_BITS = 62
LOST = 1e-6
PART = 1024
BLOCK = 256
STRIPE = 16
# Fine enough that rounding moves an inner product by less than the slack.
SCALE = 32_000
HEAD = ["pass", "dim", "label", "prefix"]
TILE = [*HEAD, "one", "two"]


def prefix_bits(n: int, window: int = WINDOW) -> int:
    """Signs that single out ``window`` of n evenly spread vectors."""
    return min(KEY_BITS, max(1, math.ceil(math.log2(max(2.0, n / window)))))


def passes_for(n: int, threshold: float, window: int = WINDOW, lost: float = LOST) -> int:
    """Passes after which a pair at the threshold has shared no prefix with probability ``lost``.

    In a pass the two meet if the signs of their prefixes agree. This does not depend on other vectors, since windows go on while a prefix is shared.
    """
    differ = math.acos(threshold) / math.pi
    meet = (1 - differ) ** prefix_bits(n, window)
    return max(8, math.ceil(math.log(lost) / math.log(1 - meet)))


def slack(dim: int) -> float:
    """Bound on how far 16-bit rounding moves the inner product of two unit vectors."""
    error = 0.5 * math.sqrt(dim) / SCALE
    return 2 * error + error * error + 1e-6


def _planes(seed: int, bits: int, dim: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits))


def vector_ok(column: str) -> str:
    """SQL: the vector can be compared."""
    return (
        f"({column} IS NOT NULL AND size({column}) > 0 "
        f"AND forall({column}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
        f"AND exists({column}, x -> x <> 0))"
    )


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1. A power of two is taken out first, which rounds nothing, so that no square overflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    vectors = np.ldexp(vectors, -exponent[:, None])
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name each vector by a 128-bit hash of label and numbers."""
    for batch in batches:
        values, offsets = flat_lists(batch.column("vec"))
        values = values + 0.0  # one zero
        names = [
            xxhash.xxh3_128_digest(values[a:b].tobytes(), seed=xxhash.xxh3_64_intdigest(label))
            for a, b, label in zip(offsets, offsets[1:], batch.column("label").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.binary())], ["vec_id", "label", "vec", "cls"])


def _keys(batches: Iterator[pa.RecordBatch], passes: int, bits: int, sketched: bool) -> Iterator[pa.RecordBatch]:
    """Per pass (pass, dim, label, prefix[, cls, key, small]): ``small`` is the unit vector in 16-bit numbers.

    Vectors marked ``whole`` take part in pass 0 only, in which all of a label share one prefix.
    """
    weights = 1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        values, offsets = flat_lists(batch.column("vec"))
        dims = np.diff(offsets)
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            vectors = unit_rows(values[(offsets[rows][:, None] + np.arange(dim))].astype(np.float64))
            cls, label = (batch.column(c).take(pa.array(rows)) for c in ("cls", "label"))
            if sketched:
                small = np.rint(vectors * SCALE).astype("<i2")
                small = pa.array([r.tobytes() for r in small], pa.binary())
            whole = batch.column("whole").to_numpy(zero_copy_only=False).astype(bool)[rows]
            for p in range(passes + 1):
                own = whole if p == 0 else ~whole
                if not own.any():
                    continue
                key = (vectors[own] @ _planes(p, KEY_BITS, dim) > 0) @ weights
                prefix = key >> (KEY_BITS - bits) if p else np.zeros(len(key), np.int64)
                n, mask = len(key), pa.array(own)
                head = [pa.array(np.full(n, p, np.int32)), pa.array(np.full(n, dim, np.int32)), label.filter(mask), pa.array(prefix)]
                rest = [cls.filter(mask), pa.array(key), small.filter(mask)] if sketched else []
                yield pa.RecordBatch.from_arrays([*head, *rest], [*HEAD, "cls", "key", "small"][: 4 + len(rest)])


def _whole_labels(classes: DataFrame, passes: int, bits: int) -> DataFrame:
    """(cls, label, vec, whole): labels are marked in which the windows of all passes would hold more pairs than there are.

    Small labels and dense ones are compared whole, once. A few passes tell; the mark steers the work, not the result.
    """
    rows = classes.select("cls", "label", "vec").withColumn("whole", F.lit(False))
    probed = rows.mapInArrow(partial(_keys, passes=PROBES, bits=bits, sketched=False), "pass int, dim int, label string, prefix bigint")
    sizes = probed.groupBy(*HEAD).agg(F.count(F.lit(1)).alias("n")).groupBy("dim", "label").agg(
        (F.sum("n") / PROBES).alias("n"), (F.sum(F.col("n") * (F.col("n") / 2 + WINDOW)) * passes / PROBES).alias("met")
    )
    marked, n = materialize(sizes.where("met >= n * (n - 1) / 2").select(F.col("dim").alias("d"), F.col("label").alias("l")), "whole-labels")
    match = (F.size("vec") == marked["d"]) & (F.col("label") == marked["l"])
    joined = rows.drop("whole").join(broadcast_if_small(marked, n), match, "left")
    return joined.select("cls", "label", "vec", F.col("d").isNotNull().alias("whole"))


def _sorted_passes(classes: DataFrame, passes: int, bits: int) -> DataFrame:
    """All passes in order of their keys. Prefixes held by many are dealt into parts; ``one``, ``two`` name the parts that meet, ``side`` the row's own."""
    kinds = "pass int, dim int, label string, prefix bigint"
    rows = _whole_labels(classes, passes, bits)
    # The planes are the same in both scans, so the counted prefixes are the ones dealt.
    counted = rows.mapInArrow(partial(_keys, passes=passes, bits=bits, sketched=False), kinds)
    large, n = materialize(
        counted.groupBy(*HEAD).agg(F.count(F.lit(1)).alias("n")).where(f"n > {PART}").select(
            *HEAD, F.expr(f"cast(ceil(n / {PART}) AS int)").alias("parts")), "large"
    )
    keys = rows.mapInArrow(partial(_keys, passes=passes, bits=bits, sketched=True), f"{kinds}, cls binary, key bigint, small binary")
    rest = ["cls", "key", "small"]
    if not n:
        met = keys.selectExpr(*HEAD, "0 AS one", "0 AS two", "0 AS side", *rest)
    else:
        dealt = keys.join(broadcast_if_small(large, n), HEAD, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        dealt = dealt.withColumn("part", F.expr("cast(pmod(xxhash64(cls), parts) AS int)"))
        met = dealt.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        met = met.selectExpr(*HEAD, "least(part, other) AS one", "greatest(part, other) AS two", "cast(part > other AS int) AS side", *rest)
    # Ranges of prefixes, so that a prefix is never cut by a border of partitions, and key order inside.
    return met.repartitionByRange(*TILE).sortWithinPartitions(*TILE, "key")


def _near(batches: Iterator[pa.RecordBatch], threshold: float, window: int) -> Iterator[pa.RecordBatch]:
    """Verified pairs of each window, as few as join all rows that they link. An unfinished prefix, and a window before it, is held back."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.concat_tables([pa.Table.from_batches([b]) for b in (held, batch) if b is not None]).combine_chunks().to_batches()[0]
        begins = _begins(rows, TILE)
        cut = int(begins[-1])
        if cut:
            yield _joined(rows.slice(0, cut), threshold, window)
        held = rows.slice(max(cut - window, 0))
    if held is not None:
        yield _joined(held, threshold, window)


def _begins(rows: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """First row of each run of equal values."""
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for c in columns:
        x = rows.column(c)
        x = x.dictionary_encode().indices.to_numpy() if pa.types.is_string(x.type) else x.to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def window_ends(rows: pa.RecordBatch, window: int) -> np.ndarray:
    """Per row the end of its window: at least ``window`` rows on in its label and pass, and as far as its prefix is shared."""
    n = rows.num_rows

    def ends(columns: list[str]) -> np.ndarray:
        begins = _begins(rows, columns)
        return np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n)))

    # Parts of a divided prefix meet only as dealt.
    whole = rows.column("two").to_numpy() == 0
    beyond = np.minimum(ends([*HEAD[:3], "one", "two"]), np.arange(n) + window + 1)
    return np.where(whole, np.maximum(ends(TILE), beyond), ends(TILE))


def _joined(rows: pa.RecordBatch, threshold: float, window: int) -> pa.RecordBatch:
    n = rows.num_rows
    end = window_ends(rows, window)
    side, two = rows.column("side").to_numpy(), rows.column("one").to_numpy() != rows.column("two").to_numpy()
    dims = rows.column("dim").to_numpy()
    root = np.arange(n)
    left, right = [], []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    place = np.empty(n, np.int64)
    for dim in np.unique(dims).tolist():
        own = np.flatnonzero(dims == dim)
        place[own] = np.arange(len(own))
        raw = b"".join(rows.column("small").take(pa.array(own)).to_pylist())
        units = np.frombuffer(raw, "<i2").reshape(len(own), dim).astype(np.float32) / np.float32(SCALE)
        least = threshold - slack(dim)
        of, d = own, 0
        while len(of):
            d += 1
            of = of[of + d < end[of]]
            open_ = of[(root[of] != root[of + d]) & ~(two[of] & (side[of] == side[of + d]))]
            joined = False
            for a in range(0, len(open_), 65_536):
                part = open_[a : a + 65_536]
                near = np.einsum("ij,ij->i", units[place[part]], units[place[part + d]]) >= least
                for i in part[near].tolist():
                    x, y = find(i), find(i + d)
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        left.append(i)
                        right.append(i + d)
                        joined = True
            while joined:
                top = root[root]
                joined = bool((top != root).any())
                root = top
    cls = rows.column("cls")
    return pa.RecordBatch.from_arrays([cls.take(pa.array(x, pa.int64())) for x in (left, right)], ["a", "b"])


def _count(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Of two blocks of a component: rows linked to each class (cls, links), and as few links (cls, other) as join all linked ones."""
    for batch in batches:
        same = batch.column("same").to_pylist()
        names, counts, ends = [], [], []
        for i, equal in enumerate(same):
            sides = []
            for side in ("one", "two"):
                members = batch.column(side)[i].values
                vectors = members.field("vec")
                flat, offsets = flat_lists(vectors)
                unit = unit_rows(flat.reshape(len(vectors), -1).astype(np.float64))
                sides.append((members.field("cls").to_pylist(), members.field("n").to_numpy(), unit))
            near = sides[0][2] @ sides[1][2].T >= threshold
            if equal:
                np.fill_diagonal(near, False)
            names += sides[0][0]
            counts += (near @ sides[1][1]).tolist()
            if not equal:
                names += sides[1][0]
                counts += (near.T @ sides[0][1]).tolist()
            ends += _spanning(near, sides[0][0], sides[1][0])
        a, b = ([e[k] for e in ends] for k in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names + a, pa.binary()), pa.array(counts + [None] * len(a), pa.int64()), pa.array([None] * len(names) + b, pa.binary())],
            ["cls", "links", "other"],
        )


def _spanning(near: np.ndarray, left: list[bytes], right: list[bytes]) -> list[tuple[bytes, bytes]]:
    """Links that join all rows of ``near`` that are linked, found from row to row."""
    out = []
    new_row, new_column = np.ones(near.shape[0], bool), np.ones(near.shape[1], bool)
    for start in np.flatnonzero(near.any(axis=1)):
        todo = [int(start)] if new_row[start] else []
        new_row[start] = False
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(near[i] & new_column):
                new_column[j] = False
                out.append((left[i], right[j]))
                for k in np.flatnonzero(near[:, j] & new_row):
                    new_row[k] = False
                    out.append((left[k], right[j]))
                    todo.append(int(k))
    return out


def near_vectors(
    df: DataFrame, threshold: float = 0.98, window: int = WINDOW,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Per row vec_id, n_links, component_id and kept."""
    named = df.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("vec")
    )
    ok = f"label IS NOT NULL AND {vector_ok('vec')}"
    kind = dict(named.dtypes)["vec_id"]
    rows, _ = materialize(
        named.where(ok).mapInArrow(_classed, f"vec_id {kind}, label string, vec array<double>, cls binary"), "vectors"
    )
    classes, n = materialize(
        rows.groupBy("cls").agg(
            F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("smallest"), F.min("label").alias("label"), F.first("vec").alias("vec")
        ),
        "classes",
    )
    ordered = _sorted_passes(classes, passes_for(n, threshold, window), prefix_bits(n, window))
    met = ordered.mapInArrow(partial(_near, threshold=threshold, window=window), "a binary, b binary")
    links, counts = _links(classes, components(met), threshold)
    label = components(links)
    known = (
        classes.select("cls", "n", "smallest")
        .join(counts, "cls", "left").join(label.withColumnRenamed("id", "cls"), "cls", "left")
        .withColumn("component", F.coalesce("component", "cls"))
    )
    known, _ = materialize(known, "known")
    least = known.groupBy("component").agg(F.min("smallest").alias("component_id"))
    known = known.join(least, "component").select(
        "cls", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    found = rows.select("vec_id", "cls").join(known, "cls").select("vec_id", "n_links", "component_id")
    alone = named.where(f"NOT coalesce({ok}, false)").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, family: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(a, b): links that join all linked classes of each component; (cls, links): rows of other classes linked directly."""
    member = classes.join(family.withColumnRenamed("id", "cls"), "cls")
    size = family.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    dealt = member.join(size, "component").withColumn("block", F.expr(f"pmod(xxhash64(cls), ceil(size / {BLOCK}))"))
    blocks, _ = materialize(
        dealt.groupBy("component", "block").agg(F.collect_list(F.struct("cls", "n", "vec")).alias("side"), F.first("size").alias("size")),
        "blocks",
    )
    # The blocks of a component meet in stripes, a key of their own.
    stripes = f"cast(ceil(size / {BLOCK * STRIPE}) AS int)"
    one, two = (
        blocks.select("component", "size", F.col("block").alias(f"b{i}"), F.col("side").alias(s)) for i, s in ((1, "one"), (2, "two"))
    )
    one = one.withColumn("stripe", F.expr(f"cast(pmod(xxhash64(b1), {stripes}) AS int)")).drop("size")
    two = two.withColumn("stripe", F.explode(F.expr(f"sequence(0, {stripes} - 1)"))).drop("size")
    both = one.join(two, ["component", "stripe"]).where("b1 <= b2").select((F.col("b1") == F.col("b2")).alias("same"), "one", "two")
    found, _ = materialize(both.mapInArrow(partial(_count, threshold=threshold), "cls binary, links bigint, other binary"), "links")
    links = found.where("other IS NOT NULL").select(F.col("cls").alias("a"), F.col("other").alias("b"))
    return links, found.where("other IS NULL").groupBy("cls").agg(F.sum("links").alias("links"))
