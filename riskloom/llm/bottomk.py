"""Near duplicates by bottom-k sketches from one hash function.

Every text becomes the set of its word shingles, each a 64-bit hash. The sketch keeps the ``SKETCH``
smallest hashes (the whole set, if it is smaller). Texts with equal sets are one class from the start; the rest
works on classes, so copies are never compared.

Inverted lists of the retained hashes give the candidates. Two sets as alike as the
threshold asks share at least ``needed`` retained hashes, so it is enough to list a class under the
rarest SKETCH - needed + 1 of its hashes (rarest first by the number of classes that retain them). For sets
that fit into their sketch this is certain; for larger ones ``needed`` is set so that a linked
pair falls short with a probability below 1e-8. The union of two sketches estimates their similarity
and filters by the same bound; exact similarity on the full sets decides every link.

A list is cut by set size first, since sizes limit similarity. A list is never spread into all its pairs.
First each class of a list is compared with the list's first class only; classes that the estimate holds together
are a family. Lists that hold several families are compared block by block inside tasks, which report only pairs that join two
families. Then every pair of classes that share a list and pass the estimate is inside one family, and each family
is compared once, on full sets, again block by block and without pairs of one component (after each class has been verified
against its best partner). Tasks report links that join two components, no others. So nothing is capped and no pair goes unseen.

Null, empty and white-space texts have the empty set and link with nothing. Rows with the same id are separate
rows; a component is named after the smallest id in it, so ties do not arise. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_if_small, flat_lists, forget, release, slices
from riskloom.llm.graph import components
from riskloom.llm.words import mix, shingle_sets
from riskloom.session import materialize

SKETCH = 64
LOST = 1e-8
BLOCK = 64
STRIPE = 16
# The upper halves of the retained hashes, enough to estimate from.
SHORT = "transform(sketch, x -> cast(shiftright(x, 32) AS int))"


def needed_overlap(size: int, percent: int) -> int:
    """Fewest shared retained hashes that a linked pair has, but for a probability below LOST.

    Each of the ``size`` smallest hashes of the union is a shared one with the pair's similarity.
    """
    p = percent / 100
    if percent >= 100:
        return size
    below, t = (1 - p) ** size, 0
    while below < LOST and t < size:
        t += 1
        below += math.comb(size, t) * p**t * (1 - p) ** (size - t)
    return max(1, t)


def _sketch(batches: Iterator[pa.RecordBatch], words: int, sketch: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text"):
            sets, offsets = shingle_sets(rows.column("text"), words)
            n = np.diff(offsets)
            a, b = mix(sets + np.uint64(1)), mix(sets ^ np.uint64(0x5851F42D4C957F2D))
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)]) for x in (a, b)]
            key = np.stack([s[offsets[1:]] - s[offsets[:-1]] for s in sums], axis=1).astype(">u8")
            take = np.minimum(n, sketch)
            ends = np.cumsum(take)
            index = np.repeat(offsets[:-1] - (ends - take), take) + np.arange(ends[-1] if len(ends) else 0)
            kept = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(sets[index].view(np.int64))
            )
            names = [r.tobytes() if m else None for r, m in zip(key, n)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("text_hash"), pa.array(n), pa.array(names, pa.binary()), kept],
                ["doc_id", "text_hash", "n_shingles", "cls", "sketch"],
            )


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Full sets by class; a class met again in the same task is left out."""
    seen: set[int] = set()
    for batch in batches:
        for rows in slices(batch, "text"):
            fresh = [not (i in seen or seen.add(i)) for i in rows.column("id").to_pylist()]
            rows = rows.filter(pa.array(fresh, pa.bool_()))
            sets, offsets = shingle_sets(rows.column("text"), words)
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([rows.column("id"), lists], ["id", "full"])


def _score(a: np.ndarray, b: np.ndarray, na: int, nb: int, percent: int, sketch: int, least: int) -> int:
    """1 + estimated similarity in thousandths from two sketches, 0 where a link is out of the question."""
    both = np.concatenate([a, b])
    both.sort()
    same = both[1:] == both[:-1]
    common = int(same.sum())
    if max(na, nb) <= sketch:  # both sets are whole
        union = len(both) - common
        return 1 + 1000 * common // union if 100 * common >= percent * union else 0
    rank = np.cumsum(np.concatenate([[True], ~same]))  # place among the distinct hashes of the union
    common = int((same & (rank[1:] <= sketch)).sum())
    return 1 + 1000 * common // sketch if common >= least else 0


def _filter(batches: Iterator[pa.RecordBatch], percent: int, sketch: int) -> Iterator[pa.RecordBatch]:
    least = needed_overlap(sketch, percent)
    for batch in batches:
        (sa, oa), (sb, ob) = flat_lists(batch.column("sa")), flat_lists(batch.column("sb"))
        sa, sb = sa.view(np.uint32), sb.view(np.uint32)
        na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        score = np.zeros(batch.num_rows, np.int32)
        for i in range(batch.num_rows):
            score[i] = _score(sa[oa[i] : oa[i + 1]], sb[ob[i] : ob[i + 1]], na[i], nb[i], percent, sketch, least)
        keep = pa.array(score > 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(score)], ["a", "b", "score"]
        ).filter(keep)


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        (sa, oa), (sb, ob) = flat_lists(batch.column("sa")), flat_lists(batch.column("sb"))
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a, b = sa[oa[i] : oa[i + 1]], sb[ob[i] : ob[i + 1]]
            both = np.concatenate([a, b])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep[i] = 100 * common >= percent * (len(both) - common)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))


def _side(members: pa.StructArray) -> tuple[np.ndarray, ...]:
    """id, set size, group, flat hashes, offsets of a block's members."""
    flat, offsets = flat_lists(members.field("hashes"))
    return (*(members.field(c).to_numpy() for c in ("id", "n", "component")), flat, offsets)


def _shared(sa: np.ndarray, oa: np.ndarray, sb: np.ndarray, ob: np.ndarray) -> np.ndarray:
    """Common hashes of any two sets of two blocks: a product of 0/1 marks of those that occur more than once."""
    values, counts = np.unique(np.concatenate([sa, sb]), return_counts=True)
    values = values[counts > 1]
    marks = []
    for s, o in ((sa, oa), (sb, ob)):
        at = np.minimum(np.searchsorted(values, s), max(len(values) - 1, 0))
        known = values[at] == s if len(values) else np.zeros(len(s), bool)
        m = np.zeros((len(o) - 1, len(values)), np.float32)
        m[np.repeat(np.arange(len(o) - 1), np.diff(o))[known], at[known]] = 1
        marks.append(m)
    return marks[0] @ marks[1].T


def _block_links(batches: Iterator[pa.RecordBatch], percent: int, sketch: int | None) -> Iterator[pa.RecordBatch]:
    """Pairs that join different components of two blocks (left, right), as few as do.

    With ``sketch`` the hashes are sketches and a pair is one that the estimate lets through; without, they are
    the full sets and a pair is a link.
    """
    least = needed_overlap(sketch, percent) if sketch else 0
    for batch in batches:
        out = []
        for row in range(batch.num_rows):
            (ia, na, ca, sa, oa), (ib, nb, cb, sb, ob) = (_side(batch.column(s)[row].values) for s in ("left", "right"))
            if sketch:
                sa, sb = sa.view(np.uint32), sb.view(np.uint32)
            shared = _shared(sa, oa, sb, ob)
            total = np.add.outer(na, nb)
            if sketch:
                high = np.maximum.outer(na, nb)
                floor = np.where(high <= sketch, -(-percent * (total - shared) // 100), np.minimum(least, -(-high * percent // 100)))
                near = (shared >= floor) & (100 * np.minimum.outer(na, nb) >= percent * high)
            else:
                near = 100 * shared >= percent * (total - shared)
            near &= ca[:, None] != cb
            root: dict[int, int] = {}

            def find(x: int) -> int:
                while root.get(x, x) != x:
                    x = root[x]
                return x

            for i, j in np.argwhere(near):
                x, y = find(int(ca[i])), find(int(cb[j]))
                if x == y:
                    continue
                if sketch and not _score(sa[oa[i] : oa[i + 1]], sb[ob[j] : ob[j + 1]], na[i], nb[j], percent, sketch, least):
                    continue
                root[max(x, y)] = min(x, y)
                out.append(sorted((int(ia[i]), int(ib[j]))))
        columns = list(zip(*out)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


class NearDuplicates:
    """The classes of a table and their links; ``rows()`` gives every row its component."""

    def __init__(self, df: DataFrame, words: int, percent: int, sketch: int = SKETCH):
        self.words, self.percent, self.sketch = words, percent, sketch
        self.docs = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
        self.sketches, _ = materialize(
            self.docs.mapInArrow(
                partial(_sketch, words=words, sketch=sketch),
                "doc_id bigint, text_hash bigint, n_shingles bigint, cls binary, sketch array<bigint>",
            ),
            "sketches",
        )

    def _classes(self) -> DataFrame:
        """One numbered row per distinct set, with one text to read it from."""
        rows = self.sketches.where("cls IS NOT NULL")
        one = F.min(F.struct("doc_id", "text_hash", "n_shingles", "sketch")).alias("one")
        picked = rows.groupBy("cls").agg(one)
        return picked.selectExpr(
            "monotonically_increasing_id() AS id", "cls", "one.doc_id AS doc_id", "one.text_hash AS text_hash",
            "cast(one.n_shingles AS int) AS n", "one.sketch AS sketch",
        )

    def _least(self) -> str:
        """SQL: the fewest retained hashes that a set of n shares with a linked partner."""
        exact = f"cast(ceil(n * {self.percent} / 100.0) AS int)"
        return (
            f"CASE WHEN n * 100 <= {self.sketch * self.percent} THEN {exact} "
            f"ELSE least({exact}, {needed_overlap(self.sketch, self.percent)}) END"
        )

    def _lists(self, classes: DataFrame) -> DataFrame:
        """(value, size, id, n): each class under the rarest of its retained hashes; lists of one are left out.

        A class that shares too few of its hashes with any others cannot have a partner. A list is cut by size: a class goes
        into its own step of sizes and the one above, so that any two classes whose sizes allow a link share a step.
        """
        held = classes.select("id", F.explode("sketch").alias("value"))
        # Stored, so that the join has plain exchanges on both sides and a hot hash is split as skewed.
        shared, _ = materialize(held.groupBy("value").agg(F.count(F.lit(1)).cast("int").alias("df")).where("df > 1"), "shared")
        release(classes.sparkSession)
        mine = held.join(shared, "value").groupBy("id").agg(
            F.array_sort(F.collect_list(F.struct("df", "value"))).alias("rare")
        )
        # Hashes that no other class retains would come first; what remains of the prefix is taken from the shared ones.
        mine = mine.join(classes.select("id", "n", F.expr(self._least()).alias("least")), "id").where("size(rare) >= least")
        mine = mine.withColumn("first", F.expr("size(rare) - least + 1"))
        # A step is a little wider than the largest ratio of linked sizes.
        step = F.expr(f"cast(floor(ln(n) / {math.log(100 / self.percent + 1e-9)!r}) AS int)")
        rows = mine.select("id", "n", F.explode(F.expr("slice(rare, 1, first)")).alias("r"), step.alias("step"))
        rows = rows.select(
            F.col("r.value").alias("value"), F.explode(F.array("step", F.col("step") + 1)).alias("size"), "id", "n"
        )
        rows, _ = materialize(rows, "postings")
        forget(shared)
        release(classes.sparkSession)
        many, _ = materialize(
            rows.groupBy("value", "size").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("value", "size"), "many"
        )
        return rows.join(many, ["value", "size"])

    def _candidates(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs (a, b, na, nb) that the estimate lets through, with a score."""
        a = classes.select(F.col("id").alias("a"), F.expr(SHORT).alias("sa"))
        b = classes.select(F.col("id").alias("b"), F.expr(SHORT).alias("sb"))
        wide = pairs.join(b, "b").join(a, "a").select("a", "b", "na", "nb", "sa", "sb")
        return wide.mapInArrow(
            partial(_filter, percent=self.percent, sketch=self.sketch), "a bigint, b bigint, score int"
        )

    def _full(self, ends: DataFrame, classes: DataFrame) -> DataFrame:
        """(id, full): the sets of some classes, from their texts."""
        wanted, n = materialize(ends.join(classes.select("id", "doc_id", "text_hash"), "id"), "wanted")
        match = self.docs.doc_id.eqNullSafe(wanted.doc_id) & self.docs.text_hash.eqNullSafe(wanted.text_hash)
        texts = self.docs.join(broadcast_if_small(wanted, n), match).select("id", "text")
        full, m = materialize(texts.mapInArrow(partial(_sets, words=self.words), "id bigint, full array<bigint>"), "sets")
        forget(wanted)
        if m > n:  # rows that repeat id and text
            every = full
            full, _ = materialize(every.dropDuplicates(["id"]), "sets")
            forget(every)
        return full

    def _verified(self, pairs: DataFrame, full: DataFrame) -> DataFrame:
        """The pairs whose full sets are alike enough."""
        a = full.select(F.col("id").alias("a"), F.col("full").alias("sa"))
        b = full.select(F.col("id").alias("b"), F.col("full").alias("sb"))
        found = pairs.select("a", "b").join(b, "b").join(a, "a").mapInArrow(
            partial(_verify, percent=self.percent), "a bigint, b bigint"
        )
        return materialize(found, "links")[0]

    def _close(self, n: str, m: str) -> str:
        return f"100 * least({n}, {m}) >= {self.percent} * greatest({n}, {m})"

    def _star(self, lists: DataFrame) -> DataFrame:
        """Distinct pairs (a, b, na, nb) of a list's first class with each of its others."""
        head = lists.groupBy("value", "size").agg(F.min("id").alias("a"))
        named = lists.join(head, ["value", "size"]).where("id = a").select("value", "size", "a", F.col("n").alias("na"))
        pairs = lists.join(named, ["value", "size"]).select("a", F.col("id").alias("b"), "na", F.col("n").alias("nb"))
        return pairs.where("a < b").where(self._close("na", "nb")).distinct()

    def components(self, classes: DataFrame) -> DataFrame:
        """(id, component) of every class with a link."""
        spark = classes.sparkSession
        listed = self._lists(classes)
        lists, n = materialize(listed, "lists")
        forget(listed)
        release(spark)
        if not n:
            return spark.createDataFrame([], "id bigint, component bigint")
        found, _ = materialize(self._candidates(self._star(lists), classes), "candidates")
        release(spark)
        family = components(found)
        pairs = self._across(lists, family, classes)
        across, n = materialize(pairs, "across")
        forget(pairs, classes)
        forget(lists)
        if n:
            family = components(found.select("a", "b").unionByName(across))
        release(spark)
        full = self._full(family.select("id"), classes)
        # One verification joins most copies to their family: each class with its best partner.
        links = self._verified(_best(found), full)
        forget(found)
        pairs = self._inside(family, components(links), full)
        inside, n = materialize(pairs, "inside")
        forget(pairs)
        forget(full)
        release(spark)
        return components(links.unionByName(inside))

    def _across(self, lists: DataFrame, family: DataFrame, classes: DataFrame) -> DataFrame:
        """Pairs that the estimate lets through and that join families, for lists that hold several.

        Of lists with the same members, told by 128 bits over their ids, one is compared.
        """
        named = lists.join(family, "id", "left").select("value", "size", "id", F.coalesce("component", "id").alias("component"))
        mixed = named.groupBy("value", "size").agg(
            F.count(F.lit(1)).alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi"),
            F.bit_xor(F.xxhash64("id")).alias("m1"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("m2"),
        ).where("c > 2 AND lo <> hi")
        mixed = mixed.groupBy("c", "m1", "m2").agg(F.min(F.struct("value", "size")).alias("one")).select("one.*", "c")
        rows, _ = materialize(named.join(mixed, ["value", "size"]), "mixed")
        sets = classes.select("id", "n", F.expr(SHORT).alias("hashes"))
        found = _block_pairs(rows, sets, ["value", "size"]).mapInArrow(
            partial(_block_links, percent=self.percent, sketch=self.sketch), "a bigint, b bigint"
        )
        return found.distinct()

    def _inside(self, family: DataFrame, label: DataFrame, full: DataFrame) -> DataFrame:
        """Links that join different components of one family, by the full sets."""
        named = family.withColumnRenamed("component", "family").join(label, "id", "left")
        named = named.withColumn("component", F.coalesce("component", "id"))
        mixed = named.groupBy("family").agg(
            F.count(F.lit(1)).alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi")
        ).where("lo <> hi").select("family", "c")
        sets = full.select("id", F.size("full").alias("n"), F.col("full").alias("hashes"))
        return _block_pairs(named.join(mixed, "family"), sets, ["family"]).mapInArrow(
            partial(_block_links, percent=self.percent, sketch=None), "a bigint, b bigint"
        )

    def rows(self) -> DataFrame:
        """Every row's doc_id, text_hash, n_shingles, component_id, kept and chosen.

        ``component_id`` is the smallest id of the component, null if it has none; rows without shingles are their own.
        ``chosen`` holds for one (doc_id, text_hash) of each component, the smallest with null ids last, in all rows that repeat it.
        """
        classes, _ = materialize(self._classes(), "classes")
        narrow, _ = materialize(self.sketches.select("doc_id", "text_hash", "n_shingles", "cls"), "rows")
        forget(self.sketches)
        release(classes.sparkSession)
        label = self.components(classes)
        named = classes.select("id", "cls").join(label, "id", "left").select("cls", F.coalesce("component", "id").alias("component"))
        joined = narrow.join(named, "cls", "left")
        named, _ = materialize(joined, "named")
        forget(joined)
        place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
        first = named.where("component IS NOT NULL").groupBy("component").agg(F.min(place).alias("first"))
        out = named.join(first, "component", "left")
        name = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
        chosen = F.col("cls").isNull() | place.eqNullSafe(F.col("first"))
        return out.select("doc_id", "text_hash", "n_shingles", name.alias("component_id"), chosen.alias("chosen")).select(
            "doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "chosen"
        )


def _best(pairs: DataFrame) -> DataFrame:
    """Of each class's pairs (as b) the one with the highest score."""
    top = pairs.groupBy("b").agg(F.max("score").alias("score"))
    return pairs.join(top, ["b", "score"]).groupBy("b").agg(F.min("a").alias("a")).select("a", "b")


def _block_pairs(rows: DataFrame, sets: DataFrame, keys: list[str]) -> DataFrame:
    """(left, right): all pairs of blocks of each group, so that every two members of different components meet once.

    ``rows``: keys, c (rows of the group), id, component. ``sets``: id, n, hashes; they join once the rows have their
    blocks. A group of up to BLOCK rows is one block. In a larger one a
    component of BLOCK rows or more has blocks of its own and the smaller ones share blocks; numbers are dealt by hash, so
    no task sees a whole group. Blocks of one component only are not paired. The blocks of a group meet in stripes
    of STRIPE left blocks each, a key of their own.
    """
    side = F.collect_list(F.struct("id", "n", "component", "hashes"))
    one = rows.where(f"c <= {BLOCK}").join(sets, "id").groupBy(*keys).agg(side.alias("left")).select("left", F.col("left").alias("right"))
    large = rows.where(f"c > {BLOCK}")
    held = large.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("held"))
    small = held.where(f"held < {BLOCK}").groupBy(*keys).agg(F.sum("held").alias("small"))
    sized = large.join(held, [*keys, "component"]).join(small, keys, "left")
    own = F.expr(f"struct(component AS of, pmod(xxhash64(id), ceil(held / {BLOCK})) AS nth)")
    shared = F.expr(f"struct(cast(-1 AS bigint) AS of, pmod(xxhash64(component), ceil(small / {BLOCK})) AS nth)")
    dealt = sized.withColumn("block", F.when(F.col("held") >= BLOCK, own).otherwise(shared))
    blocks, _ = materialize(
        dealt.join(sets, "id").groupBy(*keys, "block").agg(
            side.alias("side"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("c").alias("c")
        ),
        "blocks",
    )
    stripes = f"cast(ceil(c / {BLOCK * STRIPE}.0) AS int)"
    left, right = (blocks.select(*keys, "c", *[F.col(x).alias(f"{x}{i}") for x in ("block", "side", "lo", "hi")]) for i in (1, 2))
    left = left.withColumn("stripe", F.expr(f"cast(pmod(xxhash64(block1), {stripes}) AS int)")).drop("c")
    right = right.withColumn("stripe", F.explode(F.expr(f"sequence(0, {stripes} - 1)"))).drop("c")
    met = left.join(right, [*keys, "stripe"]).where("block1 <= block2 AND NOT (lo1 = hi1 AND lo2 = hi2 AND lo1 = lo2)")
    return one.unionByName(met.select(F.col("side1").alias("left"), F.col("side2").alias("right")))


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, sketch: int = SKETCH) -> DataFrame:
    """Rows (doc_id, text_hash, n_shingles, component_id, kept) of a table with ``doc_id`` and ``text``.

    Two texts link when 100 * shared shingles >= percent * shingles of both together.
    """
    return NearDuplicates(df, words, percent, sketch).rows().drop("chosen")
