"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A document of more than ``capacity`` ids is cut into full sequences and a rest. A piece of length r
belongs to the reciprocal class k with capacity/(k+1) < r <= capacity/k, and every sequence of
class k holds exactly k pieces. Classes are all k up to ``DENSE`` and then its doublings. A rest that would leave more than
1/64 of its slot empty is cut at the largest slot that it fills, and what is left is classed again, so slots are
all but full and only a few pieces come from one document.

Workers need nothing from each other: each numbers the pieces of its classes, and one small table
of counts per (task, class) turns these numbers into places, so the number of unfilled sequences does not grow
with the workers. The fewer than k pieces left at the end of each class (a few thousand at most, whatever the input)
are laid end to end and cut at the capacity, so only the very last sequence is padded by more
than its slots' slack.

A null text is empty and holds the end id alone; repeated rows are repeated documents; an empty table
gives no pieces; ties do not arise, pieces go by their numbers; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_if_small, slices
from riskloom.llm.tokens import id_bytes, with_end, word_bpe
from riskloom.session import materialize

CAPACITY = 2048
DENSE = 64
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, k int, part int, nth bigint, ids binary"
PACKED = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def classes(capacity: int) -> tuple[int, ...]:
    """Pieces per sequence: 1 to DENSE, then doublings while a slot holds an id."""
    out = [k for k in range(1, DENSE + 1) if k <= capacity]
    while out[-1] * 2 <= capacity:
        out.append(out[-1] * 2)
    return tuple(out)


def cuts(capacity: int) -> list[list[tuple[int, int]]]:
    """For every rest below the capacity its pieces, as (class, length)."""
    slots = [(k, capacity // k) for k in classes(capacity)]
    plan: list[list[tuple[int, int]]] = [[]]
    for r in range(1, capacity + 1):
        k, slot = next(x for x in reversed(slots) if x[1] >= r)
        if slot - r <= r // 64 or slots[-1][1] >= r:
            plan.append([(k, r)])
        else:
            k, slot = next(x for x in slots if x[1] <= r)
            plan.append([(k, slot), *plan[r - slot]])
    return plan


def _cut(batches: Iterator[pa.RecordBatch], path: str, end: int, capacity: int) -> Iterator[pa.RecordBatch]:
    tok, plan, part = word_bpe(path), cuts(capacity), TaskContext.get().partitionId()
    width = id_bytes(tok.vocabulary())
    counts: dict[int, int] = defaultdict(int)
    for batch in batches:
        for rows in slices(batch, "text", 3 << 20):
            ids, offsets = with_end(*tok.encode(rows.column("text")), end)
            owner, start, length, kind, nth = [], [], [], [], []
            for i, n in enumerate(np.diff(offsets).tolist()):
                at = 0
                for k, size in [(1, capacity)] * (n // capacity) + plan[n % capacity]:
                    owner.append(i)
                    start.append(at)
                    length.append(size)
                    kind.append(k)
                    nth.append(counts[k])
                    counts[k] += 1
                    at += size
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id").take(pa.array(owner, pa.int32())),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(np.diff(offsets)[owner], pa.int64()),
                    pa.array(kind, pa.int32()),
                    pa.array([part] * len(owner), pa.int32()),
                    pa.array(nth, pa.int64()),
                    binary(ids.astype(f"<u{width}"), np.concatenate([[0], np.cumsum(length, dtype=np.int64)])),
                ],
                ["doc_id", "start", "length", "doc_tokens", "k", "part", "nth", "ids"],
            )


def pack(
    df: DataFrame, path: str, end: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` is binary: unsigned little-endian numbers of 2 bytes if they hold the vocabulary, else 4 (``unpack_ids``).
    ``path``: a ``tokenizers`` file found on every executor.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    pieces, _ = materialize(rows.mapInArrow(partial(_cut, path=path, end=end, capacity=capacity), PIECES), "pieces")
    per_task = pieces.groupBy("part", "k").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places, n = materialize(
        per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "places"
    )
    # One number per class, so at most some seventy rows.
    totals = {r["k"]: r["n"] for r in places.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    base, first = 0, {}
    for k in sorted(totals):
        first[k] = base
        base += totals[k] // k
    table = [(k, totals[k] // k * k, first[k]) for k in sorted(totals)]
    known = F.broadcast(df.sparkSession.createDataFrame(table, "k int, whole bigint, first bigint"))
    placed = (
        pieces.join(broadcast_if_small(places.select("part", "k", "before"), n), ["part", "k"])
        .join(known, "k")
        .withColumn("g", F.col("nth") + F.col("before"))
    )
    full = placed.where("g < whole").withColumns({"sequence_id": F.expr("first + g div k"), "slot": F.expr("g % k")})
    filled = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("offset", F.coalesce(F.sum("length").over(filled), F.lit(0)))
    width = id_bytes(word_bpe(path).vocabulary())
    return full.select(PACKED).unionByName(_leftovers(placed.where("g >= whole"), base, capacity, width))


def _leftovers(rest: DataFrame, base: int, capacity: int, width: int) -> DataFrame:
    """Fewer than k pieces of each class k, end to end. Their number is bounded by the classes alone."""
    line = Window.orderBy("k", "g").rowsBetween(Window.unboundedPreceding, -1)
    laid = rest.withColumn("at", F.coalesce(F.sum("length").over(line), F.lit(0)))
    laid = laid.withColumn("s", F.explode(F.expr(f"sequence(at div {capacity}, (at + length - 1) div {capacity})")))
    laid = laid.withColumns(
        {"a": F.expr(f"greatest(at, s * {capacity})"), "b": F.expr(f"least(at + length, (s + 1) * {capacity})")}
    )
    return laid.select(
        "doc_id",
        (F.col("start") + F.col("a") - F.col("at")).alias("start"),
        (F.col("b") - F.col("a")).alias("length"),
        "doc_tokens",
        (F.col("s") + base).alias("sequence_id"),
        F.expr(f"a - s * {capacity}").alias("offset"),
        F.expr(f"substring(ids, cast((a - at) * {width} + 1 AS int), cast((b - a) * {width} AS int))").alias("ids"),
    )


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.BinaryArray:
    """Each part of a flat array as bytes; the parts follow one another."""
    places = (offsets * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(values))])


def unpack_ids(data: bytes, length: int) -> np.ndarray:
    """The ids of a piece of ``length`` ids."""
    return np.frombuffer(data, f"<u{len(data) // max(length, 1) or 2}").astype("<u4")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pieces = zip(batch.column("ids"), batch.column("length").to_pylist())
        crc = [zlib.crc32(unpack_ids(x.as_buffer(), n)) for x, n in pieces]
        keep = [batch.column(c) for c in PACKED[:-1]]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(crc, pa.int64())], [*PACKED[:-1], "ids_crc32"])


def with_checksums(packed: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    kinds = ", ".join(f"{c} bigint" for c in PACKED[:-1])
    return packed.select(PACKED).mapInArrow(_digests, f"{kinds}, ids_crc32 bigint")
