"""Hierarchical residual packing of tokenised documents into few sequences of a fixed capacity.

A document of more than ``capacity`` ids is cut into full sequences and a rest. Every task packs CHUNK_IDS ids at a time by
best fit, longest rests first: a rest goes to the sequence with the least room that holds it. Sequences with at most ``spare`` ids of room are done;
the others are leaves of a tree. Ids never move: what travels is a row (leaf, ids held) per leaf.

A round deals the open sequences to nodes of about NODE_ITEMS of them, and each node packs them as items, by best fit again: their ids
stay together as they are. What a node fills is done; the members of its other sequences go up apart, to meet others. There are fewer nodes in
each round. Rounds go on until one node holds all or a round closes less than STALLED of them (then hardly any fit together); the
last round keeps what it made. So no node grows with the input.

A null text is empty and holds the end id alone; repeated rows are repeated documents; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_if_small, slices
from riskloom.llm.packing import binary, unpack_ids
from riskloom.llm.tokens import id_bytes, with_end, word_bpe
from riskloom.session import materialize

CAPACITY = 4096
SPARE = 4
CHUNK_IDS = 4 << 20
NODE_ITEMS = 4096
PART = 1024
STALLED = 0.01
PIECES = "doc_id bigint, piece int, start bigint, length bigint, doc_tokens bigint, leaf bigint, place bigint, held bigint, ids binary"
PACKED = ["doc_id", "piece", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, place in the bin) of every item and the length held by each bin; longest items first.

    Bins are kept by their room: one set bit for each room that some bin has, so the least room that holds an item is the lowest bit
    from its length on.
    """
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, held = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        above = mask >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            b, room = len(held), capacity
            held.append(0)
        bins[i], places[i] = b, held[b]
        held[b] += n
        left = room - n
        if left:
            rooms[left].append(b)
            mask |= 1 << left
    return bins, places, np.array(held, np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], tok, end: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(document ids, all token ids, offsets) of consecutive documents with about CHUNK_IDS token ids."""
    held, size = [], 0
    for batch in batches:
        for rows in slices(batch, "text", 3 << 20):
            ids, offsets = with_end(*tok.encode(rows.column("text")), end)
            held.append((rows.column("id"), ids, np.diff(offsets)))
            size += len(ids)
            if size >= CHUNK_IDS:
                yield _together(held)
                held, size = [], 0
    if held:
        yield _together(held)


def _together(held: list) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    names, ids, sizes = zip(*held)
    return pa.concat_arrays(names), np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)


def _packed(batches: Iterator[pa.RecordBatch], path: str, end: int, capacity: int) -> Iterator[pa.RecordBatch]:
    tok = word_bpe(path)
    kind = f"<u{id_bytes(tok.vocabulary())}"
    leaf = TaskContext.get().partitionId() << 32
    for names, ids, offsets in _chunks(batches, tok, end):
        sizes = np.diff(offsets)
        pieces = -(-sizes // capacity)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.minimum(sizes[owner] - piece * capacity, capacity)
        bins, places, held = best_fit(length, capacity)
        ends = np.concatenate([[0], np.cumsum(length)])
        # Parts of a chunk, so that no batch of ids is large.
        for a in range(0, len(owner), PART):
            own = slice(a, a + PART)
            columns = [
                names.take(pa.array(owner[own])), pa.array(piece[own].astype(np.int32)), pa.array(piece[own] * capacity), pa.array(length[own]),
                pa.array(sizes[owner[own]]), pa.array(leaf + bins[own]), pa.array(places[own]), pa.array(held[bins[own]]),
                binary(ids[ends[a] : ends[min(a + PART, len(owner))]].astype(kind), ends[a : a + PART + 1] - ends[a]),
            ]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in PIECES.split(", ")])
        leaf += len(held)


def _node(items: pa.Table, capacity: int, spare: int) -> pa.Table:
    """The open sequences of a node packed as items; a sequence made is named after its first member."""
    items = items.sort_by([("held", "descending"), ("leaf", "ascending")]).combine_chunks()
    leaf = items.column("leaf").to_numpy()
    bins, places, held = best_fit(items.column("held").to_numpy(), capacity)
    name = np.empty(len(held), np.int64)
    name[bins[places == 0]] = leaf[places == 0]
    return pa.table({
        "leaf": items.column("leaf"), "held": items.column("held"), "sequence_id": pa.array(name[bins]), "base": pa.array(places),
        "done": pa.array((held >= capacity - spare)[bins]),
    })


def merge_open(leaves: DataFrame, n: int, capacity: int, spare: int) -> DataFrame:
    """(leaf, sequence_id, base): where the ids of each of the ``n`` open sequences (leaf, held) go."""
    kept = ["leaf", "sequence_id", "base"]
    placed, step = None, 0
    while n:
        nodes = -(-n // NODE_ITEMS)
        packed = leaves.withColumn("node", F.expr(f"pmod(xxhash64(leaf, {step}), {nodes})")).groupBy("node").applyInArrow(
            lambda rows: _node(rows, capacity, spare), "leaf bigint, held bigint, sequence_id bigint, base bigint, done boolean"
        )
        made, _ = materialize(packed, "open-sequences")
        left = made.where("NOT done").count()
        last = nodes == 1 or left > n * (1 - STALLED)
        now = (made if last else made.where("done")).select(kept)
        placed = now if placed is None else placed.unionByName(now)
        leaves, n, step = made.where("NOT done").select("leaf", "held"), 0 if last else left, step + 1
    return placed


def pack(
    df: DataFrame, path: str, end: int = 1, capacity: int = CAPACITY, spare: int = SPARE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, doc_tokens, sequence_id, offset, ids (binary, as ``packing.unpack_ids`` reads them).

    ``path``: a ``tokenizers`` file found on every executor. Sequence numbers are distinct, not consecutive.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    pieces, _ = materialize(rows.mapInArrow(partial(_packed, path=path, end=end, capacity=capacity), PIECES), "pieces")
    full = f"held >= {capacity - spare}"
    # The piece at place 0 stands for its sequence.
    leaves, n = materialize(pieces.where(f"place = 0 AND NOT {full}").select("leaf", "held"), "leaves")
    closed = pieces.where(full).withColumns({"sequence_id": F.col("leaf"), "offset": F.col("place")})
    if not n:
        return closed.select(PACKED)
    where, n = materialize(merge_open(leaves, n, capacity, spare), "places")
    moved = pieces.where(f"NOT {full}").join(broadcast_if_small(where, n), "leaf").withColumn("offset", F.col("base") + F.col("place"))
    return closed.select(PACKED).unionByName(moved.select(PACKED))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pieces = zip(batch.column("ids"), batch.column("length").to_pylist())
        crc = [zlib.crc32(unpack_ids(x.as_buffer(), n)) for x, n in pieces]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in PACKED[:-1]), pa.array(crc, pa.int64())], [*PACKED[:-1], "ids_crc32"])


def with_checksums(packed: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids (as unsigned 32-bit numbers) in place of the ids."""
    kinds = ", ".join(f"{c} {'int' if c == 'piece' else 'bigint'}" for c in PACKED[:-1])
    return packed.select(PACKED).mapInArrow(_digests, f"{kinds}, ids_crc32 bigint")
