"""Token ids in fixed-width bits, with block offsets for vectorised and random access.

A shard holds the ids of consecutive documents, ``bits`` bits each (the fewest that hold the
vocabulary), in blocks of ``BLOCK_IDS`` ids padded to whole bytes:

    magic | blocks | block offsets u64[blocks + 1] | doc ids i64 | doc id is null u8 | doc starts u64[docs + 1]
    | footer: ids, docs, blocks, index position u64, bits, ids per block u32, magic

Documents go in ascending id order (null first, ties by text hash), dealt by range. A task writes its shards under
names of its own and reports them when they are complete; only reported shards are read, so a
retried or doubled task leaves at most unused files. Shards go to the shared folder of the session.
A null text is empty and holds the end id alone; an empty table gives no shards; repeated rows are
repeated documents; other columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import flat_lists, int32_lists, running_start, slices
from riskloom.llm.tokens import with_end, word_bpe
from riskloom.session import materialize, scratch_path

MAGIC = b"PKTOKEN1"
FOOTER = "<QQQQII8s"
BLOCK_IDS = 4096
SHARD_IDS = 1 << 25
READ_IDS = 1 << 20
READ_TASKS = 20_000
MANIFEST = "part int, number int, path string, n_ids bigint, n_docs bigint"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Highest bit first, padded to a byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit in {bits} bits")
    rows = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - bits :]
    return np.packbits(rows.ravel()).tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    rows = np.zeros((count, 32), np.uint8)
    rows[:, 32 - bits :] = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits).reshape(count, bits)
    return np.packbits(rows, axis=1).view(">u4").ravel().astype(np.uint32)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", path))


class ShardWriter:
    def __init__(self, path: str, bits: int):
        self.path, self.bits = path, bits
        store, name = _open(path)
        store.create_dir(name.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(name)
        self.out.write(MAGIC)
        self.rest = np.empty(0, np.uint32)
        self.offsets, self.doc_ids, self.starts = [0], [], [np.zeros(1, np.uint64)]
        self.n_ids = self.n_docs = 0

    def _blocks(self, ids: np.ndarray) -> None:
        for a in range(0, len(ids), BLOCK_IDS):
            data = pack(ids[a : a + BLOCK_IDS], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))

    def add(self, doc_ids: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.starts.append((self.n_ids + offsets[1:] - offsets[0]).astype(np.uint64))
        ids = ids[offsets[0] : offsets[-1]]
        self.n_ids += len(ids)
        self.n_docs += len(doc_ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK_IDS * BLOCK_IDS
        self._blocks(ids[:whole])
        self.rest = ids[whole:]

    def close(self) -> None:
        self._blocks(self.rest)
        names = pa.concat_arrays([a.cast(pa.int64()) for a in self.doc_ids])
        index = len(MAGIC) + self.offsets[-1]
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(names.fill_null(0).to_numpy().astype("<i8").tobytes())
        self.out.write(names.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
        self.out.write(np.concatenate(self.starts).astype("<u8").tobytes())
        self.out.write(struct.pack(FOOTER, self.n_ids, self.n_docs, len(self.offsets) - 1, index, self.bits, BLOCK_IDS, MAGIC))
        self.out.close()


class ShardReader:
    """Random access to one shard: ``ids(a, b)`` reads only the blocks that hold ids a to b."""

    def __init__(self, path: str):
        store, name = _open(path)
        self.file = store.open_input_file(name)
        size, foot = self.file.size(), struct.calcsize(FOOTER)
        self.n_ids, n_docs, n_blocks, index, self.bits, self.block, magic = struct.unpack(
            FOOTER, self.file.read_at(foot, size - foot)
        )
        if magic != MAGIC:
            raise ValueError(f"{path} is no packed shard")
        raw = self.file.read_at(size - foot - index, index)
        self.offsets = np.frombuffer(raw, "<u8", n_blocks + 1)
        at = 8 * (n_blocks + 1)
        values = np.frombuffer(raw, "<i8", n_docs, at)
        null = np.frombuffer(raw, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
        self.doc_ids = pa.array(values, pa.int64(), mask=null)
        self.starts = np.frombuffer(raw[at + 9 * n_docs :], "<u8", n_docs + 1).astype(np.int64)

    def ids(self, a: int, b: int) -> np.ndarray:
        if b <= a:
            return np.empty(0, np.uint32)
        first, last = a // self.block, (b - 1) // self.block
        data = self.file.read_at(int(self.offsets[last + 1] - self.offsets[first]), len(MAGIC) + int(self.offsets[first]))
        out, at = [], 0
        if self.block * self.bits % 8 == 0:  # whole blocks follow one another without padding
            out.append(unpack(data, min(self.n_ids, (last + 1) * self.block) - first * self.block, self.bits))
        else:
            for k in range(first, last + 1):
                size = int(self.offsets[k + 1] - self.offsets[k])
                out.append(unpack(data[at : at + size], min(self.block, self.n_ids - k * self.block), self.bits))
                at += size
        return np.concatenate(out)[a - first * self.block : b - first * self.block]

    def close(self) -> None:
        self.file.close()


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, bits: int, end: int) -> Iterator[pa.RecordBatch]:
    tok, part, number, shard = word_bpe(path), TaskContext.get().partitionId(), 0, None

    def done() -> pa.RecordBatch:
        shard.close()
        row = [[part], [number], [shard.path], [shard.n_ids], [shard.n_docs]]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], MANIFEST_NAMES)

    for batch in batches:
        for rows in slices(batch, "text", 6 << 20):
            if shard is None:
                shard = ShardWriter(f"{folder}/{part:06d}-{number:04d}-{uuid.uuid4().hex}.tok", bits)
            shard.add(rows.column("id"), *with_end(*tok.encode(rows.column("text")), end))
            if shard.n_ids >= SHARD_IDS:
                yield done()
                number, shard = number + 1, None
    if shard is not None:
        yield done()


MANIFEST_NAMES = ["part", "number", "path", "n_ids", "n_docs"]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = ShardReader(row["path"])
            first = 0
            while first < len(shard.doc_ids):
                stop = max(first + 1, int(np.searchsorted(shard.starts, shard.starts[first] + READ_IDS, "right")) - 1)
                offsets = shard.starts[first : stop + 1]
                ids = shard.ids(int(offsets[0]), int(offsets[-1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        shard.doc_ids.slice(first, stop - first),
                        pa.array(offsets[:-1] + row["start"]),
                        int32_lists(ids, offsets - offsets[0]),
                    ],
                    ["doc_id", "start", "ids"],
                )
                first = stop
            shard.close()


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, offsets = flat_lists(batch.column("ids"))
        view = memoryview(values.astype("<u4")).cast("B")
        crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets)), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def write_packed(df: DataFrame, path: str, end: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards of all rows in ascending id order; the stored manifest of shards, with each one's first position.

    ``path``: a ``tokenizers`` file found on every executor. Rows are dealt by (id, text hash, row
    number), so one id may hold any share of the rows.
    """
    spark = df.sparkSession
    bits = bits_for(word_bpe(path).vocabulary())
    folder = scratch_path(spark, "packed")
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    keyed = rows.withColumns({"h": F.xxhash64("text"), "n": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange("id", "h", "n").sortWithinPartitions("id", "h", "n").select("id", "text")
    shards, _ = materialize(
        dealt.mapInArrow(partial(_write, folder=folder, path=path, bits=bits, end=end), MANIFEST), "manifest"
    )
    ordered = shards.withColumn("place", F.col("part").cast("bigint") * 100_000 + F.col("number"))
    return running_start(ordered, "place", "n_ids", "start", width=1024 * 100_000).drop("place")


def _dealt(manifest: DataFrame) -> DataFrame:
    """Shards to read, a few per task at most; they are few and Spark would put them all into one."""
    return manifest.select("path", "start").repartition(max(1, min(READ_TASKS, manifest.count())), "path")


def read_packed(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids array<int>) of every document in the shards; start counts all ids before it."""
    return _dealt(manifest).mapInArrow(_read, "doc_id bigint, start bigint, ids array<int>")


def packed_checksums(manifest: DataFrame) -> DataFrame:
    """Per document start, n_tokens and crc32, from the files."""
    return _dealt(manifest).mapInArrow(
        lambda batches: _checksums(_read(batches)), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
