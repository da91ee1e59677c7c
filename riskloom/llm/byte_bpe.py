"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Every text is encoded whole: long ones are cut beforehand at places where the split pattern cannot
match across (between a letter or digit and a space or line feed), which gives the same ids with
bounded work per call. Decoding joins the raw bytes of the ids. A null text counts as empty and has no
ids; repeated rows and ids stay as they are; an empty table gives an empty result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import flat_lists, int32_lists, slices
from riskloom.llm.tokens import rank_encoding, safe_parts

PART_CHARS = 1 << 16


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    enc = rank_encoding(path, pattern)
    for batch in batches:
        for part in slices(batch, "text"):
            out = []
            for text in part.column("text").to_pylist():
                parts = [enc.encode_ordinary(x) for x in safe_parts(text or "", PART_CHARS)]
                out.append(parts[0] if len(parts) == 1 else [i for x in parts for i in x])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in out], dtype=np.int64)])
            ids = np.concatenate([np.array(x, np.int32) for x in out])
            yield pa.RecordBatch.from_arrays([part.column(0), int32_lists(ids, offsets)], ["id", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Keeps the ids and adds their bytes."""
    enc = rank_encoding(path, pattern)
    for batch in batches:
        values, offsets = flat_lists(batch.column("ids"))
        raw = [enc.decode_bytes(values[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], ["id", "ids", "bytes"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, offsets = flat_lists(batch.column("ids"))
        view = memoryview(values.astype("<u4")).cast("B")
        ids = [hashlib.sha256(view[4 * a : 4 * b]).hexdigest() for a, b in zip(offsets, offsets[1:])]
        raw = [hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("bytes")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(np.diff(offsets)), pa.array(ids), pa.array(raw)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row; ``path`` must name the rank file on every executor."""
    rows = df.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(partial(_encode, path=path, pattern=pattern), f"id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(id, ids, bytes binary) of encoded rows."""
    kind = dict(encoded.dtypes)["id"]
    return encoded.select("id", "ids").mapInArrow(
        partial(_decode, path=path, pattern=pattern), f"id {kind}, ids array<int>, bytes binary"
    )


def round_trip_digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, decode and digest in one pass over ``doc_id`` and ``text``: ids and bytes stay in the Python worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digests(_decode(_encode(batches, path, pattern), path, pattern))

    return df.selectExpr("doc_id AS id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
