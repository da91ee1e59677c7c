"""Alignment of two tokenizers over the same texts, as Arrow tables.

Each text is read as space + text and cut into segments before every space that follows a character other than white space. No
match of the first tokenizer's split pattern and no piece of the second one crosses such a place, so both are run once
on the distinct segments of a slice of texts, and both have a token end there.

The tokens of the distinct segments are flat Arrow columns: ids by ``list_flatten``, their segment by
``list_parent_indices``, their byte ends by a cumulative sum less the segment's start. An Acero hash join of the two
tables on (segment, end) finds the ends that both share; they cut the segment into groups. Every stretch between neighbouring ends of
either tokenizer lies in one token of each, and each overlapping pair has exactly one such stretch, so the rows of the outer join, sorted by
end and filled backwards, are the links. ``Table.group_by`` counts them per slice, weighted with the occurrences of the
segment, and Spark adds the slices up, finds each second id's highest count, and brings the counts back to the slices that
hold the pair. A slice then sums them over its segments and texts.

Memory is bounded by a slice (SLICE bytes of text, or one longer text). A pair that all slices hold is one row per slice before
Spark adds it up. Nothing is gathered on the driver and nothing is broadcast.

Null and empty texts, and texts whose tokens do not give back their bytes (a literal U+2581, for instance), have no tokens: zeros
and an empty digest. Repeated rows are separate texts and count each time. Ties for the highest count are all best. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import give_back, slices
from riskloom.llm.tokens import per_worker
from riskloom.session import materialize

SLICE = 8 << 20
PART = 8192
SPACE = 0x20


class ByteLevelBpe:
    """Ids of a byte-level ``tokenizers`` file and the bytes of every id."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        # The byte alphabet: shown bytes stand for themselves, the others for the code points from 256 on.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        table = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            table[i] = bytes(back[c] for c in token)
        self.bytes = pa.array(table, pa.binary())

    def encode(self, segments: list[str]) -> list[list[int]]:
        """A part at a time: the library keeps far more than the ids of each segment."""
        parts = (segments[i : i + PART] for i in range(0, len(segments), PART))
        return [e.ids for part in parts for e in self.tok.encode_batch_fast(part, add_special_tokens=False)]


class PieceBpe:
    """Ids of a ``sentencepiece`` file that puts a space before every text, and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = pa.array([self._bytes(i) for i in range(self.sp.get_piece_size())], pa.binary())

    def _bytes(self, i: int) -> bytes:
        piece = self.sp.id_to_piece(i)
        if self.sp.is_control(i) or self.sp.is_unknown(i):
            return b""
        value = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(value[1], 16)]) if value and self.sp.is_byte(i) else piece.replace("\u2581", " ").encode()

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Each segment begins with the space that the model adds, but not to an empty text."""
        alone = self.sp.piece_to_id("\u2581")
        return [ids or [alone] for ids in self.sp.encode([s[1:] for s in segments], num_threads=1)] if segments else []


def cut_segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(segments of space + text, each text's first segment and the end); texts must not be null.

    The place before a space is cut only if the bytes before it cannot end a white-space character.
    """
    spaced = pc.binary_join_element_wise("", texts, " ").cast(pa.large_string())
    data = np.frombuffer(spaced.buffers()[2] or b"", np.uint8)
    bounds = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
    data = data[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    before = np.concatenate([np.full(3, SPACE, np.uint8), data])
    last, second, third = before[2:-1], before[1:-2], before[:-3]
    # Wider white space is C2 xx, or E1, E2 or E3 and two more bytes.
    wide = (last >= 0x80) & ((second == 0xC2) | (third >= 0xE1) & (third <= 0xE3))
    cut = (data == SPACE) & (last > SPACE) & (last != 0x7F) & ~wide
    cut[bounds[:-1]] = True
    at = np.flatnonzero(cut)
    places = np.append(at, len(data)).astype(np.int64)
    segments = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data)))
    return segments, np.searchsorted(at, bounds).astype(np.int64)


def _tokens(lists: list[list[int]], table: pa.Array, name: str) -> tuple[pa.Table, np.ndarray, pa.Array]:
    """(segment, end, id) of every token, bytes of each segment's tokens, and all bytes."""
    column = pa.array(lists, pa.list_(pa.int32()))
    ids, parent = pc.list_flatten(column), pc.list_parent_indices(column)
    data = table.cast(pa.large_binary()).take(ids)
    ends = pc.cumulative_sum(pc.binary_length(data)).to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    before = np.concatenate([[0], ends])[offsets]
    end = ends - before[:-1][parent.to_numpy()]
    made = pa.table({"segment": pa.array(parent, pa.int64()), "end": pa.array(end, pa.int64()), name: ids})
    return made, np.diff(before), data


def _same_bytes(segments: pa.Array, sizes: np.ndarray, data: pa.Array) -> np.ndarray:
    """Which segments their tokens give back byte by byte."""
    want = np.diff(np.frombuffer(segments.buffers()[1], np.int64)[segments.offset : segments.offset + len(segments) + 1])
    ok = want == sizes
    flat = data.buffers()[2]
    if ok.all() and flat is not None and flat.to_pybytes()[: int(sizes.sum())] == b"".join(x.encode() for x in segments.to_pylist()):
        return ok
    held, at = (flat.to_pybytes() if flat is not None else b""), np.concatenate([[0], np.cumsum(sizes)])
    return np.array([held[a:b] == x.encode() for a, b, x in zip(at, at[1:], segments.to_pylist())], bool)


def align(a: pa.Table, b: pa.Table) -> pa.Table:
    """Links of two token tables (segment, end, a) and (segment, end, b) in order: segment, a, b, a_ends, b_ends."""
    both = a.join(b, ["segment", "end"], join_type="full outer", use_threads=False)
    both = both.sort_by([("segment", "ascending"), ("end", "ascending")]).combine_chunks()
    ends = {f"{c}_ends": pc.is_valid(both.column(c)) for c in "ab"}
    # Both end with the segment, so nothing is filled from the next one.
    filled = {c: pc.fill_null_backward(both.column(c)) for c in "ab"}
    return pa.table({"segment": both.column("segment"), **filled, **ends})


def _group_texts(links: pa.Table, n: int, size: int) -> tuple[pa.Array, np.ndarray]:
    """(tokens as text, each followed by its separator, in order of groups; bytes of each segment)."""
    segment = links.column("segment").to_numpy()
    ends = {c: links.column(f"{c}_ends").to_numpy() for c in "ab"}
    common = ends["a"] & ends["b"]
    group = np.cumsum(common) - common
    rows = {c: np.flatnonzero(ends[c]) for c in "ab"}
    ids = {c: links.column(c).to_numpy()[rows[c]] for c in "ab"}
    # 0: more of the group follow, 1: the first tokenizer's last, 2: the group's last.
    ids["a"] = ids["a"] + size * common[rows["a"]]
    ids["b"] = ids["b"] + size * 2 * common[rows["b"]]
    owner = np.concatenate([group[rows["a"]] * 2, group[rows["b"]] * 2 + 1])
    order = np.argsort(owner, kind="stable")
    numbers = pc.cast(pa.array(np.arange(size, dtype=np.int32)), pa.large_string())
    names = pa.concat_arrays([pc.binary_join_element_wise(numbers, pa.scalar("", pa.large_string()), pa.scalar(s, pa.large_string())) for s in ",|;"])
    text = names.take(pa.array(np.concatenate([ids["a"], ids["b"]])[order]))
    held = np.concatenate([segment[rows["a"]], segment[rows["b"]]])[order]
    lengths = pc.binary_length(text).to_numpy(zero_copy_only=False)
    return text, np.bincount(held, lengths, n).astype(np.int64)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run in a row."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - np.concatenate([[0], ends[:-1]]), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


KEYS = "part int, nth int"
TEXTS = f"{KEYS}, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, segments array<int>"
STEP = f"{TEXTS}, pairs array<int>, sizes array<int>, a int, b int, code int, n bigint"


def _slice(rows: pa.RecordBatch, first, second) -> tuple[dict, dict, dict]:
    """The texts, the distinct segments and the counted pairs of a slice."""
    texts = pc.fill_null(rows.column("text"), "")
    segments, offsets = cut_segments(texts)
    coded = segments.dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy()
    plain = distinct.to_pylist()
    a, a_sizes, a_data = _tokens(first.encode(plain), first.bytes, "a")
    b, b_sizes, b_data = _tokens(second.encode(plain), second.bytes, "b")
    good = _same_bytes(distinct, a_sizes, a_data) & _same_bytes(distinct, b_sizes, b_data)
    whole = (_sums(~good[codes], offsets) == 0) & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
    if not good.all():
        left = pc.field("segment").isin(pa.array(np.flatnonzero(good)))
        a, b = a.filter(left), b.filter(left)
    n = len(distinct)
    links = align(a, b)
    text, bytes_each = _group_texts(links, n, max(len(first.bytes), len(second.bytes)))
    segment = links.column("segment").to_numpy()
    per_segment = {
        "n_a": np.bincount(segment, links.column("a_ends").to_numpy(), n), "n_b": np.bincount(segment, links.column("b_ends").to_numpy(), n),
        "n_groups": np.bincount(segment, links.column("a_ends").to_numpy() & links.column("b_ends").to_numpy(), n),
        "n_links": np.bincount(segment, minlength=n),
    }
    held = np.repeat(whole, np.diff(offsets))
    codes = codes[held]
    kept = np.concatenate([[0], np.cumsum(np.diff(offsets) * whole)])
    # Links by slice: each distinct segment counts as often as whole texts hold it.
    weighted = links.select(["a", "b"]).append_column("n", pa.array(np.bincount(codes, minlength=n)[segment]))
    counted = weighted.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
    number = counted.select(["a", "b"]).append_column("code", pa.array(np.arange(len(counted), dtype=np.int32)))
    order = links.select(["a", "b"]).append_column("row", pa.array(np.arange(len(links))))
    pairs = order.join(number, ["a", "b"], use_threads=False).sort_by("row").column("code").combine_chunks()
    flat = text.buffers()[2]
    flat = memoryview(flat if flat is not None else b"")
    starts = np.cumsum(bytes_each) - bytes_each
    digests = []
    for i in range(len(texts)):
        own = codes[kept[i] : kept[i + 1]]
        sha = hashlib.sha256()
        for k in own[:-1].tolist():
            sha.update(flat[starts[k] : starts[k] + bytes_each[k]])
        if len(own):
            sha.update(flat[starts[own[-1]] : starts[own[-1]] + bytes_each[own[-1]] - 1])  # no separator at the end
        digests.append(sha.hexdigest() if whole[i] else "")
    out = {"doc_id": rows.column("id"), **{k: pa.array(_sums(v.astype(np.int64)[codes], kept)) for k, v in per_segment.items()}}
    out |= {"groups_sha256": pa.array(digests, pa.string()), "segments": _lists(codes.astype(np.int32), kept)}
    each = per_segment["n_links"]
    bundle = {"pairs": _lists(pairs.to_numpy(), np.array([0, len(pairs)])), "sizes": _lists(each.astype(np.int32), np.array([0, n]))}
    seen = counted.append_column("code", number.column("code")).filter(pc.field("n_sum") > 0).combine_chunks()
    seen = {"a": seen.column("a"), "b": seen.column("b"), "code": seen.column("code"), "n": seen.column("n_sum")}
    return out, bundle, {k: v.combine_chunks().cast(pa.int64() if k == "n" else pa.int32()) for k, v in seen.items()}


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))


def _encoded(batches: Iterator[pa.RecordBatch], first: str, second: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    a, b = per_worker(f"bytes {first}", lambda: ByteLevelBpe(first)), per_worker(f"pieces {second}", lambda: PieceBpe(second))
    part, nth = TaskContext.get().partitionId(), 0
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            for columns in _slice(rows, a, b):
                n = len(next(iter(columns.values())))
                columns |= {"part": pa.array(np.full(n, part, np.int32)), "nth": pa.array(np.full(n, nth, np.int32))}
                yield pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)
            nth += 1
            give_back()


def _finished(texts: Iterator[pa.RecordBatch] | pa.Table, known: pa.Table) -> pa.Table:
    """The texts of one slice with the sums of their links' counts; ``known``: its segments and, for each pair, count and best."""
    is_pair = pc.is_valid(known.column("code"))
    pairs, bundle = known.filter(is_pair), known.filter(pc.invert(is_pair))
    links = bundle.column("pairs").combine_chunks()
    code, sizes = links.values.to_numpy(), bundle.column("sizes").combine_chunks().values.to_numpy()
    n = int(code.max(initial=-1)) + 1
    count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    count[pairs.column("code").to_numpy()] = pairs.column("total").to_numpy()
    best[pairs.column("code").to_numpy()] = pairs.column("best").to_numpy()
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = {"count_sum": _sums(count[code], offsets), "n_best": _sums(best[code], offsets)}
    segments = texts.column("segments").combine_chunks()
    held = segments.flatten().to_numpy()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(segments).to_numpy(zero_copy_only=False))]).astype(np.int64)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    columns = {c: texts.column(c) for c in names} | {k: pa.array(_sums(out[k][held], ends)) for k in ("n_best", "count_sum")}
    return pa.table(columns | {"groups_sha256": texts.column("groups_sha256")})


def align_texts(df: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(one row per text, counts of id pairs).

    Texts: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Pairs: a, b, total, best (1 if no pair with this b has a higher count).
    ``first``: a byte-level ``tokenizers`` file; ``second``: a ``sentencepiece`` file; both found on every executor.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    spark = df.sparkSession
    schema = pa.schema([
        ("part", pa.int32()), ("nth", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("segments", pa.list_(pa.int32())),
        ("pairs", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("a", pa.int32()), ("b", pa.int32()), ("code", pa.int32()), ("n", pa.int64()),
    ])
    made, _ = materialize(rows.mapInArrow(partial(_encoded, first=first, second=second, schema=schema), STEP), "aligned")
    seen = made.where("a IS NOT NULL").select("part", "nth", "a", "b", "code", "n")
    totals = seen.groupBy("a", "b").agg(F.sum("n").alias("total"))
    totals, _ = materialize(totals, "pair-counts")
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    pairs = totals.join(highest, "b").select("a", "b", "total", (F.col("total") == F.col("highest")).cast("int").alias("best"))
    pairs, _ = materialize(pairs, "pairs")
    counted = seen.join(pairs, ["a", "b"]).select("part", "nth", "code", "total", "best", F.lit(None).cast("array<int>").alias("pairs"), F.lit(None).cast("array<int>").alias("sizes"))
    bundles = made.where("sizes IS NOT NULL").select(
        "part", "nth", F.lit(None).cast("int").alias("code"), F.lit(None).cast("bigint").alias("total"), F.lit(None).cast("int").alias("best"), "pairs", "sizes"
    )
    texts = made.where("segments IS NOT NULL").select(*TEXTS_COLUMNS)
    known = counted.unionByName(bundles).toDF("slice_part", "slice_nth", "code", "total", "best", "pairs", "sizes")
    result = texts.groupBy("part", "nth").cogroup(known.groupBy("slice_part", "slice_nth")).applyInArrow(
        _finished,
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    )
    return result, pairs


TEXTS_COLUMNS = ["part", "nth", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "segments"]
