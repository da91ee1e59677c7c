"""Repeated passages, found as runs of consecutive sentences.

A sentence ends after a word that ends in ``.``, ``!`` or ``?`` or that a line feed follows before the next word; one of more than LONG words is cut after
every word whose hash is the smallest of some NEAR consecutive words (all of equal ones). So the words
themselves choose the cuts: at most NEAR words apart, and the same in every copy but for NEAR - 1 words at its edges. A passage of
4 * NEAR + MIN_WORDS - 3 words (49) inside long sentences therefore shares a run with each of its copies. From every sentence a run goes on until it has at least MIN_SENTENCES sentences
and MIN_WORDS words. Runs are hashed (128 bits over lower-cased words) and joined over the whole table. The first place of a run (smallest doc_id,
null last, then text hash, then position) keeps it; in all other places every sentence that the run covers is removed. A place that overlaps
the first one of the same run (a sentence that a document repeats several times in a row) loses the sentences that both cover, too, so
such a row shrinks to its first sentence. Removing keeps the rest of the text as it is.

Texts are cut a slice at a time on flat arrays: words by their bytes, hashes by distinct word, runs by differences of running sums. The first pass
counts 64-bit hashes only, with map-side sums, and leaves those that occur more than once. Only runs
with such a hash travel on, so hot passages are sums and skew-split joins, never one group in a task.

Null and empty texts have no runs and stay; a text shorter than a run stays; rows that repeat both id and text are one document
and get the same result, once per row; an empty table gives an empty result. All other columns of the table are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import forget, free_names, release, slices
from riskloom.llm.words import mix
from riskloom.session import materialize

MIN_SENTENCES = 2
MIN_WORDS = 24
LONG = 16
NEAR = 7
SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to white space, as str.split sees it."""
    white = (data == 32) | (data >= 9) & (data <= 13) | (data >= 28) & (data <= 31)
    if not (data >= 0x80).any():
        return white
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    one, two, three = padded[:-2], padded[1:-1], padded[2:]
    # U+0085 and U+00A0, then U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F and U+3000.
    pairs = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
    general = (two == 0x80) & ((three >= 0x80) & (three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF)) | (two == 0x81) & (three == 0x9F)
    triples = (one == 0xE1) & (two == 0x9A) & (three == 0x80) | (one == 0xE2) & general | (one == 0xE3) & (two == 0x80) & (three == 0x80)
    white |= pairs | triples
    white[1:] |= pairs[:-1] | triples[:-1]
    white[2:] |= triples[:-2]
    return white


@dataclass
class Cut:
    """Sentences of several texts. Those of text i are ``texts[i]`` to ``texts[i + 1]``; ``starts`` are bytes, and the end; words are counted by ``words``."""

    data: np.ndarray
    bounds: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    words: np.ndarray
    first_word: np.ndarray
    hashes: tuple[np.ndarray, np.ndarray]


def _word_hashes(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128 bits and the order among neighbours of every lower-cased word, each distinct word hashed once. ``flat``: their bytes in a row."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(flat))
    coded = words.dictionary_encode()
    plain = [w.lower().encode() for w in coded.dictionary.to_pylist()]
    long = [xxhash.xxh3_128_intdigest(w) for w in plain]
    table = (
        np.array([h >> 64 for h in long], np.uint64), np.array([h & 0xFFFFFFFFFFFFFFFF for h in long], np.uint64),
        np.array([xxhash.xxh32_intdigest(w) for w in plain], np.int64),
    )
    codes = coded.indices.to_numpy()
    return tuple(t[codes] for t in table)


def _chosen(own: np.ndarray, stop: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Words of long sentences after which these are cut; ``stop``: each word's end of its sentence."""
    n = len(own)
    chosen = np.zeros(n, bool)
    if n < NEAR or not long.any():
        return chosen
    least = own[: n - NEAR + 1].copy()
    for i in range(1, NEAR):
        np.minimum(least, own[i : i + len(least)], out=least)
    inside = long[: len(least)] & (stop[: len(least)] - np.arange(len(least)) >= NEAR)
    for i in range(NEAR):
        chosen[i : i + len(least)] |= inside & (own[i : i + len(least)] == least)
    return chosen


def cut(texts: pa.Array) -> Cut:
    """The sentences of texts; null is empty. White space belongs to the sentence before it, at the start of a text to the first one."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    word = ~white_space(data)
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    inner = bounds[:-1][np.diff(bounds) > 0]
    opens[inner] = word[inner]  # a text begins a word of its own
    closes = word.copy()
    closes[:-1] &= ~word[1:]
    last = bounds[1:][np.diff(bounds) > 0] - 1
    closes[last] = word[last]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    owner = np.searchsorted(bounds, begin, side="right") - 1
    words = np.searchsorted(begin, bounds)  # first word of each text
    n = len(begin)
    high, low, own = _word_hashes(data[word], end - begin) if n else (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))
    lines = np.flatnonzero(data == 10)
    gap_end = np.append(begin[1:], len(data))[:n]
    stops = np.isin(data[end - 1], np.frombuffer(b".!?", np.uint8)) & (gap_end > end)
    stops |= np.searchsorted(lines, gap_end) > np.searchsorted(lines, end)
    stops[np.append(owner[1:] != owner[:-1], True)[:n]] = True  # the text ends
    closing = np.flatnonzero(stops)
    length = np.diff(np.concatenate([[-1], closing]))
    stop = np.repeat(closing + 1, length)
    stops |= _chosen(own, stop, np.repeat(length > LONG, length))
    closing = np.flatnonzero(stops)
    first = np.concatenate([[0], closing + 1])[: len(closing)].astype(np.int64)
    at = begin[first]
    new_text = np.isin(first, words[:-1][np.diff(words) > 0])
    at[new_text] = bounds[:-1][owner[first[new_text]]]
    return Cut(data, bounds, np.searchsorted(first, words), at, np.diff(np.append(first, n)), first, (high, low))


def sentences(text: str) -> list[str]:
    """Parts that make up the text, each with the white space after it; a text without words is one part."""
    found = cut(pa.array([text], pa.string()))
    places = [*found.starts.tolist(), len(found.data)] if len(found.starts) else [0, len(found.data)]
    raw = found.data.tobytes()
    return [raw[a:b].decode() for a, b in zip(places, places[1:]) if b > a]


def run_ends(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For the sentences of several texts (``starts``: their first ones, and the end) each run's last sentence, or -1."""
    upto = np.cumsum(words)
    last = np.searchsorted(upto, upto - words + MIN_WORDS)
    last = np.maximum(last, np.arange(len(words)) + MIN_SENTENCES - 1)
    stop = np.repeat(starts[1:], np.diff(starts))
    return np.where(last < stop, last, -1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _runs(batches: Iterator[pa.RecordBatch], count_only: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            found = cut(rows.column("text"))
            last = run_ends(found.words, found.texts)
            first = np.flatnonzero(last >= 0)
            begin, end = found.first_word[first], found.first_word[last[first]] + found.words[last[first]]
            n = len(found.hashes[0])
            forward, back = _powers(_BASE, n), _powers(_BACK, n)
            runs = []
            for h in found.hashes:
                sums = np.concatenate([[np.uint64(0)], np.cumsum(h * forward, dtype=np.uint64)])
                runs.append(pa.array((mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))).view(np.int64)))
            if count_only:
                yield pa.RecordBatch.from_arrays([runs[0]], ["h1"])
                continue
            owner = np.repeat(np.arange(len(found.texts) - 1), np.diff(found.texts))[first]
            doc, text_hash = (rows.column(c).take(pa.array(owner)) for c in ("doc_id", "text_hash"))
            at = pa.array((first - found.texts[owner]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*runs, doc, text_hash, at], ["h1", "h2", "doc_id", "text_hash", "at"])


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _removed(batches: Iterator[pa.RecordBatch], names: list[str], at: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            places = rows.column(at)
            touched = np.flatnonzero(pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False))
            texts, counts, spans = rows.column("text"), np.zeros(rows.num_rows, np.int64), [[] for _ in range(rows.num_rows)]
            if len(touched):
                whole = texts.to_pylist()
                new = _without(texts.take(pa.array(touched)), places.take(pa.array(touched)))
                for i, (text, n, own) in zip(touched.tolist(), new):
                    whole[i], counts[i], spans[i] = text, n, own
                texts = pa.array(whole, pa.string())
            made = {"text": texts, "n_removed": pa.array(counts), "removed": pa.array(spans, SPANS)}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else rows.column(c) for c in names], names)


def _without(texts: pa.Array, places: pa.ListArray) -> Iterator[tuple[str, int, list[dict]]]:
    """(text left, sentences removed, spans removed) of texts that lose the runs at these sentences."""
    found = cut(texts)
    last = run_ends(found.words, found.texts)
    starts = found.texts[:-1][pc.list_parent_indices(places).to_numpy()] + pc.list_flatten(places).to_numpy()
    gone = np.zeros(len(last) + 1, np.int64)
    np.add.at(gone, starts, 1)
    np.add.at(gone, last[starts] + 1, -1)
    gone = np.cumsum(gone)[:-1] > 0
    ends = np.append(found.starts[1:], len(found.data))
    ends[found.texts[1:][np.diff(found.texts) > 0] - 1] = found.bounds[1:][np.diff(found.texts) > 0]
    letters = np.concatenate([[0], np.cumsum((found.data & 0xC0) != 0x80, dtype=np.int32)])
    raw = found.data.tobytes()
    for i in range(len(texts)):
        own = np.arange(found.texts[i], found.texts[i + 1])
        left = b"".join(raw[found.starts[k] : ends[k]] for k in own[~gone[own]])
        spans: list[dict] = []
        base = letters[found.bounds[i]]
        for k in own[gone[own]]:
            a, b = int(letters[found.starts[k]] - base), int(letters[ends[k]] - base)
            if spans and spans[-1]["end"] == a:
                spans[-1]["end"] = b
            else:
                spans.append({"start": a, "end": b})
        yield left.decode(), int(gone[own].sum()), spans


def repeated_runs(df: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at): every run, by its first sentence, that occurs earlier in the table."""
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    counted = rows.select("text").mapInArrow(partial(_runs, count_only=True), "h1 bigint")
    shared, _ = materialize(counted.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1"), "shared")
    kinds = "h1 bigint, h2 bigint, doc_id bigint, text_hash bigint, at int"
    runs = rows.mapInArrow(partial(_runs, count_only=False), kinds)
    # Repeats grow with the table, so both sides are always shuffled, and a hot run is split as skewed.
    runs, _ = materialize(runs.join(shared, "h1"), "runs")
    forget(shared)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "at")
    first, _ = materialize(runs.groupBy("h1", "h2").agg(F.min(place).alias("first")), "first")
    release(df.sparkSession)
    again = runs.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    return again.select("doc_id", "text_hash", "at")


def remove_repeats(df: DataFrame) -> DataFrame:
    """The rows of ``df`` (it must hold doc_id and text) with repeated passages removed from ``text``.

    Adds ``n_removed`` (sentences) and ``removed`` (spans of code points in the text before); columns of these names give way.
    """
    again = repeated_runs(df)
    gone = again.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("at")).alias("at"))
    gone, _ = materialize(gone, "repeats")
    forget(again)
    release(df.sparkSession)
    kept = [c for c in df.columns if c not in ("n_removed", "removed")]
    rows = df.select(kept)
    doc, text_hash, at = free_names(df, "doc", "hash", "at")
    gone = gone.toDF(doc, text_hash, at)
    match = rows.doc_id.cast("bigint").eqNullSafe(gone[doc]) & F.xxhash64(rows.text).eqNullSafe(gone[text_hash])
    # Shuffled at every size: lists of places grow with the table.
    joined = rows.join(gone, match, "left").drop(doc, text_hash)
    names = [*kept, "n_removed", "removed"]
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", n_removed bigint, removed array<struct<start:int,end:int>>"
    return joined.mapInArrow(partial(_removed, names=names, at=at), kinds)
