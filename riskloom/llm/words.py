"""Words and shingles of texts, whole batches at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (splitmix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between white space (space, tab to carriage return) and each text's offsets; null is empty."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    keep = pc.not_equal(pc.binary_length(flat), 0)
    count = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    return flat.filter(keep), count[lists.offsets.to_numpy()].astype(np.int64)


def word_hashes(words: pa.Array) -> np.ndarray:
    coded = words.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))
    return hashes[coded.indices.to_numpy()]


def run_hashes(hashes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every run of ``size`` consecutive words; a shorter text is one run."""
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(len(counts)), counts)
    room = offsets[1:][owner] - np.arange(len(owner))  # words from here to the end of the text
    short = (counts < size)[owner] & (np.arange(len(owner)) == offsets[:-1][owner])
    starts = np.flatnonzero((room >= size) | short)
    length = np.minimum(room[starts], size)
    out = mix(hashes[starts] + _ODD)
    for j in range(1, size):
        more = length > j
        out[more] = mix(out[more] * _ODD + hashes[starts[more] + j])
    return owner[starts], mix(out + length.astype(np.uint64))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's set of ``size``-word shingles as ascending 64-bit hashes, and the offsets.

    A-Z is lower-cased. A text with fewer words is one shingle, one without words has none.
    """
    words, offsets = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    if not len(words):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    owner, runs = run_hashes(word_hashes(words), offsets, size)
    order = np.lexsort((runs, owner))
    owner, runs = owner[order], runs[order]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    owner, runs = owner[first], runs[first]
    return runs, np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int64)
