"""Token ids of whole texts by public tokenizer files. Nothing here needs a network."""

from __future__ import annotations

import base64
import os
import re
import sys
import types
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskloom.llm.words import split_words

_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Letters of Latin-1: single code points in normal form, lower-cased one by one.
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
_SIMPLE = "^" + _LETTERS + r"[!-&(-/:-@\[-`{-~]*$"
_JOINED = 2000
# Between a letter or digit and a space or line feed no match of the split pattern goes on.
_SAFE_CUT = re.compile(r"(?<=[^\W_])(?=[ \n])")


class WordBpe:
    """Ids by a ``tokenizers`` file.

    A vocabulary that drops white space encodes each word on its own, so each distinct word
    is encoded once and remembered (up to ``remember`` of them); other vocabularies encode whole
    texts. Strings of special tokens count as ordinary text.

    Most words are Latin letters with punctuation after them. Letters are one piece that the normaliser
    only lower-cases, punctuation after them is another, so the two are looked up apart, and new runs of letters go through the
    library many at a time, in its byte alphabet and without the normaliser; the token that ends a
    word tells them apart again. All other words take the library's whole way one by one.
    """

    def __init__(self, path: str, remember: int = 300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.remember = remember
        self.by_word = self._ids([" ab\n\tab  "])[0] == self._ids(["ab"])[0] * 2
        self.lower = self._ids(["AbZ"]) == self._ids(["abz"])
        self.bare = Tokenizer.from_file(path)
        self.bare.encode_special_tokens = True
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        shown = {32, *range(33, 127), *range(161, 173), *range(174, 256)}
        self.alphabet = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown or b == 32) if b != 32}
        self._forget()
        tests = ["the", "unquestionable", "\u00c9a", "gr\u00f6\u00dfe", "\u00f1u", "xqzj", "\u00e0"]
        self.direct = self.by_word and self.lower and np.array_equal(self._letters(tests)[1], np.concatenate(self._ids(tests)))
        if self.direct:
            marked = self._ids([f"a{_TAIL} b"])[0]
            self.direct = marked == self._ids(["a"])[0] + self._ids([_TAIL])[0] + self._ids(["b"])[0]

    def _forget(self) -> None:
        """Words and their ids as columns; the first is the empty word."""
        self.words = pa.array([""], pa.string())
        self.sizes, self.flat = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def vocabulary(self) -> int:
        return self.tok.get_vocab_size(with_added_tokens=True)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self._ids(words)
        return np.fromiter(map(len, lists), np.int64, len(lists)), np.fromiter(chain.from_iterable(lists), np.uint32)

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of runs of letters."""
        joined = [" ".join(words[i : i + _JOINED]).lower() for i in range(0, len(words), _JOINED)]
        mapped = [t if t.isascii() else t.encode().decode("latin-1").translate(self.alphabet) for t in joined]
        ids = [e.ids for e in self.bare.encode_batch_fast(mapped, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.uint32)
        return np.diff(np.flatnonzero(self.ends[flat]) + 1, prepend=0), flat

    def _rows(self, words: pa.Array, letters: bool) -> np.ndarray:
        """Places of words in the columns; new ones are encoded and added."""
        coded = words.dictionary_encode()
        new = coded.dictionary.filter(pc.is_null(pc.index_in(coded.dictionary, value_set=self.words)))
        if len(new):
            sizes, flat = (self._letters if letters else self._whole)(new.to_pylist())
            if len(sizes) != len(new):
                raise ValueError("a word did not end with one token")
            self.words = pa.concat_arrays([self.words, new])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, flat])
        return pc.index_in(coded.dictionary, value_set=self.words).to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each text's offsets); null is empty."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            sizes, flat = self._whole(texts.to_pylist())
            return flat, np.concatenate([[0], np.cumsum(sizes)])
        words, offsets = split_words(pc.ascii_lower(texts) if self.lower else texts)
        if not len(words):
            return np.empty(0, np.uint32), offsets
        if len(self.words) > self.remember:
            self._forget()
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        simple = pc.match_substring_regex(distinct, _SIMPLE) if self.direct else pa.array(np.zeros(len(distinct), bool))
        flags = simple.to_numpy(zero_copy_only=False)
        parts = np.zeros((len(distinct), 2), np.int64)  # letters or whole word, and the tail
        parts[~flags, 0] = self._rows(distinct.filter(pc.invert(simple)), False)
        if flags.any():
            own = distinct.filter(simple)
            parts[flags, 0] = self._rows(pc.utf8_rtrim(own, _TAIL), True)
            parts[flags, 1] = self._rows(pc.replace_substring_regex(own, "^" + _LETTERS, ""), False)
        flat, _ = _gather(self.flat, self.sizes, parts.ravel())
        return _gather(flat, self.sizes[parts].sum(axis=1), coded.indices.to_numpy(), offsets)


def _gather(flat: np.ndarray, sizes: np.ndarray, rows: np.ndarray, offsets: np.ndarray | None = None):
    """The parts of a flat array at ``rows`` in a row, and where the groups of rows begin."""
    each = sizes[rows]
    ends = np.concatenate([[0], np.cumsum(each)])
    place = np.repeat((np.cumsum(sizes) - sizes)[rows] - ends[:-1], each) + np.arange(ends[-1])
    return flat[place], ends if offsets is None else ends[offsets]


def per_worker(name: str, make: Callable):
    """An object kept in the Python process between tasks. Functions travel by value, so the module cannot hold it."""
    held = sys.modules.setdefault("_riskloom_worker", types.ModuleType("_riskloom_worker")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def word_bpe(path: str) -> WordBpe:
    return per_worker(path, lambda: WordBpe(path))


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the end id to every text."""
    return np.insert(ids, offsets[1:], np.uint32(end)), offsets + np.arange(len(offsets))


def rank_encoding(path: str, pattern: str):
    """tiktoken over a local rank file, without special tokens."""

    def make():
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        return tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return per_worker(f"{path} {pattern}", make)


def safe_parts(text: str, size: int) -> list[str]:
    """Cut a long text where the split pattern cannot match across; a stretch without such a place stays whole."""
    if len(text) <= size:
        return [text]
    parts, start = [], 0
    while len(text) - start > size:
        found = _SAFE_CUT.search(text, start + size)
        if not found:
            break
        parts.append(text[start : found.start()])
        start = found.start()
    return [*parts, text[start:]]


def id_bytes(vocabulary: int) -> int:
    """Bytes of an id in a binary column: 2 where they hold the vocabulary, else 4."""
    return 2 if vocabulary <= 1 << 16 else 4
