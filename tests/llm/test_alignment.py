"""Two tokenizers over whole texts against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from riskloom.llm import alignment
from riskloom.llm.queries import BYTE_BPE, PIECES, QUERIES

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def both():
    return alignment.ByteLevelBpe(BYTE_BPE), alignment.PieceBpe(PIECES)


def spans(ids, table):
    out, at = [], 0
    for i in ids:
        size = len(table[i].as_py())
        out.append((at, at + size, i))
        at += size
    return out


def joined(ids, table):
    return b"".join(table[i].as_py() for i in ids)


def expected(texts, both):
    """Every text encoded whole; links by comparing byte ranges."""
    first, second = both
    found, counts = [], Counter()
    for text in texts:
        a, b = [], []
        if text:
            a, b = first.tok.encode(" " + text, add_special_tokens=False).ids, second.sp.encode(text)
            if not joined(a, first.bytes) == joined(b, second.bytes) == (" " + text).encode():
                a, b = [], []
        a, b = spans(a, first.bytes), spans(b, second.bytes)
        links, k = [], 0
        for lo, hi, i in a:
            while k and b[k - 1][1] > lo:
                k -= 1
            while k < len(b) and b[k][1] <= lo:
                k += 1
            while k < len(b) and b[k][0] < hi:
                links.append((i, b[k][2]))
                k += 1
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, x, y = [], 0, 0
        for cut in cuts:
            one, two = [], []
            while x < len(a) and a[x][1] <= cut:
                one.append(str(a[x][2]))
                x += 1
            while y < len(b) and b[y][1] <= cut:
                two.append(str(b[y][2]))
                y += 1
            groups.append(f"{','.join(one)}|{','.join(two)}")
        found.append((len(a), len(b), links, groups))
        counts.update(links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for n_a, n_b, links, groups in found
    ]


def test_whole_documents(spark, sf, both):
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas().sort_values("doc_id")
    got = QUERIES["op11_alignment"](spark, sf).toPandas().sort_values("doc_id")
    assert got.doc_id.tolist() == docs.doc_id.tolist()
    assert list(zip(*(got[c].tolist() for c in COLUMNS))) == expected(docs.text.tolist(), both)
    assert (got.n_groups > 0).mean() > 0.9


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "  b", "x  y", "x　 y", "  y", "a▁b", "▁", "\n\n  a\n b", "tab\t x",
    "<s> </s> <unk> <0x41>", "<|endoftext|> x <|endoftext|>", "café naïve 中文 рус \U0001f600 ‍", "\u0000 a\u0000", "don't we'll  it's",
    "é ́", "﻿x �", "x" * 5000, " " * 300 + "y" + " " * 300,
]


def test_odd_texts_and_repeats(spark, both):
    rng = random.Random(4)
    alphabet = [" ", " ", "a", "b", "the", "1", ".", "\n", " ", " ", "\u0085", "é", "中", "'s", "▁", "\U0001f600", "\t", "　", "\u007f", "\u001c"]
    texts = ODD + ODD[-4:] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(600)]
    rows = [(i, t, 1, 2, 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int, code int, a int").repartition(3)
    got, _ = alignment.align_texts(df, BYTE_BPE, PIECES)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    want = expected(texts, both)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[0] == 0 for w in want) > 5


def test_pairs_are_counted_over_all_slices(spark, both, monkeypatch):
    texts = ["the cat sat on the mat", "the dog, the cat", "mat the"] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got, pairs = alignment.align_texts(df, BYTE_BPE, PIECES)
    assert [tuple(r[c] for c in COLUMNS) for r in got.orderBy("doc_id").collect()] == expected(texts, both)
    assert pairs.groupBy("a", "b").count().where("count > 1").count() == 0


def test_segments_make_up_the_text():
    rng = random.Random(2)
    for _ in range(300):
        texts = ["".join(rng.choice(["a", " ", " ", " ", "　", "é", "\n", "中"]) for _ in range(rng.randrange(20))) for _ in range(5)]
        segments, offsets = alignment.cut_segments(pa.array(texts, pa.string()))
        parts = segments.to_pylist()
        assert ["".join(parts[a:b]) for a, b in zip(offsets, offsets[1:])] == [" " + t for t in texts]
        assert all(p[0] == " " for p in parts)
        for a, b in zip(offsets, offsets[1:]):
            for left in parts[a : b - 1]:
                assert not left[-1].isspace()


def test_empty_table(spark):
    got, pairs = alignment.align_texts(spark.createDataFrame([], "doc_id long, text string"), BYTE_BPE, PIECES)
    assert got.collect() == [] and pairs.collect() == []


def test_piece_bytes_are_public_facts(both):
    assert both[0].bytes[50256 - 1].as_py() and np.sum(pa.compute.binary_length(both[1].bytes).to_numpy() == 0) == 3
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECES
