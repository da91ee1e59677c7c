"""Packing into few sequences: every id once, gapless offsets, nearly no room, rounds of the tree."""

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from test_contracts import crc, word_ids

from riskloom.llm import packing, residual_packing
from riskloom.llm.queries import QUERIES, WORD_BPE


def check_sequences(rows, capacity):
    for _, own in rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert own.offset.tolist() == (own.length.cumsum() - own.length).tolist()
        assert own.length.sum() <= capacity


def test_whole_documents(spark, sf):
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas()
    got = QUERIES["op13_residual_packing"](spark, sf).toPandas()
    ids = dict(zip(docs.doc_id, word_ids(docs.text)))
    check_sequences(got, 4096)
    for doc, rows in got.sort_values("piece").groupby("doc_id"):
        own = ids[doc]
        assert rows.piece.tolist() == list(range(-(-len(own) // 4096)))
        assert rows.start.tolist() == [4096 * i for i in rows.piece]
        for r in rows.itertuples():
            part = own[r.start : r.start + r.length]
            assert r.length == len(part) == min(4096, len(own) - r.start) and r.ids_crc32 == crc(part)
    assert set(got.doc_id) == set(docs.doc_id)
    assert got.sequence_id.nunique() <= 1.005 * np.ceil(got.length.sum() / 4096) + 1


def test_best_fit_against_a_plain_one():
    rng = random.Random(1)
    for _ in range(50):
        capacity = rng.randrange(5, 80)
        lengths = np.array([rng.randint(1, capacity) for _ in range(rng.randrange(60))], np.int64)
        bins, places, held = residual_packing.best_fit(lengths, capacity)
        rooms = []
        for n in sorted(lengths.tolist(), reverse=True):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - n)
            else:
                rooms.append(capacity - n)
        assert sorted(capacity - held) == sorted(rooms)
        for b in range(len(held)):
            own = sorted(zip(places[bins == b], lengths[bins == b]))
            assert [p for p, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist()


@pytest.mark.parametrize("kind", ["mixed", "halves", "equal", "none"])
def test_many_open_sequences(spark, monkeypatch, kind):
    """Nodes of 50 sequences and chunks of 100 ids: many rounds, and none that end without all pieces."""
    monkeypatch.setattr(residual_packing, "NODE_ITEMS", 50)
    rng = random.Random(kind)
    draw = {"mixed": lambda: rng.randint(1, 64), "halves": lambda: rng.choice([33, 40, 20]), "equal": lambda: 33, "none": lambda: 64}[kind]
    held = [(i, draw()) for i in range(900)]
    leaves = spark.createDataFrame(held, "leaf long, held long")
    rows = residual_packing.merge_open(leaves, len(held), 64, 0).toPandas().rename(columns={"base": "offset"})
    rows["length"] = rows.leaf.map(dict(held))
    assert sorted(rows.leaf) == list(range(900))
    check_sequences(rows, 64)
    whole = residual_packing.best_fit(np.array([n for _, n in held], np.int64), 64)[2]
    assert len(whole) <= rows.sequence_id.nunique() <= 1.02 * len(whole) + 1


ROWS = [(1, None), (2, ""), (3, "one"), (None, "two words"), (3, "one"), (4, "word " * 9000), (5, "x " * 4094 + "x"), (6, "x " * 4095 + "x")]


@pytest.mark.parametrize("rows", [ROWS, []])
def test_odd_documents(spark, rows):
    """Nulls, repeats, a text of exactly the capacity with its end, one more, extra columns, no rows at all."""
    df = spark.createDataFrame([(*r, 0, "s", 1) for r in rows], "doc_id long, text string, piece int, leaf string, held int")
    got = residual_packing.pack(df, WORD_BPE).toPandas()
    check_sequences(got, 4096)
    want = [(i if i else -1, n // 4096 * 4096 if n % 4096 else n - 4096, n) for i, t in rows for n in [len(word_ids([t])[0])]]
    last = got.sort_values("start").groupby([got.doc_id.fillna(-1), "doc_tokens"]).start.max().reset_index()
    assert sorted(map(tuple, last[["doc_id", "start", "doc_tokens"]].to_numpy())) == sorted(set(want))
    for r in got.itertuples():
        ids = packing.unpack_ids(r.ids, r.length)
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) >= 0
    assert sum(got.length) == sum(n for _, _, n in want)
