"""The registered queries against brute force over the small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from riskloom.llm import tokens
from riskloom.llm.queries import QUERIES, RANKS, WORD_BPE


def read(sf, name):
    return pq.read_table(f"{sf}/{name}.parquet").to_pandas()


@pytest.fixture(scope="module")
def docs(sf):
    return read(sf, "documents").sort_values("doc_id")


def result(spark, sf, name):
    return QUERIES[name](spark, sf).toPandas()


def word_ids(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD_BPE)
    tok.encode_special_tokens = True
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packed_ids(spark, sf, docs):
    got = result(spark, sf, "op2_packed_ids").sort_values("start")
    ids = word_ids(docs.text)
    assert got.doc_id.tolist() == docs.doc_id.tolist()
    assert got.n_tokens.tolist() == [len(x) for x in ids]
    assert got.start.tolist() == (np.cumsum([len(x) for x in ids]) - [len(x) for x in ids]).tolist()
    assert got.ids_crc32.tolist() == [crc(x) for x in ids]


def test_packing(spark, sf, docs):
    got = result(spark, sf, "op6_packing")
    ids = dict(zip(docs.doc_id, word_ids(docs.text)))
    for doc, rows in got.sort_values("start").groupby("doc_id"):
        at = 0
        for r in rows.itertuples():
            assert r.start == at and r.doc_tokens == len(ids[doc])
            assert r.ids_crc32 == crc(ids[doc][at : at + r.length])
            at += r.length
        assert at == len(ids[doc])
    assert set(got.doc_id) == set(docs.doc_id)
    padding = 0
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == (rows.length.cumsum() - rows.length).tolist()
        total = rows.length.sum()
        assert total <= 2048
        padding += 0 if total & (total - 1) == 0 else 2048 - total
    assert padding < 0.02 * got.length.sum()


def groups(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def shingles(text, size):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def similar_pairs(sets, percent=80):
    held = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            held[x].append(i)
    shared = defaultdict(int)
    for rows in held.values():
        for i, a in enumerate(rows):
            for b in rows[i + 1 :]:
                shared[a, b] += 1
    return [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]


def test_near_duplicates(spark, sf, docs):
    got = result(spark, sf, "op7_near_duplicates").sort_values("doc_id")
    sets = [shingles(t, 2) for t in docs.text]
    assert got.n_shingles.tolist() == [len(s) for s in sets]
    names = docs.doc_id.to_numpy()[groups(len(sets), similar_pairs(sets))]
    assert got.component_id.tolist() == names.tolist()
    assert got.kept.tolist() == (got.doc_id == got.component_id).tolist()
    assert (~got.kept).sum() > 5


def test_near_vectors(spark, sf):
    rows = read(sf, "embeddings").sort_values("vec_id")
    got = result(spark, sf, "op8_near_vectors").sort_values("vec_id")
    v = np.stack(rows.embedding).astype(float)
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    near = (v @ v.T >= 0.98) & (rows.label.to_numpy()[:, None] == rows.label.to_numpy())
    np.fill_diagonal(near, False)
    assert got.n_links.tolist() == near.sum(axis=1).tolist()
    names = rows.vec_id.to_numpy()[groups(len(v), np.argwhere(near))]
    assert got.component_id.tolist() == names.tolist()


def test_nearest_recall(spark, sf):
    rows = read(sf, "embeddings").sort_values("vec_id")
    got = result(spark, sf, "op3_nearest")
    v = np.stack(rows.embedding).astype(float)
    ids = rows.vec_id.to_numpy()
    hit = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        cos = v @ v[q] / np.sqrt((v * v).sum(axis=1) * (v[q] @ v[q]))
        true = [i for i in np.lexsort((ids, -cos)) if i != q][:5]
        own = got[got.query_id == ids[q]].sort_values("rank")
        assert own["rank"].tolist() == [1, 2, 3, 4, 5]
        assert np.allclose(own.score, cos[np.searchsorted(ids, own.vec_id)], atol=1e-12)
        hit += len(set(own.vec_id) & set(ids[true]))
        total += 5
    assert hit / total >= 0.95


def test_byte_bpe(spark, sf, docs):
    got = result(spark, sf, "op9_byte_bpe").sort_values("doc_id")
    enc = tokens.rank_encoding(RANKS, public_tokenizers.PATTERN)
    ids = [enc.encode_ordinary(t or "") for t in docs.text]
    assert got.n_tokens.tolist() == [len(x) for x in ids]
    assert got.ids_sha256.tolist() == [hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in ids]
    assert got.decoded_sha256.tolist() == [hashlib.sha256((t or "").encode()).hexdigest() for t in docs.text]


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def spans_text(spans):
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)


def test_base_secrets(spark, sf, docs):
    got = result(spark, sf, "op4_secrets").sort_values("doc_id")
    found = [base_spans(t or "") for t in docs.text]
    assert sum(map(len, found)) > 3
    for i, kind in enumerate(("n_assign", "n_access", "n_hex")):
        assert got[kind].tolist() == [sum(k == i for _, k, _ in s) for s in found]
    assert got.base_sha256.tolist() == [hashlib.sha256(spans_text(s).encode()).hexdigest() for s in found]
    for s, text in zip(found, got.spans):
        assert set(filter(None, spans_text(s).split(","))) <= set(text.split(","))


def test_quality(spark, sf):
    got = result(spark, sf, "op10_quality")
    labels = read(sf, "labels")
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]
    assert got.held_out.tolist() == held
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    judged = pd.merge(got[got.held_out], labels, on="doc_id")
    assert len(judged) > 50
    assert (judged.predicted == judged.quality).mean() >= 0.95
