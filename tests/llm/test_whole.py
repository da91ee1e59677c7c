"""Cases that a shortcut would lose, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_contracts import groups, shingles, similar_pairs

import corpus_pipeline
from riskloom.llm import bottomk, kmeans_tree, projection_passes, substring_dedup
from riskloom.session import materialize


def test_pairs_whose_lists_have_another_first_class(spark):
    """Short texts of frequent shingles: an unlike class often heads every list that a pair shares."""
    rng = random.Random(5)
    texts = []
    for _ in range(700):
        words = [f"w{rng.randrange(40)}" for _ in range(20)]
        texts.append(" ".join(words))
        if rng.random() < 0.3:
            texts.append(" ".join([*words[:-1], f"w{rng.randrange(40)}"]))
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in bottomk.near_duplicates(df, words=2).collect()}
    names = groups(len(texts), similar_pairs([shingles(t, 2) for t in texts]))
    assert [got[i] for i in range(len(texts))] == names
    assert sum(i != x for i, x in enumerate(names)) > 150


def test_dense_label(spark):
    """One label whose vectors are all at a cosine of about 0.95, with pairs above the threshold among them."""
    rng = np.random.default_rng(3)

    def around(base, cosine):
        turn = rng.standard_normal(base.shape)
        turn -= (turn * base).sum(axis=1)[:, None] * base
        turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
        return cosine * base + np.sqrt(1 - cosine**2) * turn

    middle = rng.standard_normal((1, 64))
    middle /= np.sqrt((middle * middle).sum())
    v = around(np.repeat(middle, 1500, axis=0), np.sqrt(0.95))
    v = np.concatenate([v, around(v[:600], 0.983)])
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in projection_passes.near_vectors(df).collect()}
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    near = v @ v.T >= 0.98
    np.fill_diagonal(near, False)
    assert [got[i]["n_links"] for i in range(len(v))] == near.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(len(v))] == groups(len(v), np.argwhere(near).tolist())


@pytest.mark.parametrize("size", [50, 60, 200])
def test_passages_without_punctuation_at_every_phase(spark, size):
    """A passage behind lead-ins of 0 to 40 other words, all of them in one sentence, and followed by other words."""
    rng = random.Random(size)

    def words(n, kind):
        return [f"{kind}{rng.randrange(10**6)}" for _ in range(n)]

    passage = words(size, "p")
    texts = [" ".join([*words(30, "a"), *passage, *words(30, "b")])]
    texts += [" ".join([*words(lead, "a"), *passage, *words(9, "b")]) for lead in range(41)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(df).collect()}
    assert got[0] == texts[0]
    for i in range(1, len(texts)):
        left = got[i].split()
        assert sum(w in passage for w in left) < 50, i
        assert [w for w in left if w[0] != "p"] == [w for w in texts[i].split() if w[0] != "p"]


def test_sentences_make_up_the_text():
    rng = random.Random(1)
    for n in range(300):
        text = "".join(rng.choice(["ha ", "Word ", "\u00a0x\t", "end. ", "\n", " \u0130 ", "y", "  "]) for _ in range(n))
        parts = substring_dedup.sentences(text)
        assert "".join(parts) == text and all(parts)


def test_one_row_of_each_group_of_copies(spark):
    """Repeated rows, null ids, one id with two linked texts, a hot id; rows without words stay."""
    base = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcdef"}
    rows = [(1, base["a"], 0), (1, base["a"], 0), (1, base["a"], 1), (2, base["a"], 0)]
    rows += [(None, base["b"], 0), (None, base["b"], 0), (None, base["b"] + " x", 0)]
    rows += [(3, base["c"], 0), (3, base["c"] + " x", 0)]
    rows += [(4, base["d"], i) for i in range(50)]
    rows += [(5, base["e"], 0), (5, base["f"], 0), (None, base["f"], 0)]
    rows += [(6, "", 0), (6, "", 0), (None, None, 0), (7, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    left = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    kept = sorted(((r["doc_id"] or 0, r["text"][0], r["row"]) for r in left if r["text"]))
    assert kept == [(0, "b", 0), (1, "a", 0), (3, "c", 0), (4, "d", 0), (5, "e", 0), (5, "f", 0)]
    assert sorted((r["doc_id"] or 0, r["text"] is None) for r in left if not r["text"]) == [(0, True), (6, False), (6, False), (7, True)]


def test_nearest_of_every_length(spark):
    """A stray length in the first row, two lengths, and an id that many rows repeat beside one leaf's worth of others."""
    rng = np.random.default_rng(8)
    rows = [(0, [1.0, 2.0])] + [(i, rng.standard_normal(8).tolist()) for i in range(1, 200)]
    rows += [(i, rng.standard_normal(5).tolist()) for i in range(200, 260)]
    middle = rng.standard_normal(8)
    rows += [(1000, (middle + 1e-3 * rng.standard_normal(8)).tolist()) for _ in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = kmeans_tree.TreeIndex(df)
    asked = kmeans_tree.usable(df).where("vec_id IN (0, 10, 210, 1000)")
    got = {}
    for r in index.search(asked, recall=0.0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert {q: len(x) for q, x in got.items()} == {10: 5, 210: 5, 1000: 5}
    length = {i: len(v) for i, v in rows}
    assert all(length[i] == length[q] and i != q for q, x in got.items() for _, i in x)


def brute(ids, vectors, asked, k=5):
    """(rank, vec_id) of the k nearest of other ids to each asked id, equal scores by the smaller id."""
    out = {}
    for q in asked:
        query = vectors[np.flatnonzero(ids == q)[0]]
        score = (vectors * query).sum(axis=1) / np.sqrt((vectors * vectors).sum(axis=1) * (query * query).sum())
        rows = np.flatnonzero(ids != q)
        out[int(q)] = ids[rows[np.lexsort((ids[rows], -score[rows]))[:k]]].tolist()
    return out


@pytest.mark.parametrize(("kind", "pairs"), [("float", 1), ("double", 1 << 34)])
def test_nearest_queries_are_not_copied_for_each_leaf(spark, monkeypatch, kind, pairs):
    """Spread directions, so that most leaves are visited: one stored row a query; right answers over many shelves, pieces and rounds."""
    rng = np.random.default_rng(12)
    vectors = rng.standard_normal((3000, 16)).astype(np.float32).astype(float)
    vectors[::3][:700] = vectors[0]  # a leaf of copies, cut into pieces; equal scores go by the smaller id
    ids = np.arange(3000)
    df = spark.createDataFrame(list(zip(ids.tolist(), vectors.tolist())), f"vec_id long, embedding array<{kind}>")
    stored = {}

    def keep(df, label):
        made, rows = materialize(df, label)
        stored.setdefault(label, []).append(rows)
        return made, rows

    monkeypatch.setattr(kmeans_tree, "materialize", keep)
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 64, raising=False)
    monkeypatch.setattr(kmeans_tree, "SHELF_ROWS", 128, raising=False)
    monkeypatch.setattr(kmeans_tree, "COPY_BYTES", 96_000, raising=False)
    monkeypatch.setattr(kmeans_tree, "COPIES", 0, raising=False)
    monkeypatch.setattr(kmeans_tree, "EARLY_PAIRS", pairs, raising=False)
    asked = ids[::20]
    got = {}
    for r in kmeans_tree.TreeIndex(df).search(kmeans_tree.usable(df).where("vec_id % 20 = 0"), recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert stored["visits"] == [len(asked)] and len(stored["found"]) > 1
    assert sum(stored.get("early", [])) == 5 * len(asked) * (pairs == 1)
    assert got == brute(ids, vectors, asked)


def test_nearest_of_a_shelf(monkeypatch):
    """Blocks smaller than leaves: hidden leaves, own ids that repeat, equal scores, vectors too short to have a length, no rows at all."""
    monkeypatch.setattr(kmeans_tree, "BLOCK", 16)
    rng = np.random.default_rng(13)
    slots = np.repeat([4, 5, 6], [30, 3, 50])
    vectors = rng.standard_normal((83, 6))
    vectors[40:70] = vectors[3]
    vectors[35] = 1e-300
    ids = np.where(np.arange(83) % 7 == 0, 1000, np.arange(83))
    asked, queries = np.append(np.arange(39), 1000), np.concatenate([vectors[:39], vectors[:1]])
    seen = np.array([[i % 2 == 0, i % 3 > 0, i % 5 > 0] for i in range(40)])
    bits = [x.tobytes() for x in np.packbits(seen, axis=1)]

    def batch(shelf, slot, ids, vectors, seen):
        return pa.RecordBatch.from_pydict({
            "shelf": pa.array(np.full(len(ids), shelf, np.int32)), "slot": pa.array(np.array(slot, np.int32)), "id": pa.array(ids),
            "vec": pa.array(vectors.tolist(), pa.list_(pa.float64())), "seen": pa.array(seen, pa.binary()),
            "floor": pa.array([floor.get(i) for i in ids.tolist()], pa.float64()),
        })

    asks = np.full(40, kmeans_tree.ASKING)
    floor = {3: 1.0}
    rows = batch(1, slots, ids, vectors, [None] * 83)
    come = [batch(0, asks[:1], asked[:1], queries[:1], [b"\x80"]), rows.slice(0, 31), rows.slice(31), batch(1, asks, asked, queries, bits)]
    got = {}
    for out in kmeans_tree._answers(iter(come), 5, np.array([0, 4, 7])):
        for q, v, score in zip(*(c.to_pylist() for c in out.columns)):
            got.setdefault(q, []).append((-score, v))
    for i, q in enumerate(asked):
        fine = seen[i, slots - 4] & (ids != q) & (np.arange(83) != 35)
        v = vectors[fine]
        score = (v * queries[i]).sum(axis=1) / np.sqrt((v * v).sum(axis=1) * (queries[i] * queries[i]).sum())
        best = [(x, v) for x, v in sorted(zip((-score).tolist(), ids[fine].tolist())) if q != 3 or x < -1 + 1e-9][:5]
        assert i == 35 or sorted(got.get(q, [])) == best
    assert 35 not in got


def test_first_leaves_are_those_of_the_queue():
    rng = np.random.default_rng(14)
    units = kmeans_tree.unit(rng.standard_normal((2000, 8)))
    for rows in (2000, 5):
        tree = kmeans_tree.fit_tree(units[:rows], 16)
        sizes, paths = np.bincount(tree.assign(units), minlength=tree.n_leaves), tree.paths()
        for query in units[:60]:
            visits, enough = int(rng.integers(1, tree.n_leaves + 1)), int(rng.integers(1, 600))
            due, held = [], 0
            for n, leaf in enumerate(tree.best_first(query)):
                if n >= visits and held >= enough:
                    break
                due.append(leaf)
                held += sizes[leaf]
            assert sorted(tree.first_leaves(tree.centres @ query, paths, visits, enough, sizes)) == sorted(due)


def test_windows_in_key_order():
    """At least WINDOW rows on inside a label, and as far as the prefix is shared; never into another label, pass or part."""
    rows = [(1, 2, "a", 5, 0, 0, 0)] * 4 + [(1, 2, "a", 6, 0, 0, 0)] + [(1, 2, "b", 6, 0, 0, 0)] * 2 + [(2, 2, "b", 1, 0, 0, 0)] * 9
    rows += [(2, 2, "c", 1, 0, 1, 0)] * 3 + [(2, 2, "c", 1, 0, 2, 0)] * 2
    names = ["pass", "dim", "label", "prefix", "one", "two", "side"]
    batch = pa.RecordBatch.from_pydict({c: [r[i] for r in rows] for i, c in enumerate(names)})
    ends = projection_passes.window_ends(batch, 2).tolist()
    assert ends[:7] == [4, 4, 5, 5, 5, 7, 7] and ends[7:16] == [16] * 9 and ends[16:] == [19] * 3 + [21] * 2


@pytest.mark.parametrize("batch_rows", [7, 50, 10_000])
def test_windows_across_batches(batch_rows):
    """Verified pairs join the same rows however the sorted rows are cut into batches."""
    rng = np.random.default_rng(5)
    v = rng.standard_normal((300, 16))
    v = np.concatenate([v, v + 0.02 * rng.standard_normal(v.shape)])
    table = pa.table({"vec": v.tolist(), "cls": [i.to_bytes(4, "big") for i in range(600)], "label": ["x", "y"] * 300, "whole": [False] * 600})
    keyed = projection_passes._keys(iter(table.to_batches()), 12, 4, True)
    rows = pa.Table.from_batches(list(keyed))
    for c in ("one", "two", "side"):
        rows = rows.append_column(c, pa.array(np.zeros(len(rows), np.int32)))
    rows = rows.sort_by([(c, "ascending") for c in ("pass", "dim", "label", "prefix", "key")]).combine_chunks()
    found = projection_passes._near(iter(rows.to_batches(max_chunksize=batch_rows)), 0.98, 8)
    pairs = [(int.from_bytes(a, "big"), int.from_bytes(b, "big")) for r in found for a, b in zip(r.column("a").to_pylist(), r.column("b").to_pylist())]
    u = v / np.sqrt((v * v).sum(axis=1))[:, None]
    near = (u @ u.T >= 0.98) & (np.arange(600)[:, None] % 2 == np.arange(600) % 2)
    np.fill_diagonal(near, False)
    assert groups(600, pairs) == groups(600, np.argwhere(near).tolist()) and near.sum() > 200


def test_labels_of_text_and_dense_labels_without_links(spark):
    rng = np.random.default_rng(2)
    middle = rng.standard_normal(32)
    rows = [(i, (middle + 0.3 * rng.standard_normal(32)).tolist(), "dense") for i in range(500)]
    rows += [(1000 + i, (middle * (1 + i)).tolist(), ["one", "two"][i % 2]) for i in range(6)] + [(2000, [1e300, 1e300], "big"), (2001, [1e299, 1e299], "big")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in projection_passes.near_vectors(df).collect()}
    assert [got[1000 + i] for i in range(6)] == [(2, 1000), (2, 1001)] * 3
    v = np.array([r[1] for r in rows[:500]])
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    near = v @ v.T >= 0.98
    np.fill_diagonal(near, False)
    assert [got[i][0] for i in range(500)] == near.sum(axis=1).tolist()
    assert got[2001] == (1, 2000)


def test_passes_over_spread_vectors(spark, monkeypatch):
    """A large label of spread directions goes through the sorted passes and loses no link; prefixes held by many are dealt into parts."""
    rng = np.random.default_rng(12)
    v = rng.standard_normal((3000, 48))
    turn = rng.standard_normal((700, 48))
    v = np.concatenate([v, v[:700] + 0.19 * turn * np.sqrt((v[:700] ** 2).sum(axis=1) / (turn**2).sum(axis=1))[:, None]])
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    near = v @ v.T >= 0.98
    np.fill_diagonal(near, False)
    assert near.sum() > 900
    for part in (projection_passes.PART, 12):
        monkeypatch.setattr(projection_passes, "PART", part)
        got = {r["vec_id"]: r for r in projection_passes.near_vectors(df).collect()}
        assert [got[i]["n_links"] for i in range(len(v))] == near.sum(axis=1).tolist()
        assert [got[i]["component_id"] for i in range(len(v))] == groups(len(v), np.argwhere(near).tolist())
    spread = projection_passes._whole_labels(df.selectExpr("cast(vec_id AS string) AS cls", "'1' AS label", "embedding AS vec"), 18, 9)
    assert spread.where("whole").count() == 0
