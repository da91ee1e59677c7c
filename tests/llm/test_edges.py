"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns in every query."""

import pytest

import corpus_pipeline
from riskloom.llm.queries import QUERIES

LONG = "Word one follows word two in a long text. " * 3000
PASSAGE = " ".join(f"Sentence {i} of the shared passage has seven words." for i in range(9))


def documents():
    rows = [
        (None, "A text without an id, password=abcdef12 in it.", "en"), (1, None, None), (2, "", "en"), (3, " \n\t ", "en"),
        (4, "one", "en"), (5, "one", "en"), (6, LONG, "en"), (7, "Own start. " + PASSAGE, "en"), (8, "Other start. " + PASSAGE, "en"),
        (8, "Other start. " + PASSAGE, "en"), (9, "THESE!! ARE!! JUNK!! WORDS!!", "en"), (10, "token = \"" + "0123456789abcdef" * 3 + "\" é🙂", "en"),
    ]
    return [(i, t, lang, "s", len(t or ""), 0, 1.0, 7) for i, t, lang in rows]


DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids int, score double, row int"
VECTORS = "vec_id long, embedding array<float>, label int, n int, leaf int, cls int"
TURNS = "conv_id long, turn long, role string, text string, part int, place int"


def vectors():
    rows = [(i, [float(i % 3 + 1), float(i % 2), 0.5], i % 2) for i in range(60)]
    rows += [(100, None, 1), (101, [0.0, 0.0, 0.0], 1), (102, [1.0, None, 2.0], 1), (103, [float("nan"), 1.0, 2.0], 1), (104, [1.0, 0.0, 0.5], None)]
    rows += [(0, [1.0, 0.0, 0.5], 0), (None, [1.0, 0.0, 0.5], 0), (150, [1.0, 2.0], 0)]
    return [(i, v, label, 1, 2, 3) for i, v, label in rows]


def turns():
    rows = [(1, 0, "a", "x"), (1, 1, "b", None), (1, 1, "b", None), (1, None, None, "z"), (None, 0, "a", "q"), (2, 0, "system", "only")]
    return [(*r, 0, 0) for r in rows]


@pytest.fixture(scope="module", params=["rows", "empty"])
def folder(spark, request, tmp_path_factory):
    out = str(tmp_path_factory.mktemp(request.param))
    full = request.param == "rows"
    labels = [(i, int(i != 9), 0) for i in range(20)] + [(None, 1, 0), (4, None, 0)]
    tables = {
        "documents": (documents(), DOCS), "embeddings": (vectors(), VECTORS), "conversations": (turns(), TURNS),
        "labels": (labels, "doc_id long, quality int, toxic int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows if full else [], schema).write.parquet(f"{out}/{name}.parquet")
    return out, full


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_defined_results(spark, folder, name):
    path, full = folder
    rows = QUERIES[name](spark, path).collect()
    if not full:
        assert rows == []
        return
    per_row = {"op1_substring_dedup", "op2_packed_ids", "op4_secrets", "op7_near_duplicates", "op9_byte_bpe", "op10_quality"}
    if name in per_row:
        assert len(rows) == len(documents())
    if name == "op1_substring_dedup":
        cut = {r["doc_id"]: r["n_removed"] for r in rows}
        assert cut[8] > 3 and cut[7] == 0 and cut[4] == 0
    if name == "op2_packed_ids":
        assert [r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    if name == "op4_secrets":
        assert {r["doc_id"]: r["n_assign"] for r in rows} | {6: 0} == {r["doc_id"]: int(r["doc_id"] in (None, 10)) for r in rows}
    if name == "op5_perspectives":
        assert {(r["conv_id"], r["participant"]): r["n_turns"] for r in rows} == {(1, "a"): 4, (1, "b"): 4, (1, "unknown"): 4, (None, "a"): 1}
    if name == "op7_near_duplicates":
        named = {r["doc_id"]: r["component_id"] for r in rows}
        assert named[5] == 4 and named[8] == 7 and named[2] == 2 and named[1] == 1
    if name == "op8_near_vectors":
        alone = {r["vec_id"]: r["n_links"] for r in rows}
        assert len(rows) == len(vectors()) and [alone[i] for i in (100, 101, 102, 103, 104)] == [0] * 5
    if name == "op3_nearest":
        assert {r["query_id"] for r in rows} == {0, 50} and all(r["vec_id"] not in (100, 101, 102, 103) for r in rows)


def test_pipeline(spark, folder):
    path, full = folder
    rows = corpus_pipeline.run(spark, path).collect()
    assert bool(rows) == full
