"""The queries that have SQL against it, on the small tables and on planted groups."""

import duckdb
import numpy as np
import pytest

from riskloom.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "conversations")


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_sql_agree(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    res = con.execute(ORACLES[name])
    want = rows_of([d[0] for d in res.description], res.fetchall())
    df = QUERIES[name](spark, sf)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_groups_of_copies_and_chains(spark, tmp_path):
    """Chains of links, repeated texts, empty ones, and vectors linked in chains, null and odd ones."""
    words = [f"w{i}" for i in range(40)]
    chain = [" ".join(words[i : i + 30]) for i in range(8)]
    texts = [*chain, chain[0].upper(), "one", "One", "two words", "", None, " \n", "a b a b a b", "a b a"]
    docs = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rng = np.random.default_rng(1)
    base, side = rng.standard_normal((2, 16))
    vectors = [(i, (base + 0.12 * i * side).astype(np.float32).tolist(), 1) for i in range(12)]
    vectors += [(100 + i, v[1], 2) for i, v in enumerate(vectors)] + [(200, None, 1), (201, [0.0] * 16, 1), (202, vectors[0][1], None), (203, vectors[0][1], 1), (204, [1.0, None], 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    for name in ("op7_near_duplicates", "op8_near_vectors"):
        res = con.execute(ORACLES[name])
        want = rows_of([d[0] for d in res.description], res.fetchall())
        df = QUERIES[name](spark, str(tmp_path))
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
        assert any(not r[df.columns.index("kept")] for r in map(tuple, df.collect()))
