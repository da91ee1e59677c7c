"""Connected components by contraction, without gathering a component anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace a partition's edges by one edge from each node to the smallest node that it reaches there."""
    parent: dict = {}

    def root(x):
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(x) for x in part], kind)], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id reachable.

    Each round lets every node follow its smallest neighbour, contracts the edges to the nodes followed
    and drops what has become one node; a partition's edges are first reduced to a forest there. Rounds go on
    until no edge is left. Every round is stored in the shared folder.
    """
    kind = dict(edges.dtypes)["a"]
    rows = edges.select("a", "b").where("a <> b")
    left, n = materialize(rows.mapInArrow(_forest, f"a {kind}, b {kind}"), "edges")
    spark = edges.sparkSession
    label = spark.createDataFrame([], f"id {kind}, component {kind}")
    first = True
    while n:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        follow = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("to"))
        follow, _ = materialize(_jump(_jump(follow)), "follow")
        if first:
            label, first = follow.select("id", F.col("to").alias("component")), False
        else:
            moved = follow.select(F.col("id").alias("component"), "to")
            label, _ = materialize(
                label.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component")),
                "labels",
            )
        a, b = (follow.select(F.col("id").alias(c), F.col("to").alias(f"{c}{c}")) for c in "ab")
        moved = left.join(a, "a").join(b, "b").where("aa <> bb").select(F.col("aa").alias("a"), F.col("bb").alias("b"))
        left, n = materialize(moved.distinct().mapInArrow(_forest, f"a {kind}, b {kind}"), "edges")
    return label


def _jump(follow: DataFrame) -> DataFrame:
    """Follow once more. A node that is followed is always in the table, too."""
    then = follow.select(F.col("id").alias("to"), F.col("to").alias("then"))
    return follow.join(then, "to").select("id", F.col("then").alias("to"))
