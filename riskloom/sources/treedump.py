"""Boosted trees as text: read a dump and score with it, or write one from a Spark model.

Format, one tree after another::

    booster[0]:
    0:[feature<threshold] yes=1,no=2,missing=2
    	1:leaf=-0.09
    	2:leaf=-0.11
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.hist import as_number

# Line patterns of the dump.
TREE_LINE = re.compile(r"booster\[(\d+)\]")
SPLIT_LINE = re.compile(r"(\d+):\[(.+)<([^\]]+)\] yes=(\d+),no=(\d+),missing=(\d+)")
LEAF_LINE = re.compile(r"(\d+):leaf=(\S+)")

# Splits compiled into one expression column, and in total, before tasks walk the trees instead.
COLUMN_SPLITS = 60
COMPILED_SPLITS = 1500


@dataclass(frozen=True)
class Node:
    feature: str | None = None
    threshold: float = 0.0
    yes: int = 0
    no: int = 0
    missing: int = 0
    leaf: float = 0.0


Tree = dict[int, Node]


def parse_dump(lines: Sequence[str]) -> list[Tree]:
    trees: list[Tree] = []
    for line in lines:
        line = line.strip()
        if TREE_LINE.match(line):
            trees.append({})
        elif m := SPLIT_LINE.match(line):
            trees[-1][int(m[1])] = Node(m[2], float(m[3]), int(m[4]), int(m[5]), int(m[6]))
        elif m := LEAF_LINE.match(line):
            trees[-1][int(m[1])] = Node(leaf=float(m[2]))
        elif line:
            raise ValueError(f"not a tree dump line: {line!r}")
    return trees


def read_dump(spark: SparkSession, path: str) -> list[Tree]:
    """The dump is the model itself, so it is read to the driver whole."""
    return parse_dump([line for r in spark.read.text(path, wholetext=True).collect() for line in r["value"].splitlines()])


def _compiled(tree: Tree, values: dict[str, Column], node: int = 0) -> Column:
    n = tree[node]
    if n.feature is None:
        return F.lit(n.leaf)
    x = values[n.feature]
    yes, no = _compiled(tree, values, n.yes), _compiled(tree, values, n.no)
    if n.missing == n.yes:
        return F.when((x < n.threshold) | x.isNull(), yes).otherwise(no)
    return F.when(x < n.threshold, yes).otherwise(no)  # null compares as unknown and goes on to no


def score_dump(df: DataFrame, trees: Sequence[Tree], out: str = "p", base_score: float = 0.5) -> DataFrame:
    """Append the probability: logistic of the summed leaves. Missing takes its own branch.

    Ordinary ensembles become column expressions, a few trees per intermediate column so that
    generated methods stay small; very large ones are walked in Arrow batches.
    """
    start = math.log(base_score / (1 - base_score))
    start += sum(t[0].leaf for t in trees if t[0].feature is None)
    grown = [t for t in trees if t[0].feature is not None]
    splits = [sum(n.feature is not None for n in t.values()) for t in grown]
    features = sorted({n.feature for t in grown for n in t.values() if n.feature is not None})
    if sum(splits) > COMPILED_SPLITS or any(s > COLUMN_SPLITS for s in splits):
        return _walk(df, grown, features, start, out)
    keep = df.columns
    values = {f: as_number(df, f) for f in features}
    groups: list[list[Tree]] = [[]]
    room = COLUMN_SPLITS
    for tree, size in zip(grown, splits):
        if size > room:
            groups.append([])
            room = COLUMN_SPLITS
        groups[-1].append(tree)
        room -= size
    partial = {
        f"m{i}__": sum((_compiled(t, values) for t in group), F.lit(0.0)) for i, group in enumerate(groups)
    }
    margin = sum((F.col(c) for c in partial), F.lit(start))
    return df.withColumns(partial).withColumn(out, 1 / (1 + F.exp(-margin))).select(*keep, out)


def _walk(df: DataFrame, trees: Sequence[Tree], features: list[str], start: float, out: str) -> DataFrame:
    spot = {f: i for i, f in enumerate(features)}
    packed = []
    for tree in trees:
        size = max(tree) + 1
        cols = np.full((6, size), 0.0)
        for i, n in tree.items():
            cols[:, i] = (-1 if n.feature is None else spot[n.feature], n.threshold, n.yes, n.no, n.missing, n.leaf)
        packed.append(cols)

    def margins(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        total = np.full(len(x), start)
        every = np.arange(len(x))
        for feature, threshold, yes, no, missing, leaf in packed:
            at = np.zeros(len(x), dtype=int)
            while (inner := feature[at] >= 0).any():
                v = x[every, np.where(inner, feature[at], 0).astype(int)]
                step = np.where(np.isnan(v), missing[at], np.where(v < threshold[at], yes[at], no[at]))
                at = np.where(inner, step, at).astype(int)
            total += leaf[at]
        return pd.Series(total)

    walk = F.pandas_udf(margins, "double")
    return df.withColumn(out, 1 / (1 + F.exp(-walk(*[as_number(df, f) for f in features]))))


def dump_lines(nodes: DataFrame, features: Sequence[str], scale: float = 2.0) -> list[str]:
    """Text of a fitted Spark ensemble from its node table (tree, weight, node, ...).

    Spark sends x <= t to the left and its probability is the logistic of twice the
    margin; the next double above t and a leaf scale of two say the same here.
    """
    lines: list[str] = []
    tree = None
    for r in sorted(nodes.collect(), key=lambda r: (r["tree"], r["node"])):  # the model itself
        if r["tree"] != tree:
            tree = r["tree"]
            lines.append(f"booster[{tree}]:")
        if r["feature_index"] is None or r["feature_index"] < 0:
            lines.append(f"{r['node']}:leaf={r['prediction'] * r['weight'] * scale!r}")
        else:
            t = math.nextafter(r["threshold"], math.inf)
            lines.append(
                f"{r['node']}:[{features[r['feature_index']]}<{t!r}] yes={r['left']},no={r['right']},missing={r['right']}"
            )
    return lines


def write_dump(spark: SparkSession, lines: Sequence[str], path: str) -> None:
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)
