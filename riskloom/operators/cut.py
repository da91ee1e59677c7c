"""Values to left-closed intervals: expressions only, so batch and stream alike."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.hist import as_number

INF = math.inf
MISSING_LABEL = "nan"


def edge_text(x: float) -> str:
    """Three decimals, or three significant digits below one."""
    if math.isinf(x):
        return "inf" if x > 0 else "-inf"
    return f"{x:.3g}" if abs(x) < 1 else f"{x:.3f}".rstrip("0").rstrip(".")


def interval_label(lo: float, hi: float) -> str:
    """Display text only; joins use the bin number."""
    return f"[{edge_text(lo)}, {edge_text(hi)})"


def interval_labels(edges: Sequence[float]) -> list[str]:
    """One label for each interval, no two alike: short ones, or all edges with as many digits as tell them apart."""
    edges = [float(e) for e in edges]
    labels = [interval_label(a, b) for a, b in zip(edges, edges[1:])]
    digits = 3
    while len(set(labels)) < len(labels) and digits < 17:
        digits += 1
        texts = [edge_text(e) if math.isinf(e) else f"{e:.{digits}g}" for e in edges]
        labels = [f"[{a}, {b})" for a, b in zip(texts, texts[1:])]
    return labels


def check_edges(edges: Sequence[float]) -> list[float]:
    edges = [float(e) for e in edges]
    if len(edges) < 2 or any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must be at least two strictly increasing numbers")
    return edges


def bin_number(value: Column, edges: Sequence[float]) -> Column:
    """0-based number of the interval holding ``value``; null when missing or outside."""
    edges = check_edges(edges)
    inner = F.lit(0)
    for e in edges[1:-1]:
        inner = inner + (value >= F.lit(e)).cast("int")
    known = value.isNotNull() & ~F.isnan(value)
    if edges[0] > -INF:
        known = known & (value >= F.lit(edges[0]))
    if edges[-1] < INF:
        known = known & (value < F.lit(edges[-1]))
    return F.when(known, inner)


def bin_label(value: Column, edges: Sequence[float]) -> Column:
    """Interval text; missing and outside values read 'nan'."""
    edges = check_edges(edges)
    names = F.array(*[F.lit(x) for x in interval_labels(edges)])
    return F.coalesce(F.get(names, bin_number(value, edges)), F.lit(MISSING_LABEL))


def cut_columns(df: DataFrame, edges: Mapping[str, Sequence[float]], labels: bool = False) -> DataFrame:
    """Replace each listed column by its bin number (or its label); other columns stay in place."""
    make = bin_label if labels else bin_number
    return df.withColumns({c: make(as_number(df, c), e) for c, e in edges.items()})
