"""Whole-table steps: column choice, gaps, filters and the step audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.roles import FILL_VALUE, numeric_columns


def drop_empty_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.na.drop("all", subset=list(features))


def fill_numeric(df: DataFrame, columns: Sequence[str] | None = None, value: float = FILL_VALUE) -> DataFrame:
    """Constant for gaps (null or NaN) of numeric columns; other columns keep theirs."""
    return df.na.fill(value, subset=numeric_columns(df, list(columns) if columns is not None else None))


def rename_known(df: DataFrame, names: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Only the columns of a feature dictionary (and ``keep``), under their new names."""
    return df.select(*keep, *[F.col(c).alias(names[c]) for c in df.columns if c in names])


def key_last(df: DataFrame, key: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != key], key)


def binary_target_rows(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isin(0, 1))


def held_out(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the first column of a key list (semi join, no duplicates)."""
    return df.join(keys.select(F.col(keys.columns[0]).alias(key)), key, "left_semi")


def with_split(df: DataFrame, split: DataFrame, key: str, label: str = "type") -> DataFrame:
    """Attach split labels by key; an existing label column is used as it is."""
    if label in df.columns:
        return df
    return df.join(split.select(key, label), key)


class Audit:
    """Row and column counts of each step, taken while the steps run instead of by extra jobs."""

    def __init__(self) -> None:
        self._steps: list[tuple[str, int, Observation]] = []

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        seen = Observation()
        self._steps.append((step, len(df.columns), seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def rows(self) -> list[tuple[int, str, int, int]]:
        """(order, step, rows, columns); call after an action ran over the watched frame."""
        return [(i, step, int(seen.get["rows"]), cols) for i, (step, cols, seen) in enumerate(self._steps)]
