"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import clear_scratch, scratch_path

# Bytes of text handled at once inside a task.
SLICE_BYTES = 4 << 20
# Rows of a keyed table of a few dozen bytes each that may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each with at most ``limit`` bytes of text or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Return freed memory to the system; Python workers live on between tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a counted narrow table; beyond the limit Spark shuffles both sides."""
    return F.broadcast(df) if rows <= limit else df


def broadcast_lists(df: DataFrame, rows: int, column: str, limit: int = 1_000_000) -> DataFrame:
    """Broadcast hint for a counted, stored table with a list column, by its list entries (of a few numbers each) and its rows."""
    if rows > limit:
        return df
    entries = df.agg(F.sum(F.size(column).cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if rows + entries <= limit else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores after it until ``df`` has no such column in any letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def running_start(df: DataFrame, order: str, value: str, out: str, width: int = 1024) -> DataFrame:
    """``out`` = sum of ``value`` over rows with a smaller ``order`` (a whole number, unique).

    Two levels: inside groups of ``width`` consecutive numbers, then over the groups,
    so that no task sees all rows.
    """
    grouped = df.withColumn("_g", F.floor(F.col(order) / width))
    inside = Window.partitionBy("_g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("_g").agg(F.sum(value).alias("_sum"))
    groups = groups.select("_g", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    return (
        grouped.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(groups, "_g")
        .withColumn(out, F.col("_own") + F.col("_before"))
        .drop("_g", "_own", "_before")
    )


def int32_lists(ids: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """Lists of token ids from one flat array; offsets need not start at 0."""
    part = ids[offsets[0] : offsets[-1]].astype(np.int32, copy=False)
    return pa.ListArray.from_arrays(pa.array((offsets - offsets[0]).astype(np.int32)), pa.array(part))


def flat_lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The other way round: (flat values, offsets starting at 0); lists must not be null."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    return values.to_numpy(zero_copy_only=False), offsets - offsets[0]


def hash_share(hashed: Column, share: float) -> Column:
    """Whether a 64-bit hash is among the largest ``share`` of all its values."""
    least = min(2**63 - 1, max(-(2**63), 2**63 - int(share * 2**64)))
    return hashed >= F.lit(least)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished phases.

    They go when the driver's JVM has collected the plans that made them; between the phases of a long job
    nothing else would make it do so.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def forget(made: DataFrame, *kept: DataFrame) -> None:
    """Delete the stored intermediate tables that ``made`` reads, but for those that ``kept`` read. Nothing may read them again."""
    own = scratch_path(made.sparkSession, "x").rpartition("/")[0]

    def folders(df: DataFrame) -> set[str]:
        return {name.rpartition("/")[0] for name in df.inputFiles()}

    for folder in folders(made).difference(*map(folders, kept)):
        name = folder.rpartition("/")[2]
        if folder.endswith(f"{own.rpartition('/')[2]}/{name}"):
            clear_scratch(made.sparkSession, f"{own}/{name}")
