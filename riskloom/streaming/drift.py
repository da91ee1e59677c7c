"""Stability of a number over event time, kept up to date by a stream.

Rows are counted per window of event time and bin in the state store; a watermark says how late a row may be. Every micro-batch writes the
counts it changed into a folder of its own, named after the batch, so a batch that is repeated after a failure replaces its folder and nothing is
counted twice. The report takes the latest count of each window and bin, open windows included, and compares shares with those of a base.
Rows later than the watermark allows are left out by Spark; rows without time have no window; rows without value form a bin of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.scoring import psi_term
from riskloom.operators.cut import bin_number
from riskloom.operators.hist import as_number

COUNTS = "started timestamp, bin int, n bigint, batch bigint"


def window_counts(df: DataFrame, time: str, value: str, edges: Sequence[float], width: str, delay: str | None = None) -> DataFrame:
    """(started, bin, n) of a table or a stream; ``delay`` is how late a row of a stream may come."""
    rows = df.select(F.col(time).cast("timestamp").alias("time__"), bin_number(as_number(df, value), edges).alias("bin"))
    if delay is not None:
        rows = rows.withWatermark("time__", delay)
    counts = rows.groupBy(F.window("time__", width).alias("w"), "bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("started"), "bin", "n")


def follow_counts(counts: DataFrame, folder: str) -> StreamingQuery:
    """Run the stream over what has arrived; a later run goes on where this one ended."""

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/counts/batch={batch}")

    return (
        counts.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(write).start()
    )


def latest_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(started, bin, n): the count of each window and bin after the last batch that changed it."""
    stored = spark.read.schema(COUNTS).parquet(f"{folder}/counts")
    return stored.groupBy("started", "bin").agg(F.max_by("n", "batch").alias("n"))


def window_psi(counts: DataFrame, base: DataFrame) -> DataFrame:
    """(started, n, psi) of window counts (started, bin, n) against base counts (bin, n); bins on one side only add nothing."""
    # One row per bin, and one in all.
    total = base.agg(F.sum("n").alias("all"))
    shares = base.crossJoin(F.broadcast(total)).select(F.col("bin").alias("b"), (F.col("n") / F.col("all")).alias("base_share"))
    sizes = counts.groupBy("started").agg(F.sum("n").alias("size"))
    met = counts.join(sizes, "started").join(F.broadcast(shares), F.col("bin").eqNullSafe(F.col("b")), "left")
    term = psi_term(F.col("n") / F.col("size"), F.col("base_share"))
    return met.groupBy("started").agg(F.max("size").alias("n"), F.coalesce(F.sum(term), F.lit(0.0)).alias("psi"))
