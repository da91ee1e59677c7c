"""Scoring of arriving rows with saved parameters.

The apply side (cut, lookup, scaling, tree scoring) is made of row-wise expressions, so
the batch functions take a streaming frame unchanged; this module only adds the source
and the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_arrivals(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def write_scored(scored: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append to Parquet, processing what is there and stopping; files and offsets commit together.

    The state lies beside the output unless given, so a later run goes on where this one ended.
    """
    checkpoint = checkpoint or f"{path.rstrip('/')}-state"
    return (
        scored.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
