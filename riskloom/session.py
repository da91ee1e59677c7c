"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; sizing stays with the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call sites are not recorded for every column expression: building plans gets much cheaper.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # The JVM never compiles methods above 8,000 bytes. Expressions over hundreds of columns or
        # trees exceed that when a whole stage is one method; this lets Spark split them instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own. On a
    cluster a machine-local folder would be lost with its executor, so a missing
    setting is an error there.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running this job")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{workspace(spark)}/riskloom/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession, folder: str | None = None) -> bool:
    """Delete the intermediate tables of this application, once its results are written elsewhere."""
    own = _own_folder(spark)
    target = folder or own
    if not target.startswith(own):
        raise ValueError(f"{target} is not an intermediate table of this application")
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` once to the shared folder and return the stored table and its row count.

    Cuts the lineage, survives lost executors, and keeps column pruning and
    filter pushdown for the passes that follow. The count comes with the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(seen.get["rows"])
