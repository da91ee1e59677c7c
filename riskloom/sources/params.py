"""Encoding and bin parameters as tables, with the JSON files other tools read and write."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.binning import Binning, edge_table
from riskloom.operators.cut import MISSING_LABEL, interval_label, interval_labels
from riskloom.operators.woe import OTHER, UNSEEN, woe_by_bin
from riskloom.session import materialize

# File names.
CATEGORY_FILE = "category_var_value_woe.json"
CATEGORY_TABLE = "categories"
SETTINGS_FILE = "settings.json"
BIN_WOE_FILE = "continuous_var_bin_woe_dict.json"
BIN_EDGE_FILE = "continuous_bins_dict.json"
# Layout of the bin tables: 2 has exact edges, a key that ties evidence to its edges, and this number.
BIN_FORMAT = 2
# Entries in one file of a JSON document that goes into several.
FILE_ENTRIES = 1_000_000


def write_json(spark: SparkSession, value: object, path: str) -> None:
    """One JSON document as a text folder on the session's file system."""
    text = json.dumps(value, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    """One JSON document, from a plain file or a text folder."""
    return json.loads("".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def categories_to_json(table: DataFrame, folder: str) -> None:
    """(feature, key, woe) to {feature: {category: woe}}, one entry a line; a real category named 'other' gives way to the unseen entry.

    The lines are sorted and written by Spark, so a dictionary may have any size. One of more than FILE_ENTRIES entries goes into several files
    that make up the document in the order of their names.
    """
    kept = table.select("feature", "key", "woe").groupBy("feature", F.when(F.col("key") == UNSEEN, OTHER).otherwise(F.col("key")).alias("name")).agg(
        F.max(F.struct((F.col("key") == UNSEEN).alias("unseen"), "woe")).alias("one")
    )
    kept = kept.select("feature", "name", F.col("one.unseen").cast("int").alias("place"), F.col("one.woe").alias("woe"))

    def quoted(column: str):
        text = F.to_json(F.struct(F.col(column).alias("k")))  # {"k":"..."}
        return F.substr(text, F.lit(6), F.length(text) - 6)

    # One row per feature.
    heads = kept.groupBy("feature").agg(F.min(F.struct("place", "name")).alias("first"), F.count(F.lit(1)).alias("n"))
    heads, n_features = materialize(heads, "dictionary-features")
    total = heads.agg(F.sum("n"), F.min("feature")).first()
    n, lowest = total[0] or 0, total[1]
    number = F.when(F.col("woe").isNull() | F.isnan("woe"), F.lit("null")).otherwise(F.col("woe").cast("string"))
    entries = kept.join(heads, "feature").select(
        "feature", F.col("place").alias("kind"), "name",
        F.concat(F.when(F.struct("place", "name") == F.col("first"), "").otherwise(","), quoted("name"), F.lit(": "), number).alias("value"),
    )
    opened = heads.select(
        "feature", F.lit(-1).alias("kind"), F.lit("").alias("name"), F.concat(F.when(F.col("feature") == lowest, "").otherwise("},"), quoted("feature"), F.lit(": {")).alias("value")
    )
    lines = entries.unionByName(opened)
    files = max(1, -(-n // FILE_ENTRIES))
    ends = table.sparkSession.createDataFrame([(0, "{"), (2, "}}" if n_features else "}")], "part int, value string")
    lines = lines.withColumn("part", F.lit(1)).unionByName(ends.selectExpr("part", "'' AS feature", "0 AS kind", "'' AS name", "value"))
    order = ["part", "feature", "kind", "name"]
    ranged = lines.repartitionByRange(files, *order) if files > 1 else lines.coalesce(1)
    ranged.sortWithinPartitions(*order).select("value").write.mode("overwrite").text(f"{folder}/{CATEGORY_FILE}")


def write_categories(table: DataFrame, folder: str) -> None:
    """The stored dictionary as a table, and as the JSON document that other tools read."""
    table.select("feature", "key", "woe").write.mode("overwrite").parquet(f"{folder}/{CATEGORY_TABLE}")
    categories_to_json(table, folder)


def read_categories(spark: SparkSession, folder: str) -> DataFrame:
    """(feature, key, woe) from the table, or from the JSON of a folder made elsewhere."""
    try:
        return spark.read.parquet(f"{folder}/{CATEGORY_TABLE}")
    except AnalysisException:
        return categories_from_json(spark, folder)


def write_settings(spark: SparkSession, settings: dict, folder: str) -> None:
    write_json(spark, settings, f"{folder}/{SETTINGS_FILE}")


def read_settings(spark: SparkSession, folder: str) -> dict | None:
    """How the model's rows are encoded; None for folders that do not say."""
    try:
        return read_json(spark, f"{folder}/{SETTINGS_FILE}")
    except AnalysisException:
        return None


def categories_from_json(spark: SparkSession, folder: str) -> DataFrame:
    """{feature: {category: woe}} as (feature, key, woe), parsed by Spark.

    A document of several files is put together on the driver: for exchange, while our own jobs read the table.
    """
    text = spark.read.text(f"{folder}/{CATEGORY_FILE}", wholetext=True)
    files = text.select("value", F.input_file_name().alias("name"))
    if files.count() > 1:
        whole = "".join(r["value"] for r in files.orderBy("name").collect())
        text = spark.createDataFrame([(whole,)], "value string")
    parsed = text.select(F.from_json("value", "map<string, map<string, double>>").alias("m"))
    flat = parsed.select(F.explode("m").alias("feature", "entries")).select("feature", F.explode("entries").alias("key", "woe"))
    return flat.withColumn("key", F.when(F.col("key") == OTHER, F.lit(UNSEEN)).otherwise(F.col("key")))


def bins_to_json(spark: SparkSession, binning: Binning, folder: str) -> None:
    """Edges, and {feature: {label: woe}} in bin order, for exchange; labels have as many digits as tell the bins apart."""
    woe = woe_by_bin(binning.summary)
    labelled: dict[str, dict[str, float | None]] = {}
    for feature, edges in binning.edges.items():
        names = interval_labels(edges)
        entries = {names[i]: woe[feature][i] for i in range(len(names)) if i in woe.get(feature, {})}
        if None in woe.get(feature, {}):
            entries[MISSING_LABEL] = woe[feature][None]
        labelled[feature] = entries
    write_json(spark, binning.edges, f"{folder}/{BIN_EDGE_FILE}")
    write_json(spark, labelled, f"{folder}/{BIN_WOE_FILE}")


def bins_from_json(
    spark: SparkSession, folder: str
) -> tuple[dict[str, list[float]], dict[str, dict[int | None, float | None]]]:
    """Edges and {feature: {bin_id: woe}}. Labels are matched through the edges, not parsed.

    A file made elsewhere may give narrow bins one and the same short label; what such a label stands for is lost,
    and so is a label that no bin has. Both raise ValueError.
    """
    edges = {f: [float(x) for x in e] for f, e in read_json(spark, f"{folder}/{BIN_EDGE_FILE}").items()}
    labelled = read_json(spark, f"{folder}/{BIN_WOE_FILE}")
    woe: dict[str, dict[int | None, float | None]] = {}
    for feature, e in edges.items():
        entries = labelled.get(feature, {})
        texts = set(entries) - {MISSING_LABEL}
        names = interval_labels(e)
        if not texts <= set(names):
            names = [interval_label(a, b) for a, b in zip(e, e[1:])]
            if len(set(names)) < len(names):
                raise ValueError(f"labels of {feature} do not tell its bins apart")
        if strange := texts - set(names):
            raise ValueError(f"{feature} has no bins named {sorted(strange)}")
        found = {i: entries[name] for i, name in enumerate(names) if name in entries}
        if MISSING_LABEL in entries:
            found[None] = entries[MISSING_LABEL]
        woe[feature] = found
    return edges, woe


def _edge_key(edges: Sequence[float]) -> str:
    return hashlib.md5(",".join(float(e).hex() for e in edges).encode()).hexdigest()


def write_bins(spark: SparkSession, binning: Binning, folder: str) -> None:
    """Edges and evidence as Parquet tables: every bound bit by bit, bins by number, both tied by a key of the edges."""
    keys = spark.createDataFrame([(f, _edge_key(e)) for f, e in binning.edges.items()], "feature string, edge_key string")
    edges = edge_table(spark, binning.edges).withColumn("format", F.lit(BIN_FORMAT)).join(F.broadcast(keys), "feature")
    edges.coalesce(1).write.mode("overwrite").parquet(f"{folder}/edges")
    binning.summary.join(F.broadcast(keys), "feature").write.mode("overwrite").parquet(f"{folder}/evidence")


def read_bins(spark: SparkSession, folder: str) -> Binning:
    """Refuses tables of a later layout, and evidence that was computed for other edges."""
    table = spark.read.parquet(f"{folder}/edges")
    rows = table.collect()  # one per feature
    evidence = spark.read.parquet(f"{folder}/evidence")
    edges = {r["feature"]: list(r["edges"]) for r in rows}
    if "format" not in table.columns:
        return Binning(edges, evidence)
    if later := {r["format"] for r in rows} - set(range(1, BIN_FORMAT + 1)):
        raise ValueError(f"bins of layout {sorted(later)}, this version reads up to {BIN_FORMAT}")
    known = {r["feature"]: r["edge_key"] for r in evidence.select("feature", "edge_key").distinct().collect()}
    if other := sorted(f for f, e in edges.items() if known.get(f) != _edge_key(e)):
        raise ValueError(f"the evidence of {other} belongs to other edges")
    return Binning(edges, evidence.drop("edge_key"))


def finite(edges: Mapping[str, Sequence[float]]) -> dict[str, list[float]]:
    """Inner edges only."""
    return {f: [x for x in e if not math.isinf(x)] for f, e in edges.items()}
