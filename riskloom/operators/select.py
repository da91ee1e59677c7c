"""Feature screens: missing rate, column types, correlation and evidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.hist import as_number, known
from riskloom.operators.moments import tiled_corr
from riskloom.session import materialize

# Expressions per aggregate: beyond this the generated code gets too long.
CHUNK = 500
# Most pairs of columns in one built-in aggregate.
PAIRS = 100
CORR_FILL = -999.0


def _chunks(items: list, size: int = CHUNK):
    return [items[i : i + size] for i in range(0, len(items), size)]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, blanks, size): one wide aggregate for each few hundred columns, no row is multiplied."""
    out = None
    for part in _chunks(list(columns)):
        counts = [F.struct(F.lit(c).alias("feature"), F.count_if(known(df, c).isNull()).alias("blanks"), F.count(F.lit(1)).alias("size")) for c in part]
        rows = df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
        out = rows if out is None else out.unionByName(rows)
    return out


def missing_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, missing_rate); null without any row."""
    return null_counts(df, columns).select("feature", F.try_divide("blanks", "size").alias("missing_rate"))


def dense_columns(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> list[str]:
    """Columns with a missing share strictly below the threshold, in order."""
    rates = {r["feature"]: r["missing_rate"] for r in missing_rates(df, columns).collect()}
    return [c for c in columns if rates[c] < threshold]


def column_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, kind): numeric by schema; text is 'date' when every non-null value parses as a time.

    Native date and time columns are dates, other types (boolean) are strings.
    """
    kinds = []
    text = []
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.NumericType):
            kinds.append((c, "numeric"))
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kinds.append((c, "date"))
        elif isinstance(kind, T.StringType):
            text.append(c)
        else:
            kinds.append((c, "string"))
    for part in _chunks(text, CHUNK // 2):
        row = df.agg(
            *[F.count_if(F.col(c).isNotNull() & F.try_to_timestamp(F.col(c)).isNull()).alias(c) for c in part]
        ).first()
        kinds += [(c, "string" if row[c] else "date") for c in part]
    return df.sparkSession.createDataFrame(kinds, "column string, kind string")


def triage(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """(numeric, string, date) column names in table order."""
    kind = {r["column"]: r["kind"] for r in column_types(df, columns).collect()}
    return tuple([c for c in columns if kind[c] == k] for k in ("numeric", "string", "date"))


# --- correlation ------------------------------------------------------------------------------

def pairwise_corr(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(f1, f2, corr) for f1 before f2: Pearson over the rows where both are present.

    Few pairs are one built-in aggregate; more go through :func:`corr_by_products`. Both give the same numbers.
    """
    pairs = list(combinations(columns, 2))
    if len(pairs) > PAIRS:
        return corr_by_products(df, columns)
    wide = df.select(*[as_number(df, c).alias(c) for c in columns])

    def corr(a: str, b: str):
        # The built-in correlation divides by zero where a column is constant.
        spread = [F.stddev_pop(F.when(F.col(y).isNotNull(), F.col(x))) for x, y in ((a, b), (b, a))]
        return F.try_divide(F.covar_pop(a, b), spread[0] * spread[1])

    cells = [F.struct(F.lit(a).alias("f1"), F.lit(b).alias("f2"), corr(a, b).alias("corr")) for a, b in pairs]
    return wide.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def corr_by_products(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same for any number of columns in one pass over the rows: tiles of sums of products, merged in a tree."""
    return tiled_corr(df.select(F.array(*[as_number(df, c) for c in columns]).alias("x")), columns)


def corr_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Square layout: feature, then one column per feature."""
    half = pairwise_corr(df, columns)
    both = half.unionByName(half.select(F.col("f2").alias("f1"), F.col("f1").alias("f2"), "corr"))
    wide = both.groupBy(F.col("f1").alias("feature")).agg(
        *[F.max(F.when(F.col("f2") == c, F.col("corr"))).alias(c) for c in columns]
    )
    return wide.select("feature", *[F.when(F.col("feature") == c, 1.0).otherwise(F.col(c)).alias(c) for c in columns])


def filled_corr_table(df: DataFrame, columns: Sequence[str], fill: float = CORR_FILL) -> DataFrame:
    """(f1, f2, abs_corr) for f1 before f2 after filling gaps; null where a column is constant."""
    wide = df.select(*[F.coalesce(as_number(df, c), F.lit(fill)).alias(c) for c in columns])
    return pairwise_corr(wide, columns).select("f1", "f2", F.abs("corr").alias("abs_corr"))


EXACT = 1e-12


def close_pairs(
    table: DataFrame, importance: Mapping[str, float], threshold: float, keep_exact: bool = False
) -> DataFrame:
    """(first, second): numbers, by falling importance, of the pairs of (f1, f2, abs_corr) above the threshold, the more important one first."""
    order = sorted(importance, key=lambda f: (-importance[f], f))
    names = table.sparkSession.createDataFrame([(f, i) for i, f in enumerate(order)], "name string, place int")
    near = table.where((F.col("abs_corr") > threshold) & ~F.isnan("abs_corr"))
    if keep_exact:
        near = near.where(F.abs(F.col("abs_corr") - 1) >= EXACT)
    one, two = (F.broadcast(names.toDF(f, side)) for f, side in (("f1", "p1"), ("f2", "p2")))
    return near.join(one, "f1").join(two, "f2").select(F.least("p1", "p2").alias("first"), F.greatest("p1", "p2").alias("second"))


def prune_correlated(pairs: DataFrame, importance: Mapping[str, float]) -> list[str]:
    """Names to drop: visiting by importance, a feature that is still there drops all later ones that are too close to it.

    ``pairs`` comes from :func:`close_pairs`. Spark sorts the pairs and sends them a part at a time, so the driver holds one flag per
    feature and never a matrix.
    """
    order = sorted(importance, key=lambda f: (-importance[f], f))
    dropped: dict[int, None] = {}
    for r in pairs.orderBy("first", "second").toLocalIterator():
        if r["first"] not in dropped:
            dropped[r["second"]] = None
    return [order[i] for i in dropped]


def drop_correlated(
    df: DataFrame, importance: Mapping[str, float], threshold: float = 0.95, keep_exact: bool = False
) -> tuple[DataFrame, list[str]]:
    """(frame without the dropped features, dropped names); columns without importance are kept."""
    known_importance = {c: importance[c] for c in df.columns if c in importance}
    if len(known_importance) < 2:
        return df, []
    pairs = close_pairs(filled_corr_table(df, list(known_importance)), known_importance, threshold, keep_exact)
    pairs, _ = materialize(pairs, "close-pairs")
    drop = prune_correlated(pairs, known_importance)
    return df.drop(*drop), drop


FORWARD_LIMIT = 0.5


def forward_kept(df: DataFrame, columns: Sequence[str], limit: float = FORWARD_LIMIT) -> DataFrame:
    """(position, feature): features without an earlier one (dropped ones included) at or above the limit."""
    spark = df.sparkSession
    listed = spark.createDataFrame([(i, c) for i, c in enumerate(columns)], "position int, feature string")
    close = pairwise_corr(df, columns).where(F.abs("corr") >= limit).select(F.col("f2").alias("feature")).distinct()
    return listed.join(close, "feature", "left_anti").select("position", "feature")


# --- importance and evidence ------------------------------------------------------------------


def mean_importance(runs: DataFrame) -> DataFrame:
    """(feature, mean_imp) of (run, feature, weight): average over the runs that used the feature."""
    return runs.groupBy("feature").agg(F.avg(F.col("weight").cast("double")).alias("mean_imp"))


def ranked_importance(imp: DataFrame, value: str = "mean_imp") -> DataFrame:
    """Add the place by falling importance; one row per feature, so one small window."""
    return imp.withColumn("place", F.row_number().over(Window.orderBy(F.desc(value), "feature")))


def top_features(imp: DataFrame, k: int, value: str = "mean_imp") -> list[str]:
    return [r["feature"] for r in imp.orderBy(F.desc(value), "feature").limit(k).collect()]


def features_by_iv(table: DataFrame, least: float = 0.0) -> DataFrame:
    return table.select("feature", "total_iv").distinct().where(F.col("total_iv") >= least).orderBy(F.desc("total_iv"), "feature")
