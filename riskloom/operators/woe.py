"""Weight of evidence and information value of bins and categories, and their lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scoring import bin_woe, category_woe
from riskloom.operators.cut import bin_number, check_edges, interval_labels
from riskloom.operators.hist import as_number, number_counts, numeric_histogram, text_histogram, text_totals
from riskloom.operators.prefix import TASK_ROWS, rank_histogram
from riskloom.roles import FILL_VALUE
from riskloom.session import materialize

# Key of the entry for unseen categories inside our tables; JSON files call it 'other'.
UNSEEN = "__other__"
# Entry names of dictionaries made elsewhere and of the top-N variant.
OTHER = "other"
MISSING = "miss"
# Largest dictionary compiled into an expression; larger ones are joined.
INLINE_ENTRIES = 1000
# Most entries, of all dictionaries together, that are sent to every task instead of sending the rows to them.
SENT_ENTRIES = 100_000


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], target: str) -> DataFrame:
    """(feature, bin_id, lo, hi, label, n, bad): one pass for all features.

    Values are cut while still wide, so the shuffle carries bins, not rows.
    A missing value forms its own bin with null bin_id.
    """
    counts = number_counts(df, {c: bin_number(as_number(df, c), e) for c, e in edges.items()}, target)
    return describe_bins(counts.withColumnRenamed("value", "bin_id"), edges)


def describe_bins(counts: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Add lo, hi and label to (feature, bin_id, n, bad)."""

    def pick(make) -> Column:
        out = None
        for feature, cuts in edges.items():
            values = F.array(*[F.lit(x) for x in make(check_edges(cuts))])
            item = F.get(values, F.col("bin_id"))
            here = F.col("feature") == feature
            out = F.when(here, item) if out is None else out.when(here, item)
        return out

    return counts.select(
        "feature",
        "bin_id",
        pick(lambda cuts: cuts[:-1]).alias("lo"),
        pick(lambda cuts: cuts[1:]).alias("hi"),
        F.coalesce(pick(interval_labels), F.lit("nan")).alias("label"),
        "n",
        "bad",
    )


def value_counts_as_bins(df: DataFrame, features: Sequence[str], target: str, fill: float = FILL_VALUE) -> DataFrame:
    """Each distinct number as its own bin, missing filled: the table of an unbinned feature."""
    counts = numeric_histogram(df, features, target, fill)
    return counts.select("feature", F.col("value").alias("lo"), "n", "bad")


def raw_woe_table(
    df: DataFrame, features: Sequence[str], target: str, fill: float = FILL_VALUE, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Evidence table in which each distinct number is a bin, missing filled.

    A feature may have as many bins as there are rows, so running shares come from ranked buckets instead of a window per feature,
    and totals are joined back.
    """
    ranked = rank_histogram(numeric_histogram(df, features, target, fill), ["feature"], task_rows=task_rows)
    good, goods = F.col("n") - F.col("bad"), F.col("n_total") - F.col("bad_total")
    upto = {"cum_bad": F.col("bad_before") + F.col("bad"), "cum_good": F.col("n_before") - F.col("bad_before") + good}
    t = ranked.rows.select(
        "feature", F.col("value").alias("lo"), "n", "bad", good.alias("good"),
        F.try_divide("n", "n_total").alias("n_share"), F.try_divide("bad", "bad_total").alias("bad_share"), F.try_divide(good, goods).alias("good_share"),
        F.try_divide("bad", "n").alias("bad_rate"), *[c.alias(name) for name, c in upto.items()],
        F.try_divide(upto["cum_bad"], F.col("bad_total")).alias("cum_bad_share"), F.try_divide(upto["cum_good"], goods).alias("cum_good_share"),
    )
    t, _ = materialize(_with_evidence(t), "evidence")
    total = t.groupBy("feature").agg(F.coalesce(F.sum("iv"), F.lit(0.0)).alias("total_iv"))  # one row per feature
    return t.join(F.broadcast(total), "feature")


def _with_evidence(t: DataFrame) -> DataFrame:
    """WOE, KS and IV from the shares."""
    t = t.withColumns(
        {
            "woe": bin_woe(F.col("good_share"), F.col("bad_share")),
            "ks": F.abs(F.col("cum_bad_share") - F.col("cum_good_share")),
        }
    )
    return t.withColumn("iv", (F.col("good_share") - F.col("bad_share")) * F.col("woe"))


def woe_table(counts: DataFrame) -> DataFrame:
    """Full evidence table of (feature, lo, n, bad, ...): shares, running shares, WOE, KS, IV.

    Windows run over the bins of one feature, a handful of rows each; raw values go through :func:`raw_woe_table`.
    """
    whole = Window.partitionBy("feature")
    upto = whole.orderBy(F.col("lo").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = counts.withColumn("good", F.col("n") - F.col("bad"))
    t = t.withColumns(
        {
            "n_share": F.try_divide(F.col("n"), F.sum("n").over(whole)),
            "bad_share": F.try_divide(F.col("bad"), F.sum("bad").over(whole)),
            "good_share": F.try_divide(F.col("good"), F.sum("good").over(whole)),
            "bad_rate": F.try_divide("bad", "n"),
            "cum_bad": F.sum("bad").over(upto),
            "cum_good": F.sum("good").over(upto),
            "cum_bad_share": F.try_divide(F.sum("bad").over(upto), F.sum("bad").over(whole)),
            "cum_good_share": F.try_divide(F.sum("good").over(upto), F.sum("good").over(whole)),
        }
    )
    return _with_evidence(t).withColumn("total_iv", F.coalesce(F.sum("iv").over(whole), F.lit(0.0)))


def iv_list(table: DataFrame) -> DataFrame:
    return table.select("feature", "total_iv").distinct()


def bin_quality(counts: DataFrame, bins: DataFrame, min_share: float | None = 0.05, has_special: bool = True) -> DataFrame:
    """(feature, ok, n_bins): smallest share above the limit and bad rate monotonic.

    ``bins`` lists every (feature, bin_id) of the edge table, so an empty bin is seen
    and fails. With a special value the lowest bin is left out.
    """
    full = bins.select("feature", "bin_id").join(
        counts.select("feature", "bin_id", "n", "bad"), ["feature", "bin_id"], "left"
    )
    if has_special:
        full = full.where(F.col("bin_id") > 0)
    return _quality(full, ["feature"], min_share)


def _quality(full: DataFrame, by: Sequence[str], min_share: float | None) -> DataFrame:
    """Quality of complete bin lists (by..., bin_id, n, bad), empty bins with null n."""
    along = Window.partitionBy(*by).orderBy("bin_id")
    rate = F.try_divide("bad", "n")
    steps = full.withColumn("rate", rate).withColumn("step", F.col("rate") - F.lag("rate").over(along))
    one_way = (F.coalesce(F.min("step"), F.lit(0.0)) >= 0) | (F.coalesce(F.max("step"), F.lit(0.0)) <= 0)
    filled = F.count("rate") == F.count(F.lit(1))
    ok = one_way & filled
    if min_share:
        ok = ok & (F.coalesce(F.try_divide(F.min(F.coalesce("n", F.lit(0))), F.sum("n")), F.lit(0.0)) > min_share)
    return steps.groupBy(*by).agg(ok.alias("ok"), F.count(F.lit(1)).alias("n_bins"))


# --- categories -------------------------------------------------------------------------------


def category_counts(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, value, n, bad) of non-null categories, all features in one pass."""
    return text_histogram(df, features, target).where(F.col("value").isNotNull())


def with_category_woe(counts: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """(feature, key, n, bad, woe). Totals (feature, n, bad) are joined back, so a feature with very many
    categories is never gathered into one window partition."""
    if totals is None:
        totals = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    totals = totals.select("feature", F.col("n").alias("n_all"), F.col("bad").alias("bad_all"))
    good = F.col("n") - F.col("bad")
    shares = counts.join(F.broadcast(totals), "feature")  # one row per feature
    return shares.select(
        "feature",
        F.col("value").alias("key"),
        "n",
        "bad",
        category_woe(
            F.try_divide(good, F.col("n_all") - F.col("bad_all")), F.try_divide(F.col("bad"), F.col("bad_all"))
        ).alias("woe"),
    )


def category_woe_table(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, key, woe) plus one zero entry per feature for categories not seen in the fit."""
    fitted = with_category_woe(category_counts(df, features, target), text_totals(df, features, target)).select("feature", "key", "woe")
    unseen = df.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, features))).alias("feature"), F.lit(UNSEEN).alias("key"), F.lit(0.0).alias("woe")
    )
    return fitted.unionByName(unseen)


def top_category_woe_table(df: DataFrame, features: Sequence[str], target: str, top: int = 10) -> DataFrame:
    """Variant: missing reads 'miss', the ``top`` most frequent keep their own entry, the rest is 'other'.

    The rank filter is pushed below the shuffle as a per-task limit, so only
    ``top`` rows per feature and task are exchanged.
    """
    counts = text_histogram(df, features, target, MISSING)
    order = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
    best = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    merged = (
        counts.join(F.broadcast(best.select("feature", "value", F.lit(True).alias("kept"))), ["feature", "value"], "left")
        .groupBy("feature", F.when(F.col("kept"), F.col("value")).otherwise(F.lit(OTHER)).alias("value"))
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )
    return with_category_woe(merged).select("feature", "key", "woe")


# --- lookup -----------------------------------------------------------------------------------


def _lookup(value: Column, entries: Mapping[str, float], unseen: float | None) -> Column:
    if not entries:
        return F.when(value.isNotNull(), F.lit(unseen).cast("double"))
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable((k, float(v)) for k, v in entries.items())])
    found = F.try_element_at(table, value)
    if unseen is None:
        return found
    return F.when(value.isNotNull(), F.coalesce(found, F.lit(float(unseen))))


def encode_categories(df: DataFrame, mapping: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Replace categories by their value from a driver-sized dictionary.

    An unseen category takes the entry for unseen ones (ours, or 'other' in dictionaries
    made elsewhere) if there is one, else null; null stays null. Pure expressions; larger dictionaries go through
    :func:`encode_with_table`.
    """
    size = sum(len(m) for m in mapping.values())
    if any(len(m) > INLINE_ENTRIES for m in mapping.values()):
        raise ValueError(f"{size} entries are too many for an expression, use encode_with_table")
    out = {}
    for feature, entries in mapping.items():
        known = {k: v for k, v in entries.items() if k != UNSEEN and v is not None}
        out[feature] = _lookup(F.col(feature).cast("string"), known, entries.get(UNSEEN, entries.get(OTHER)))
    return df.withColumns(out)


def encode_dictionary(df: DataFrame, table: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace categories through a stored (feature, key, woe) of any size.

    Small dictionaries become expressions, the next larger ones are sent to every task, up to SENT_ENTRIES entries in all, and the
    others stay a table and are joined; only the number of entries per feature and the small ones reach the driver.
    """
    order = df.columns
    counted = table.where(F.col("feature").isin(list(features))).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["feature"]: r["n"] for r in counted.collect()}
    small = [f for f in features if 0 < sizes.get(f, 0) <= INLINE_ENTRIES]
    large = [f for f in features if sizes.get(f, 0) > INLINE_ENTRIES]
    if small:
        df = encode_categories(df, woe_by_category(table.where(F.col("feature").isin(small))))
    unseen, room, rest = _unseen(table), SENT_ENTRIES, []
    for f in sorted(large, key=lambda f: sizes[f]):
        if sizes[f] > room:
            rest.append(f)
            continue
        room -= sizes[f]
        sent = _entries(table.where(F.col("feature") == f), F.lit(unseen.get(f)).cast("double"), "feature")
        sent = F.broadcast(sent.select(F.col("key").alias("k__"), F.col("woe").alias("w__")))
        df = _looked_up(df.join(sent, F.col(f).cast("string") == F.col("k__"), "left"), f, unseen)
    out = encode_with_table(df, table, rest) if rest else df
    return out.select(*order)


def encode_top_categories(df: DataFrame, mapping: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Apply side of the top-N variant: missing reads 'miss', the rest 'other'."""
    texts = df.withColumns({f: F.coalesce(F.col(f).cast("string"), F.lit(MISSING)) for f in mapping})
    return encode_categories(texts, mapping)


# From this many dictionaries on, rows are looked up in long form.
LONG_FROM = 3


def _unseen(table: DataFrame) -> dict[str, float]:
    """Value of categories without an entry, by feature."""
    unseen: dict[str, float] = {}
    for r in table.where(F.col("key").isin(UNSEEN, OTHER)).orderBy(F.col("key") == UNSEEN).collect():  # two per feature
        unseen[r["feature"]] = r["woe"]
    return unseen


def _entries(table: DataFrame, rest: Column, by: str) -> DataFrame:
    """(by, key, woe), one per key; without those that say what a category without an entry gets anyway."""
    entries = table.where(F.col("key") != UNSEEN).groupBy(by, "key").agg(F.max("woe").alias("woe"), F.first(rest).alias("rest__"))
    return entries.where(F.col("woe").isNotNull() & ~F.col("woe").eqNullSafe(F.col("rest__"))).drop("rest__")


def _looked_up(joined: DataFrame, feature: str, unseen: Mapping[str, float]) -> DataFrame:
    rest = F.lit(unseen.get(feature)).cast("double")
    return joined.withColumn(feature, F.when(F.col(feature).isNotNull(), F.coalesce("w__", rest))).drop("k__", "w__")


def encode_with_table(df: DataFrame, table: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace categories through (feature, key, woe) kept as a table of any size.

    One or two dictionaries are a left join each: Spark broadcasts a small one by its measured size and
    sort-merges a large one, splitting skewed keys at run time. More go through one join in long form (streams cannot, as it stores the rows).
    The results are the same.
    """
    unseen = _unseen(table)
    if len(features) >= LONG_FROM and not df.isStreaming:
        return _encode_long(df, table, features, unseen)
    order = df.columns
    for feature in features:
        part = table.where((F.col("feature") == feature) & (F.col("key") != UNSEEN)).select(
            F.col("key").alias("k__"), F.col("woe").alias("w__")
        )
        df = _looked_up(df.join(part, F.col(feature).cast("string") == F.col("k__"), "left"), feature, unseen)
    return df.select(*order)


def _encode_long(df: DataFrame, table: DataFrame, features: Sequence[str], unseen: Mapping[str, float]) -> DataFrame:
    """All dictionaries in one join on (feature, key).

    Rows are stored with a number. Each category travels to its entry once, with that number; Spark splits a key that holds a large
    part of all rows at run time. What is found comes back by row number in one narrow table, the only one that the wide rows are
    joined to: they are shuffled once, whatever the number of features, and without the categories, of which only a flag goes along.
    """
    stored, _ = materialize(df.withColumn("row__", F.monotonically_increasing_id()), "rows-to-encode")
    texts = stored.select("row__", *[F.col(f).cast("string").alias(str(i)) for i, f in enumerate(features)])
    long = texts.unpivot(["row__"], [str(i) for i in range(len(features))], "place", "key").where(F.col("key").isNotNull())
    long = long.withColumn("place", F.col("place").cast("int"))
    names = df.sparkSession.createDataFrame(
        [(f, i, unseen.get(f)) for i, f in enumerate(features)], "feature string, place int, rest double"
    )
    entries = _entries(table.join(F.broadcast(names), "feature"), F.col("rest"), "place")
    found = long.join(entries, ["place", "key"])
    values = [F.max(F.when(F.col("place") == i, F.col("woe"))).alias(f"w__{i}") for i in range(len(features))]
    given = F.array(*[F.col(f).isNotNull() for f in features]).alias("given__")
    rows = stored.select("row__", *[c for c in df.columns if c not in features], given)
    joined = rows.join(found.groupBy("row__").agg(*values), "row__", "left")
    out = {
        f: F.when(F.get("given__", F.lit(i)), F.coalesce(f"w__{i}", F.lit(unseen.get(f)).cast("double"))) for i, f in enumerate(features)
    }
    return joined.withColumns(out).select(*df.columns)


def encode_bins(
    df: DataFrame, edges: Mapping[str, Sequence[float]], woe: Mapping[str, Mapping[int | None, float]]
) -> DataFrame:
    """Replace binned numbers by the evidence of their bin; all other columns are kept in order."""
    out = {}
    for feature, cuts in edges.items():
        slots = [woe.get(feature, {}).get(i) for i in range(len(cuts) - 1)]
        missing = woe.get(feature, {}).get(None)
        values = F.array(*[F.lit(v).cast("double") for v in slots])
        number = bin_number(as_number(df, feature), cuts)
        out[feature] = F.when(number.isNull(), F.lit(missing).cast("double")).otherwise(F.get(values, number))
    return df.withColumns(out)


def woe_by_bin(table: DataFrame) -> dict[str, dict[int | None, float | None]]:
    """Bins of a fitted table as {feature: {bin_id: woe}}: features x bins entries."""
    out: dict[str, dict[int | None, float | None]] = {}
    for row in table.select("feature", "bin_id", "woe").collect():
        out.setdefault(row["feature"], {})[row["bin_id"]] = row["woe"]
    return out


def woe_by_category(table: DataFrame) -> dict[str, dict[str, float]]:
    out: dict[str, dict[str, float]] = {}
    for row in table.select("feature", "key", "woe").collect():
        out.setdefault(row["feature"], {})[row["key"]] = row["woe"]
    return out


