"""Registered queries: sources, sinks, columns, joins, encoders, splits."""

from __future__ import annotations

from secrets import token_hex

from pyspark.sql import functions as F

from riskloom.functions.scoring import joined_text, to_score
from riskloom.functions.seal import unseal_cbc
from riskloom.operators import columns as cols
from riskloom.operators import encode, select, split, woe
from riskloom.operators.binning import manual_bins
from riskloom.operators.cut import INF, cut_columns
from riskloom.operators.profile import value_counts
from riskloom.plans.fixtures import LOAN_SQL, SPLIT_SQL, loan_wide, table, with_time_split
from riskloom.plans.registry import N, R, edges_sql, query, rounded, score_sql
from riskloom.session import materialize, scratch_path
from riskloom.sources import params, tables
from riskloom.sources.treedump import parse_dump, score_dump

WITH = f"WITH {LOAN_SQL}"
WITH_SPLIT = f"WITH {LOAN_SQL}, {SPLIT_SQL}"

# Edges used wherever bins are given rather than fitted.
PRICE_CUTS = [50000.0, 100000.0, 150000.0, 200000.0, 300000.0]
BALANCE_CUTS = [2000.0, 5000.0, 8000.0]
EDGES = {"f_price": [-INF, *PRICE_CUTS, INF], "f_bal": [-INF, *BALANCE_CUTS, INF]}
CATEGORIES = ["c_prio", "c_seg", "c_nat"]


# --- sources and sinks ------------------------------------------------------------------------


@query("wide_csv_scan", f"{WITH} SELECT apply_no, target, f_price, c_seg, month FROM lw")
def wide_csv_scan(spark, sf):
    path = scratch_path(spark, "wide-csv")
    tables.write_report(loan_wide(spark, sf).select("apply_no", "target", "f_price", "c_seg", "month"), path, "csv")
    return tables.read_table(spark, path, "apply_no bigint, target int, f_price double, c_seg string, month string", "csv")


@query("held_out_key_list", f"{WITH_SPLIT} SELECT apply_no, target, f_price FROM ls WHERE type = 'test'")
def held_out_key_list(spark, sf):
    wide = loan_wide(spark, sf)
    path = scratch_path(spark, "test-keys")
    tables.write_keys(with_time_split(wide), "apply_no", path)
    keys = tables.read_keys(spark, path, "bigint")
    return cols.held_out(wide, keys, "apply_no").select("apply_no", "target", "f_price")


@query("score_sink", f"{WITH_SPLIT} SELECT apply_no, {R('p', 'p', 9)}, type AS client_batch FROM ls WHERE type <> 'train'")
def score_sink(spark, sf):
    path = scratch_path(spark, "scores")
    batched = with_time_split(loan_wide(spark, sf)).withColumnRenamed("type", "client_batch")
    tables.write_scores(batched, "apply_no", "p", "client_batch", path)
    stored = spark.read.parquet(path).where(F.col("client_batch") != "train")
    return stored.select("apply_no", (F.round("p", 9) + F.lit(0.0)).alias("p"), F.col("client_batch").cast("string").alias("client_batch"))


CATEGORY_SQL = """
lc AS (SELECT 'c_prio' AS feature, c_prio AS key, target FROM {src} UNION ALL
       SELECT 'c_seg', c_seg, target FROM {src} UNION ALL SELECT 'c_nat', c_nat, target FROM {src}),
cc AS (SELECT feature, key, count(*) AS n, sum(target) AS bad FROM lc WHERE key IS NOT NULL GROUP BY 1, 2),
cs AS (SELECT *, CAST(bad AS DOUBLE) / sum(bad) OVER (PARTITION BY feature) AS bs,
         CAST(n - bad AS DOUBLE) / sum(n - bad) OVER (PARTITION BY feature) AS gs FROM cc),
cw AS (SELECT feature, key, CASE WHEN bs = 0 THEN 0 ELSE ln((CASE WHEN gs = 0 THEN 1e-10 ELSE gs END) / bs) END AS woe FROM cs
       UNION ALL SELECT unnest(['c_prio', 'c_seg', 'c_nat']), '__other__', 0)"""


@query("category_woe", f"{WITH}, {CATEGORY_SQL.format(src='lw')} SELECT feature, key, {R('woe', 'woe')} FROM cw")
def category_woe(spark, sf):
    return rounded(woe.category_woe_table(loan_wide(spark, sf), CATEGORIES, "target"))


@query("category_woe_json", f"{WITH}, {CATEGORY_SQL.format(src='lw')} SELECT feature, key, {R('woe', 'woe')} FROM cw")
def category_woe_json(spark, sf):
    path = scratch_path(spark, "category-json")
    params.categories_to_json(woe.category_woe_table(loan_wide(spark, sf), CATEGORIES, "target"), path)
    return rounded(params.categories_from_json(spark, path))


PART_SQL = """
pl AS (SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(l_quantity > 25 AS INTEGER) AS target FROM lineitem),
pc AS (SELECT part AS key, count(*) AS n, sum(target) AS bad FROM pl GROUP BY 1),
ps AS (SELECT *, CAST(bad AS DOUBLE) / sum(bad) OVER () AS bs, CAST(n - bad AS DOUBLE) / sum(n - bad) OVER () AS gs FROM pc),
pw AS (SELECT key, CASE WHEN bs = 0 THEN 0 ELSE ln((CASE WHEN gs = 0 THEN 1e-10 ELSE gs END) / bs) END AS woe FROM ps)"""


def part_lines(spark, sf):
    """Lines with a category of thousands of entries."""
    lines = table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"), (F.col("l_quantity") > 25).cast("int").alias("target"))


@query("category_woe_json_large", f"WITH {PART_SQL} SELECT 'part' AS feature, key, {R('woe', 'woe')} FROM pw UNION ALL SELECT 'part', '__other__', 0.0")
def category_woe_json_large(spark, sf):
    path = scratch_path(spark, "category-json")
    params.write_categories(woe.category_woe_table(part_lines(spark, sf), ["part"], "target"), path)
    return rounded(params.categories_from_json(spark, path))


BIN_SQL = f"""
lb AS (SELECT 'f_price' AS feature, {edges_sql('f_price', PRICE_CUTS)} AS bin_id, target FROM {{src}} UNION ALL
       SELECT 'f_bal', {edges_sql('f_bal', BALANCE_CUTS)}, target FROM {{src}}),
le AS (SELECT 'f_price' AS feature, unnest([{', '.join(f'{e!r}' for e in PRICE_CUTS)}]) AS e
       UNION ALL SELECT 'f_bal', unnest([{', '.join(f'{e!r}' for e in BALANCE_CUTS)}])),
ln_ AS (SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY e) AS INTEGER) AS bin_id, e FROM le),
bc AS (SELECT b.feature, CAST(b.bin_id AS INTEGER) AS bin_id,
         CASE WHEN b.bin_id = 0 THEN CAST('-inf' AS DOUBLE) ELSE max(x.e) END AS lo, count(*) AS n, sum(target) AS bad
       FROM lb b LEFT JOIN ln_ x ON b.feature = x.feature AND b.bin_id = x.bin_id GROUP BY b.feature, b.bin_id)"""


def woe_columns(digits: int = 6) -> str:
    counts = ", ".join(N(c, c) for c in ("n", "bad", "good", "cum_bad", "cum_good"))
    names = ("n_share", "bad_share", "good_share", "bad_rate", "cum_bad_share", "cum_good_share", "woe", "ks", "iv", "total_iv")
    return f"{counts}, {', '.join(R(c, c, digits) for c in names)}"


@query("bin_parameters_json", f"{WITH}, {BIN_SQL.format(src='lw')}, wb AS (SELECT * FROM bc) "
       "SELECT feature, bin_id, round(CASE WHEN bad = 0 THEN 0 ELSE ln((CAST(n - bad AS DOUBLE) / sum(n - bad) OVER "
       "(PARTITION BY feature)) / (CAST(bad AS DOUBLE) / sum(bad) OVER (PARTITION BY feature))) END, 6) + 0.0 AS woe FROM wb")
def bin_parameters_json(spark, sf):
    path = scratch_path(spark, "bin-json")
    params.bins_to_json(spark, manual_bins(loan_wide(spark, sf), EDGES, "target"), path)
    _, stored = params.bins_from_json(spark, path)
    rows = [(f, i, w) for f, entries in stored.items() for i, w in entries.items()]
    return rounded(spark.createDataFrame(rows, "feature string, bin_id int, woe double"))


TREES = """booster[0]:
0:[f_price<150000.5] yes=1,no=2,missing=2
	1:[f_bal<4000.25] yes=3,no=4,missing=3
		3:leaf=0.4
		4:leaf=0.3
	2:[f_price<280000] yes=5,no=6,missing=6
		5:leaf=-0.1
		6:leaf=-0.6
booster[1]:
0:leaf=-0.05
booster[2]:
0:[f_nation<12] yes=1,no=2,missing=1
	1:leaf=0.02
	2:leaf=-0.03
"""
TREE_SQL = """-0.05 + (CASE WHEN f_price < 150000.5 THEN (CASE WHEN f_bal < 4000.25 OR f_bal IS NULL THEN 0.4 ELSE 0.3 END)
  WHEN f_price < 280000 THEN -0.1 ELSE -0.6 END) + (CASE WHEN f_nation < 12 THEN 0.02 ELSE -0.03 END)"""


@query("tree_dump_scores", f"{WITH}, t AS (SELECT apply_no, 1 / (1 + exp(-({TREE_SQL}))) AS q FROM lw) "
       f"SELECT apply_no, {R('q', 'q', 9)}, {score_sql('q')} AS score FROM t")
def tree_dump_scores(spark, sf):
    scored = score_dump(loan_wide(spark, sf), parse_dump(TREES.splitlines()), "q")
    return scored.select("apply_no", (F.round("q", 9) + F.lit(0.0)).alias("q"), to_score("q").alias("score"))


@query("model_sample", f"{WITH} SELECT f_price, f_bal, apply_no FROM lw ORDER BY apply_no LIMIT 100")
def model_sample(spark, sf):
    return tables.sample_rows(loan_wide(spark, sf), ["f_price", "f_bal"], "apply_no")


SECRET_SETTING = "spark.riskloom.delivery.key"


@query("delivery_sample", f"{WITH} SELECT apply_no, month, concat_ws(',', apply_no, month, target) AS plain, "
       "CAST(2 * 16 * ceil(length(concat_ws(',', apply_no, month, target)) / 16.0) AS INTEGER) AS sealed_size FROM lw")
def delivery_sample(spark, sf):
    secret = spark.conf.get(SECRET_SETTING, None) or token_hex(8)  # any secret makes the round trip
    sent = tables.delivery_sample(loan_wide(spark, sf), "apply_no", "month", "target", secret, legacy=True)
    return sent.select("apply_no", "month", unseal_cbc(F.col("merge"), secret).alias("plain"), F.length("merge").alias("sealed_size"))


@query("delivery_features", f"{WITH} SELECT apply_no, f_price, c_seg, '2024-01-31' AS apply_time FROM lw")
def delivery_features(spark, sf):
    wide = loan_wide(spark, sf).select("apply_no", "apply_time", "target", "f_price", "c_seg", "c_nat")
    return tables.delivery_features(wide, "target", "apply_time", "2024-01-31", ["c_nat"]).select(
        "apply_no", "f_price", "c_seg", "apply_time"
    )


# --- columns and filters ----------------------------------------------------------------------


@query("columns_chosen", f"{WITH} SELECT f_bal, f_nation, c_prio, 'batch-a' AS batch, apply_no FROM lw")
def columns_chosen(spark, sf):
    wide = loan_wide(spark, sf).drop("f_price", "f_price2", "f_sparse", "c_seg", "c_nat", "p")
    from riskloom.roles import Roles

    chosen = Roles(ignore=("month",)).features(wide)
    return cols.key_last(wide.select("apply_no", *chosen).withColumn("batch", F.lit("batch-a")), "apply_no")


@query("rows_with_any_feature", f"{WITH} SELECT apply_no, f_price, f_sparse FROM lw WHERE f_price IS NOT NULL OR f_sparse IS NOT NULL")
def rows_with_any_feature(spark, sf):
    return cols.drop_empty_rows(loan_wide(spark, sf).select("apply_no", "f_price", "f_sparse"), ["f_price", "f_sparse"])


@query("first_row_per_key", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem QUALIFY row_number() "
       "OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1")
def first_row_per_key(spark, sf):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf, "lineitem").select("l_orderkey", *order)
    return split.keep_first(lines, ["l_orderkey"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("binary_target_rows", "SELECT l_orderkey, l_linenumber - 1 AS target FROM lineitem WHERE l_linenumber IN (1, 2)")
def binary_target_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("target"))
    return cols.binary_target_rows(lines, "target")


@query("rows_per_month", f"{WITH} SELECT month, {N('count(*)', 'n')} FROM lw GROUP BY month")
def rows_per_month(spark, sf):
    return value_counts(loan_wide(spark, sf), "month")


@query("numeric_gaps_filled", f"{WITH} SELECT apply_no, coalesce(f_price, -999999) AS f_price, coalesce(f_bal, -999999) AS f_bal, c_seg FROM lw")
def numeric_gaps_filled(spark, sf):
    return cols.fill_numeric(loan_wide(spark, sf).select("apply_no", "f_price", "f_bal", "c_seg"), ["f_price", "f_bal", "c_seg"])


@query("column_kinds", """
WITH o AS (SELECT CAST(o_orderdate AS VARCHAR) AS day_text, o_orderstatus, o_orderpriority FROM orders)
SELECT 'o_totalprice' AS "column", 'numeric' AS kind UNION ALL SELECT 'o_custkey', 'numeric'
UNION ALL SELECT 'day_text', CASE WHEN count(day_text) = count(try_cast(day_text AS TIMESTAMP)) THEN 'date' ELSE 'string' END FROM o
UNION ALL SELECT 'o_orderstatus', CASE WHEN count(o_orderstatus) = count(try_cast(o_orderstatus AS TIMESTAMP)) THEN 'date' ELSE 'string' END FROM o
UNION ALL SELECT 'o_orderpriority', CASE WHEN count(o_orderpriority) = count(try_cast(o_orderpriority AS TIMESTAMP)) THEN 'date' ELSE 'string' END FROM o""")
def column_kinds(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day_text", F.col("o_orderdate").cast("string"))
    return select.column_types(orders, ["o_totalprice", "o_custkey", "day_text", "o_orderstatus", "o_orderpriority"])


MISSING_SQL = """
mr AS (SELECT unnest(['f_price', 'f_bal', 'f_sparse', 'f_nation', 'c_seg']) AS feature,
  unnest([avg(CASE WHEN f_price IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN f_bal IS NULL THEN 1 ELSE 0 END),
    avg(CASE WHEN f_sparse IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN f_nation IS NULL THEN 1 ELSE 0 END),
    avg(CASE WHEN c_seg IS NULL THEN 1 ELSE 0 END)]) AS missing_rate FROM lw)"""
MISSING_COLUMNS = ["f_price", "f_bal", "f_sparse", "f_nation", "c_seg"]


@query("missing_rates", f"{WITH}, {MISSING_SQL} SELECT feature, {R('missing_rate', 'missing_rate')} FROM mr")
def missing_rates(spark, sf):
    return rounded(select.missing_rates(loan_wide(spark, sf), MISSING_COLUMNS))


@query("dense_columns", f"{WITH}, {MISSING_SQL} SELECT feature FROM mr WHERE missing_rate < 0.95")
def dense_columns(spark, sf):
    kept = select.dense_columns(loan_wide(spark, sf), MISSING_COLUMNS, 0.95)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


@query("train_rows", f"{WITH_SPLIT} SELECT apply_no, lower(upper(type)) AS type FROM ls WHERE type = 'train'")
def train_rows(spark, sf):
    labelled = with_time_split(loan_wide(spark, sf)).withColumn("type", F.upper("type"))
    return labelled.withColumn("type", F.lower("type")).where(F.col("type") == "train").select("apply_no", "type")


@query("renamed_by_dictionary", f"{WITH} SELECT apply_no, f_price AS x001, f_bal AS x002 FROM lw")
def renamed_by_dictionary(spark, sf):
    return cols.rename_known(loan_wide(spark, sf), {"f_price": "x001", "f_bal": "x002", "not_there": "x003"}, ["apply_no"])


@query("step_audit", """
WITH a AS (SELECT * FROM orders), b AS (SELECT * FROM a WHERE o_totalprice > 100000)
SELECT 0 AS step_no, 'read' AS step, CAST(count(*) AS BIGINT) AS rows, 6 AS cols FROM a
UNION ALL SELECT 1, 'large', CAST(count(*) AS BIGINT), 6 FROM b
UNION ALL SELECT 2, 'two columns', CAST(count(*) AS BIGINT), 2 FROM b""")
def step_audit(spark, sf):
    audit = cols.Audit()
    df = audit.watch(table(spark, sf, "orders"), "read")
    df = audit.watch(df.where(F.col("o_totalprice") > 100000), "large")
    df = audit.watch(df.select("o_orderkey", "o_totalprice"), "two columns")
    df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(audit.rows(), "step_no int, step string, rows bigint, cols int")


@query("text_join", f"{WITH} SELECT apply_no, concat_ws(',', apply_no, month, target) AS merged FROM lw")
def text_join(spark, sf):
    return loan_wide(spark, sf).select("apply_no", joined_text("apply_no", "month", "target").alias("merged"))


@query("scaled_scores", f"{WITH} SELECT apply_no, {score_sql('p')} AS score FROM lw")
def scaled_scores(spark, sf):
    return loan_wide(spark, sf).select("apply_no", to_score("p").alias("score"))


# --- joins and lookups ------------------------------------------------------------------------


@query("split_label_join", f"{WITH_SPLIT} SELECT apply_no, type, f_price FROM ls")
def split_label_join(spark, sf):
    wide = loan_wide(spark, sf)
    labels = with_time_split(table(spark, sf, "orders").select(F.col("o_orderkey").alias("apply_no"), F.col("o_orderdate").alias("apply_time")))
    return cols.with_split(wide, labels, "apply_no").select("apply_no", "type", "f_price")


# Fitted on part of the segments and applied to all, so that unseen categories occur.
LOOKUP_SQL = f"""{WITH}, tr AS (SELECT * FROM lw WHERE c_nat < 'NATION_2'), {CATEGORY_SQL.format(src='tr')}
SELECT apply_no, {R("CASE WHEN c_nat IS NOT NULL THEN coalesce(a.woe, 0) END", 'c_nat')},
  {R("CASE WHEN c_seg IS NOT NULL THEN coalesce(b.woe, 0) END", 'c_seg')}
FROM lw LEFT JOIN cw a ON a.feature = 'c_nat' AND a.key = c_nat LEFT JOIN cw b ON b.feature = 'c_seg' AND b.key = c_seg"""


@query("category_lookup", LOOKUP_SQL)
def category_lookup(spark, sf):
    wide = loan_wide(spark, sf)
    fitted = woe.category_woe_table(wide.where(F.col("c_nat") < "NATION_2"), ["c_nat", "c_seg"], "target")
    return rounded(woe.encode_categories(wide.select("apply_no", "c_nat", "c_seg"), woe.woe_by_category(fitted)))


@query("category_lookup_join", LOOKUP_SQL)
def category_lookup_join(spark, sf):
    wide = loan_wide(spark, sf)
    fitted = woe.category_woe_table(wide.where(F.col("c_nat") < "NATION_2"), ["c_nat", "c_seg"], "target")
    return rounded(woe.encode_with_table(wide.select("apply_no", "c_nat", "c_seg"), fitted, ["c_nat", "c_seg"]))


MANY_SQL = f"""WITH ml AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS part, CAST(l_orderkey AS VARCHAR) AS ordr,
  concat_ws('/', l_partkey, l_suppkey) AS pair, CASE WHEN l_partkey % 3 <> 0 THEN CAST(l_partkey % 1500 AS VARCHAR) END AS most, CAST(l_suppkey AS VARCHAR) AS supp,
  CAST(l_quantity > 25 AS INTEGER) AS target FROM lineitem),
mk AS (SELECT unnest(['part', 'ordr', 'pair', 'most', 'supp']) AS feature, unnest([part, ordr, pair, most, supp]) AS key, target FROM ml WHERE l_linenumber < 4),
mc AS (SELECT feature, key, count(*) AS n, sum(target) AS bad FROM mk WHERE key IS NOT NULL GROUP BY 1, 2),
ms AS (SELECT *, CAST(bad AS DOUBLE) / sum(bad) OVER (PARTITION BY feature) AS bs, CAST(n - bad AS DOUBLE) / sum(n - bad) OVER (PARTITION BY feature) AS gs FROM mc),
mw AS (SELECT feature, key, CASE WHEN bs = 0 THEN 0 ELSE ln((CASE WHEN gs = 0 THEN 1e-10 ELSE gs END) / bs) END AS woe FROM ms)
SELECT l_orderkey, l_linenumber, {', '.join(R(f"CASE WHEN ml.{c} IS NOT NULL THEN coalesce({c}_.woe, 0) END", c) for c in ('part', 'ordr', 'pair', 'most', 'supp'))}
FROM ml {' '.join(f"LEFT JOIN mw {c}_ ON {c}_.feature = '{c}' AND {c}_.key = ml.{c}" for c in ('part', 'ordr', 'pair', 'most', 'supp'))}"""


@query("category_lookup_many", MANY_SQL)
def category_lookup_many(spark, sf):
    """Dictionaries of thousands of entries, fitted on a part of the lines, looked up in one join; a small one stays an expression."""
    key, part = F.col("l_orderkey").cast("string"), F.col("l_partkey")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", part.cast("string").alias("part"), key.alias("ordr"), F.concat_ws("/", "l_partkey", "l_suppkey").alias("pair"),
        F.when(part % 3 != 0, (part % 1500).cast("string")).alias("most"), F.col("l_suppkey").cast("string").alias("supp"),
        (F.col("l_quantity") > 25).cast("int").alias("target"),
    )
    names = ["part", "ordr", "pair", "most", "supp"]
    fitted, _ = materialize(woe.category_woe_table(lines.where("l_linenumber < 4"), names, "target"), "many")
    return rounded(woe.encode_dictionary(lines.drop("target"), fitted, names))


@query("interval_lookup", f"{WITH} SELECT apply_no, {N(edges_sql('f_price', PRICE_CUTS), 'f_price', 'INTEGER')}, "
       f"{N(edges_sql('f_bal', BALANCE_CUTS), 'f_bal', 'INTEGER')} FROM lw")
def interval_lookup(spark, sf):
    return cut_columns(loan_wide(spark, sf).select("apply_no", "f_price", "f_bal"), EDGES)


@query("bin_labels", f"""{WITH} SELECT apply_no, target, CASE WHEN f_bal IS NULL OR f_bal >= 9000 OR f_bal < 1000 THEN 'nan'
  WHEN f_bal < 2500.5 THEN '[1000, 2500.5)' ELSE '[2500.5, 9000)' END AS f_bal FROM lw""")
def bin_labels(spark, sf):
    return cut_columns(loan_wide(spark, sf).select("apply_no", "target", "f_bal"), {"f_bal": [1000, 2500.5, 9000]}, labels=True)


# --- encoders and splits ----------------------------------------------------------------------

LABEL_SQL = """
kv AS (SELECT 'c_prio' AS feature, c_prio AS key FROM {src} UNION SELECT 'c_nat', c_nat FROM {src}),
lk AS (SELECT feature, key, CAST(row_number() OVER (PARTITION BY feature ORDER BY key) - 1 AS INTEGER) AS code
       FROM kv WHERE key IS NOT NULL)"""


@query("label_codes", f"{WITH}, {LABEL_SQL.format(src='lw')} SELECT feature, key, code FROM lk")
def label_codes(spark, sf):
    return encode.fit_labels(loan_wide(spark, sf), ["c_prio", "c_nat"])


@query("label_apply", f"""{WITH}, tr AS (SELECT * FROM lw WHERE c_nat < 'NATION_2'), {LABEL_SQL.format(src='tr')}
SELECT apply_no, CAST(coalesce(a.code, -1) AS INTEGER) AS c_prio, CAST(coalesce(b.code, -1) AS INTEGER) AS c_nat FROM lw
LEFT JOIN lk a ON a.feature = 'c_prio' AND a.key = c_prio LEFT JOIN lk b ON b.feature = 'c_nat' AND b.key = c_nat""")
def label_apply(spark, sf):
    wide = loan_wide(spark, sf).select("apply_no", "c_prio", "c_nat")
    labels = encode.fit_labels(wide.where(F.col("c_nat") < "NATION_2"), ["c_prio", "c_nat"])
    return encode.apply_labels(wide, labels, ["c_prio", "c_nat"])


@query("label_encode_gaps", f"""{WITH}, kv AS (SELECT DISTINCT coalesce(c_seg, '-1007') AS key FROM lw),
lk AS (SELECT key, CAST(row_number() OVER (ORDER BY key) - 1 AS INTEGER) AS code FROM kv)
SELECT apply_no, code AS c_seg FROM lw JOIN lk ON key = coalesce(c_seg, '-1007')""")
def label_encode_gaps(spark, sf):
    wide = loan_wide(spark, sf).select("apply_no", "c_seg")
    return encode.label_encode(wide, wide, ["c_seg"])[0]


HASH_SQL = "md5(concat_ws('-', apply_no, 1234))"
STRATIFIED_SQL = f"""
st AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY target ORDER BY {HASH_SQL}) <=
  ceil(count(*) OVER (PARTITION BY target) * 0.25) THEN 'test' ELSE 'train' END AS type FROM lw)"""


@query("stratified_split", f"{WITH}, {STRATIFIED_SQL} SELECT apply_no, target, type FROM st")
def stratified_split(spark, sf):
    return split.stratified_split(loan_wide(spark, sf).select("apply_no", "target"), "apply_no", "target", 0.25)


DESCRIBE_SQL = ", ".join(
    [N("count(t)", '"count"'), R("avg(t)", "mean"), R("stddev_samp(t)", "std"), R("min(t)", "min"),
     R("quantile_cont(t, 0.25)", "q25"), R("quantile_cont(t, 0.5)", "q50"), R("quantile_cont(t, 0.75)", "q75"), R("max(t)", "max")]
)


@query("split_job_by_split", f"{WITH}, {STRATIFIED_SQL}, d AS (SELECT type, CAST(target AS DOUBLE) AS t FROM st) "
       f"SELECT type, {DESCRIBE_SQL} FROM d GROUP BY type")
def split_job_by_split(spark, sf):
    wide = loan_wide(spark, sf).select("apply_no", "target", "apply_time")
    twice = wide.unionByName(wide.withColumn("apply_time", F.col("apply_time") + F.expr("INTERVAL 1 DAY")))
    _, reports = split.split_job(twice, "apply_no", "target", "apply_time", ["apply_time"], 0.25)
    return rounded(reports["by_split"])


@query("bad_rate_by_month", f"{WITH}, d AS (SELECT month, CAST(target AS DOUBLE) AS t FROM lw) SELECT month, {DESCRIBE_SQL} FROM d GROUP BY month")
def bad_rate_by_month(spark, sf):
    from riskloom.operators.profile import target_by_group

    return rounded(target_by_group(loan_wide(spark, sf), "month", "target"))


@query("time_split", f"{WITH_SPLIT} SELECT apply_no, type FROM ls")
def time_split(spark, sf):
    return with_time_split(loan_wide(spark, sf)).select("apply_no", "type")


@query("split_views", f"{WITH_SPLIT} SELECT 'all' AS part, {N('count(*)', 'n')}, {N('sum(target)', 'bad')} FROM ls UNION ALL "
       "SELECT type, CAST(count(*) AS BIGINT), CAST(sum(target) AS BIGINT) FROM ls GROUP BY type")
def split_views(spark, sf):
    views = split.split_views(with_time_split(loan_wide(spark, sf)))
    parts = [
        v.agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("bad")).select(F.lit(name).alias("part"), "n", "bad")
        for name, v in views.items()
        if v is not None
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("stratified_folds", f"{WITH} SELECT apply_no, CAST(len(list_filter(range(1, 10), lambda i: i * n // 10 < place)) AS INTEGER) AS fold "
       f"FROM (SELECT apply_no, count(*) OVER (PARTITION BY target) AS n, row_number() OVER (PARTITION BY target ORDER BY {HASH_SQL}) AS place FROM lw)")
def stratified_folds(spark, sf):
    return split.stratified_folds(loan_wide(spark, sf).select("apply_no", "target"), "apply_no", "target", 10).select("apply_no", "fold")
