"""Registered queries: bins, evidence, metrics, stability, profile, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import scoring
from riskloom.functions.scoring import to_score
from riskloom.operators import binning, profile, psi, rankm, select, sketches, woe
from riskloom.operators.hist import numeric_histogram, text_histogram
from riskloom.operators.prefix import rank_histogram
from riskloom.plans.bin_sql import CHI_POINT_SQL, fitted_bins_sql
from riskloom.plans.catalog_tables import BIN_SQL, EDGES, WITH, WITH_SPLIT, woe_columns
from riskloom.plans.fixtures import DOC_SQL, doc_quality, loan_wide, with_time_split
from riskloom.plans.jobs import model_statistics
from riskloom.plans.registry import N, R, auc_sql, query, rounded, score_sql, woe_sql
from riskloom.roles import FILL_VALUE, Roles
from riskloom.session import materialize, scratch_path

NUMBERS = ["f_price", "f_bal", "f_nation"]
WOE_OUT = ["n", "bad", "good", "cum_bad", "cum_good", "n_share", "bad_share", "good_share", "bad_rate",
           "cum_bad_share", "cum_good_share", "woe", "ks", "iv", "total_iv"]


# --- evidence of bins -------------------------------------------------------------------------


@query("bin_counts", f"{WITH}, {BIN_SQL.format(src='lw')} SELECT feature, bin_id, {N('n', 'n')}, {N('bad', 'bad')} FROM bc")
def bin_counts(spark, sf):
    return woe.bin_counts(loan_wide(spark, sf), EDGES, "target").select("feature", "bin_id", "n", "bad")


@query("woe_iv_table", f"{WITH}, {BIN_SQL.format(src='lw')}, {woe_sql('bc')} SELECT feature, bin_id, {woe_columns()} FROM wf")
def woe_iv_table(spark, sf):
    made = binning.manual_bins(loan_wide(spark, sf), EDGES, "target")
    return rounded(made.summary.select("feature", "bin_id", *WOE_OUT))


RAW_SQL = "bc AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, coalesce(CAST({c} AS DOUBLE), -999999) AS lo, count(*) AS n, sum(target) AS bad FROM lw GROUP BY 2" for c in NUMBERS
) + ")"


@query("woe_iv_raw_values", f"{WITH}, {RAW_SQL}, {woe_sql('bc')} SELECT feature, lo, {woe_columns()} FROM wf")
def woe_iv_raw_values(spark, sf):
    """Every distinct number a bin of its own, of all numeric features."""
    return rounded(woe.raw_woe_table(loan_wide(spark, sf), NUMBERS, "target").select("feature", "lo", *WOE_OUT))


@query("iv_list", f"{WITH}, {BIN_SQL.format(src='lw')}, {woe_sql('bc')} SELECT DISTINCT feature, {R('total_iv', 'total_iv')} FROM wf")
def iv_list(spark, sf):
    return rounded(woe.iv_list(woe.woe_table(woe.bin_counts(loan_wide(spark, sf), EDGES, "target"))))


@query("iv_ranking", f"{WITH}, {BIN_SQL.format(src='lw')}, {woe_sql('bc')} SELECT DISTINCT feature, {R('total_iv', 'total_iv')} FROM wf WHERE total_iv >= 0.02")
def iv_ranking(spark, sf):
    return rounded(select.features_by_iv(woe.woe_table(woe.bin_counts(loan_wide(spark, sf), EDGES, "target")), 0.02))


@query("manual_bins_update", f"""{WITH}, {BIN_SQL.format(src='lw')},
b2 AS (SELECT 'f_bal' AS feature, CASE WHEN f_bal < 4000 THEN 0 WHEN f_bal >= 4000 THEN 1 END AS bin_id, target FROM lw),
bm AS (SELECT feature, CAST(bin_id AS INTEGER) AS bin_id, lo, n, bad FROM bc WHERE feature = 'f_price' UNION ALL
       SELECT feature, CAST(bin_id AS INTEGER), CAST(bin_id AS DOUBLE), count(*), sum(target) FROM b2 GROUP BY feature, bin_id),
{woe_sql('bm')} SELECT feature, bin_id, {woe_columns()} FROM wf""")
def manual_bins_update(spark, sf):
    wide = loan_wide(spark, sf)
    first = binning.manual_bins(wide, EDGES, "target")
    second = binning.manual_bins(wide, {"f_bal": [float("-inf"), 4000.0, float("inf")]}, "target")
    return rounded(binning.update_bins(first, second).summary.select("feature", "bin_id", *WOE_OUT))


QUALITY_SQL = """
qb AS (SELECT feature, bin_id, n, bad, CAST(bad AS DOUBLE) / n AS rate FROM bc WHERE bin_id > 0),
qd AS (SELECT *, rate - lag(rate) OVER (PARTITION BY feature ORDER BY bin_id) AS step,
         CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY feature) AS share FROM qb)"""


@query("bin_quality", f"{WITH}, {BIN_SQL.format(src='lw')}, {QUALITY_SQL} SELECT feature, "
       f"min(share) > 0.05 AND (coalesce(min(step), 0) >= 0 OR coalesce(max(step), 0) <= 0) AS ok, {N('count(*)', 'n_bins')} FROM qd GROUP BY feature")
def bin_quality(spark, sf):
    counts = woe.bin_counts(loan_wide(spark, sf), EDGES, "target")
    return binning.quality(spark, counts, EDGES, binning.BinRules())


@query("woe_by_bin", f"{WITH}, {BIN_SQL.format(src='lw')}, {woe_sql('bc')}, x AS (SELECT feature, bin_id, woe FROM wf), "
       "pb AS (SELECT apply_no, "
       "CASE WHEN f_price IS NULL THEN NULL WHEN f_price < 50000 THEN 0 WHEN f_price < 100000 THEN 1 WHEN f_price < 150000 THEN 2 "
       "WHEN f_price < 200000 THEN 3 WHEN f_price < 300000 THEN 4 ELSE 5 END AS i, "
       "CASE WHEN f_bal IS NULL THEN NULL WHEN f_bal < 2000 THEN 0 WHEN f_bal < 5000 THEN 1 WHEN f_bal < 8000 THEN 2 ELSE 3 END AS j, c_nat FROM lw) "
       f"SELECT apply_no, c_nat, {R('a.woe', 'f_price')}, {R('b.woe', 'f_bal')} FROM pb "
       "LEFT JOIN x a ON a.feature = 'f_price' AND a.bin_id IS NOT DISTINCT FROM i LEFT JOIN x b ON b.feature = 'f_bal' AND b.bin_id IS NOT DISTINCT FROM j")
def woe_by_bin(spark, sf):
    wide = loan_wide(spark, sf)
    made = binning.manual_bins(wide, EDGES, "target")
    return rounded(woe.encode_bins(wide.select("apply_no", "c_nat", "f_price", "f_bal"), made.edges, made.woe()))


@query("category_woe_top", f"""{WITH}, l AS (SELECT 'c_nat' AS feature, coalesce(c_nat, 'miss') AS v, target FROM lw UNION ALL
SELECT 'c_seg', coalesce(c_seg, 'miss'), target FROM lw),
k AS (SELECT feature, v, count(*) AS n, sum(target) AS bad FROM l GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS place FROM k),
m AS (SELECT feature, CASE WHEN place <= 3 THEN v ELSE 'other' END AS key, sum(n) AS n, sum(bad) AS bad FROM t GROUP BY 1, 2),
s AS (SELECT feature, key, bad, CAST(bad AS DOUBLE) / sum(bad) OVER (PARTITION BY feature) AS bs,
  CAST(n - bad AS DOUBLE) / sum(n - bad) OVER (PARTITION BY feature) AS gs FROM m)
SELECT feature, key, {R("CASE WHEN bs = 0 THEN 0 ELSE ln((CASE WHEN gs = 0 THEN 1e-10 ELSE gs END) / bs) END", 'woe')} FROM s""")
def category_woe_top(spark, sf):
    return rounded(woe.top_category_woe_table(loan_wide(spark, sf), ["c_nat", "c_seg"], "target", 3))


@query("category_lookup_top", f"""{WITH}, tr AS (SELECT * FROM lw WHERE c_nat < 'NATION_2'), l AS (SELECT coalesce(c_nat, 'miss') AS v, target FROM tr),
k AS (SELECT v, count(*) AS n, sum(target) AS bad FROM l GROUP BY 1), t AS (SELECT *, row_number() OVER (ORDER BY n DESC, v) AS place FROM k),
m AS (SELECT CASE WHEN place <= 3 THEN v ELSE 'other' END AS key, sum(n) AS n, sum(bad) AS bad FROM t GROUP BY 1),
s AS (SELECT key, bad, CAST(bad AS DOUBLE) / sum(bad) OVER () AS bs, CAST(n - bad AS DOUBLE) / sum(n - bad) OVER () AS gs FROM m),
w AS (SELECT key, CASE WHEN bs = 0 THEN 0 ELSE ln((CASE WHEN gs = 0 THEN 1e-10 ELSE gs END) / bs) END AS woe FROM s)
SELECT apply_no, {R("coalesce(w.woe, (SELECT woe FROM w WHERE key = 'other'))", 'c_nat')} FROM lw LEFT JOIN w ON w.key = coalesce(c_nat, 'miss')""")
def category_lookup_top(spark, sf):
    wide = loan_wide(spark, sf)
    fitted = woe.top_category_woe_table(wide.where(F.col("c_nat") < "NATION_2"), ["c_nat"], "target", 3)
    return rounded(woe.encode_top_categories(wide.select("apply_no", "c_nat"), woe.woe_by_category(fitted)))


@query("doc_category_woe", f"""WITH {DOC_SQL}, l AS (SELECT 'lang' AS feature, lang AS v, target FROM dq UNION ALL SELECT 'source', source, target FROM dq),
k AS (SELECT feature, v, count(*) AS n, sum(target) AS bad FROM l WHERE v IS NOT NULL GROUP BY 1, 2),
s AS (SELECT feature, v AS key, bad, CAST(bad AS DOUBLE) / sum(bad) OVER (PARTITION BY feature) AS bs,
  CAST(n - bad AS DOUBLE) / sum(n - bad) OVER (PARTITION BY feature) AS gs FROM k)
SELECT feature, key, {R("CASE WHEN bs = 0 THEN 0 ELSE ln((CASE WHEN gs = 0 THEN 1e-10 ELSE gs END) / bs) END", 'woe')} FROM s
UNION ALL SELECT unnest(['lang', 'source']), '__other__', 0.0""")
def doc_category_woe(spark, sf):
    return rounded(woe.category_woe_table(doc_quality(spark, sf), ["lang", "source"], "target"))


# --- fitted bins ------------------------------------------------------------------------------


def _edges_frame(spark, made: binning.Binning):
    return binning.edge_table(spark, made.edges).select("feature", F.posexplode("edges").alias("position", "edge"))


@query("bins_equal_frequency", f"""{WITH}, l AS (SELECT 'f_price' AS feature, f_price AS v FROM lw UNION ALL SELECT 'f_bal', f_bal FROM lw
UNION ALL SELECT 'f_nation', CAST(f_nation AS DOUBLE) FROM lw),
q AS (SELECT feature, quantile_cont(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS a FROM l WHERE v IS NOT NULL GROUP BY feature),
u AS (SELECT DISTINCT feature, unnest(a) AS e FROM q),
d AS (SELECT feature, e FROM u QUALIFY e > min(e) OVER (PARTITION BY feature)),
f AS (SELECT feature, e FROM d UNION ALL SELECT DISTINCT feature, unnest([CAST('-inf' AS DOUBLE), -999998.999, CAST('inf' AS DOUBLE)]) FROM d)
SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY e) - 1 AS INTEGER) AS position, round(e, 6) AS edge FROM f""")
def bins_equal_frequency(spark, sf):
    rules = binning.BinRules(monotonic=False)
    made = binning.fit_bins(loan_wide(spark, sf), NUMBERS, "target", "equal_freq", rules)
    return _edges_frame(spark, made).withColumn("edge", F.round("edge", 6))


def _fitted(frame, method, numbers=NUMBERS):
    made = binning.fit_bins(frame, numbers, "target", method)
    return rounded(made.summary.select("feature", "bin_id", *WOE_OUT))


PLAIN_SQL = f"""{WITH.removeprefix('WITH ')}, l AS (SELECT 'f_price' AS feature, f_price AS v, target FROM lw UNION ALL SELECT 'f_bal', f_bal, target FROM lw
UNION ALL SELECT 'f_nation', CAST(f_nation AS DOUBLE), target FROM lw)"""


@query("bins_equal_frequency_monotonic", fitted_bins_sql(PLAIN_SQL, "equal_freq", woe_columns()))
def bins_equal_frequency_monotonic(spark, sf):
    return _fitted(loan_wide(spark, sf), "equal_freq")


@query("bins_decision_tree", fitted_bins_sql(PLAIN_SQL, "dt", woe_columns()))
def bins_decision_tree(spark, sf):
    return _fitted(loan_wide(spark, sf), "dt")


@query("tree_best_cut", f"""{WITH}, l AS (SELECT 'f_price' AS feature, f_price AS v, target FROM lw UNION ALL SELECT 'f_bal', f_bal, target FROM lw
UNION ALL SELECT 'f_nation', CAST(f_nation AS DOUBLE), target FROM lw),
hh AS (SELECT feature, v, count(*) AS n, sum(target) AS bad FROM l WHERE v IS NOT NULL GROUP BY 1, 2),
cu AS (SELECT feature, v, CAST(sum(n) OVER w AS DOUBLE) AS nl, CAST(sum(bad) OVER w AS DOUBLE) AS bl,
  CAST(sum(n) OVER (PARTITION BY feature) AS DOUBLE) AS nt, CAST(sum(bad) OVER (PARTITION BY feature) AS DOUBLE) AS bt
  FROM hh WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
nx AS (SELECT *, lead(v) OVER (PARTITION BY feature ORDER BY v) AS nxt, nt - nl AS nr, bt - bl AS br FROM cu),
gi AS (SELECT feature, (v + nxt) / 2 AS cut, v, (bl * bl + (nl - bl) * (nl - bl)) / nl + (br * br + (nr - br) * (nr - br)) / nr AS g
  FROM nx WHERE nl >= ceil(0.05 * nt) AND nr >= ceil(0.05 * nt))
SELECT feature, {R('cut', 'cut')} FROM gi QUALIFY row_number() OVER (PARTITION BY feature ORDER BY g DESC, v) = 1""")
def tree_best_cut(spark, sf):
    """The root cut of each feature's tree: the Gini search over every distinct value."""
    made = binning.fit_bins(loan_wide(spark, sf), NUMBERS, "target", "dt", binning.BinRules(n_bins=2))
    rows = [(f, edges[2]) for f, edges in made.edges.items()]
    return rounded(spark.createDataFrame(rows, "feature string, cut double"))


@query("bins_k_means", fitted_bins_sql(PLAIN_SQL, "kmeans", woe_columns()))
def bins_k_means(spark, sf):
    return _fitted(loan_wide(spark, sf), "kmeans")


@query("bins_chi_merge", fitted_bins_sql(PLAIN_SQL, "chi", woe_columns()))
def bins_chi_merge(spark, sf):
    return _fitted(loan_wide(spark, sf), "chi")


# Gaps filled by the special value, and prices of some orders without bounds.
SPECIAL_SQL = f"""{WITH.removeprefix('WITH ')}, l AS (SELECT 'f_price' AS feature,
  CASE WHEN apply_no % 97 = 0 THEN CAST('inf' AS DOUBLE) WHEN apply_no % 101 = 0 THEN CAST('-inf' AS DOUBLE) ELSE f_price END AS v, target FROM lw
UNION ALL SELECT 'f_bal', coalesce(f_bal, -999999), target FROM lw)"""


def _special(spark, sf):
    key, inf = F.col("apply_no"), float("inf")
    return loan_wide(spark, sf).select(
        "target", F.coalesce("f_bal", F.lit(FILL_VALUE)).alias("f_bal"),
        F.when(key % 97 == 0, F.lit(inf)).when(key % 101 == 0, F.lit(-inf)).otherwise(F.col("f_price")).alias("f_price"),
    )


@query("bins_special_equal_frequency", fitted_bins_sql(SPECIAL_SQL, "equal_freq", woe_columns()))
def bins_special_equal_frequency(spark, sf):
    """Special and infinite values: no say in the edges, but counted in the outer bins."""
    return _fitted(_special(spark, sf), "equal_freq", ["f_price", "f_bal"])


@query("bins_special_decision_tree", fitted_bins_sql(SPECIAL_SQL, "dt", woe_columns()))
def bins_special_decision_tree(spark, sf):
    return _fitted(_special(spark, sf), "dt", ["f_price", "f_bal"])


@query("bins_special_k_means", fitted_bins_sql(SPECIAL_SQL, "kmeans", woe_columns()))
def bins_special_k_means(spark, sf):
    return _fitted(_special(spark, sf), "kmeans", ["f_price", "f_bal"])


@query("bins_special_chi_merge", fitted_bins_sql(SPECIAL_SQL, "chi", woe_columns()))
def bins_special_chi_merge(spark, sf):
    return _fitted(_special(spark, sf), "chi", ["f_price", "f_bal"])


USABLE_SQL = f"WITH {PLAIN_SQL}, u AS (SELECT feature, v, target FROM l WHERE v IS NOT NULL), {CHI_POINT_SQL.strip()}"


def _usable(spark, sf):
    return numeric_histogram(loan_wide(spark, sf), NUMBERS, "target").where(F.col("value").isNotNull())


@query("equal_width_points", f"{USABLE_SQL} SELECT feature, round(key, 6) AS key, {N('n', 'n')}, {N('bad', 'bad')} FROM cp")
def equal_width_points(spark, sf):
    return binning.chi_points(_usable(spark, sf)).select("feature", F.round("key", 6).alias("key"), "n", "bad")


@query("adjacent_chi_square", f"""{USABLE_SQL},
a AS (SELECT feature, key, n, bad, lead(key) OVER w AS k2, lead(n) OVER w AS n2, lead(bad) OVER w AS b2 FROM cp WINDOW w AS (PARTITION BY feature ORDER BY key)),
r AS (SELECT *, CAST(bad + b2 AS DOUBLE) / (n + n2) AS r FROM a WHERE k2 IS NOT NULL)
SELECT feature, round(key, 6) AS key, {R("""CASE WHEN r IN (0, 1) THEN 0 ELSE
  (bad - n * r) ** 2 / (n * r) + (b2 - n2 * r) ** 2 / (n2 * r) + ((n - bad) - n * (1 - r)) ** 2 / (n * (1 - r)) +
  ((n2 - b2) - n2 * (1 - r)) ** 2 / (n2 * (1 - r)) END""", 'chi')} FROM r""")
def adjacent_chi_square(spark, sf):
    return rounded(binning.adjacent_chi(binning.chi_points(_usable(spark, sf))).select("feature", "key", "chi"))


@query("tuning_objective", f"{WITH_SPLIT}, {auc_sql('ls', 'type', 'p', 'm')}, t AS (SELECT max(auc) FILTER (WHERE g = 'train') AS a, max(auc) FILTER (WHERE g = 'test') AS b FROM m) "
       f"SELECT {R('a', 'train_auc')}, {R('b', 'test_auc')}, {R('100 * b - 2 ** abs(100 * b - 100 * a)', 'objective')} FROM t")
def tuning_objective(spark, sf):
    """What the parameter search maximises, of a given score by the two parts."""
    found = rankm.metrics_by_split(with_time_split(loan_wide(spark, sf)), "p", "target", "type")
    auc = {r["type"]: r["auc"] for r in found.collect()}  # four rows
    row = (auc["train"], auc["test"], scoring.tuning_objective(auc["train"], auc["test"]))
    return rounded(spark.createDataFrame([row], "train_auc double, test_auc double, objective double"))


# --- AUC and KS -------------------------------------------------------------------------------

SCORED_SQL = f"sc AS (SELECT *, {score_sql('p')} AS score FROM ls)"


def _scored(spark, sf):
    return with_time_split(loan_wide(spark, sf)).withColumn("score", to_score("p"))


@query("auc_ks_probability", f"{WITH}, {auc_sql('lw', chr(39) + 'all' + chr(39), 'p', 'm')} SELECT {R('auc', 'auc')}, {R('ks', 'ks')}, {N('n', 'n')}, {N('bad', 'bad')} FROM m")
def auc_ks_probability(spark, sf):
    return rounded(rankm.score_metrics(loan_wide(spark, sf), "p", "target"))


@query("auc_ks_by_split", f"{WITH_SPLIT}, {SCORED_SQL}, {auc_sql('sc', 'type', 'score', 'm')} "
       f"SELECT l.type, {R('auc', 'auc')}, {R('ks', 'ks')}, {N('n', 'n')}, {N('bad', 'bad')} FROM (SELECT unnest(['train', 'test', 'oot', 'cv']) AS type) l LEFT JOIN m ON g = l.type")
def auc_ks_by_split(spark, sf):
    return rounded(rankm.metrics_by_split(_scored(spark, sf), "score", "target", "type", bounded=True))


@query("auc_ks_by_month", f"{WITH_SPLIT}, {SCORED_SQL}, {auc_sql('sc', 'month', 'score', 'm')} SELECT g AS month, {R('auc', 'auc')}, {R('ks', 'ks')}, {N('n', 'n')}, {N('bad', 'bad')} FROM m")
def auc_ks_by_month(spark, sf):
    return rounded(rankm.score_metrics(_scored(spark, sf), "score", "target", ["month"], bounded=True))


FEATURE_SQL = """
fl AS (SELECT 'f_price' AS feature, coalesce(f_price, -999999) AS v, target FROM {src} UNION ALL SELECT 'f_bal', coalesce(f_bal, -999999), target FROM {src}
 UNION ALL SELECT 'f_nation', f_nation, target FROM {src} UNION ALL SELECT 'p', p, target FROM {src})"""


@query("auc_ks_by_feature", f"{WITH}, {FEATURE_SQL.format(src='lw')}, {auc_sql('fl', 'feature', 'v', 'm')} SELECT g AS feature, {R('auc', 'auc')}, {R('ks', 'ks')}, {N('n', 'n')}, {N('bad', 'bad')} FROM m")
def auc_ks_by_feature(spark, sf):
    return rounded(rankm.feature_metrics(loan_wide(spark, sf), [*NUMBERS, "p"], "target"))


@query("strong_features", f"{WITH}, {FEATURE_SQL.format(src='lw')}, {auc_sql('fl', 'feature', 'v', 'm')} SELECT g AS feature, {R('auc', 'auc')} FROM m WHERE auc > 0.51")
def strong_features(spark, sf):
    found = rankm.feature_metrics(loan_wide(spark, sf), [*NUMBERS, "p"], "target")
    return rounded(found.where(F.col("auc") > 0.51).select("feature", "auc"))


@query("doc_auc_ks", f"WITH {DOC_SQL}, {auc_sql('dq', 'lang', 'n_chars', 'm')} SELECT g AS lang, {R('auc', 'auc')}, {R('ks', 'ks')}, {N('n', 'n')}, {N('bad', 'bad')} FROM m")
def doc_auc_ks(spark, sf):
    return rounded(rankm.score_metrics(doc_quality(spark, sf), "n_chars", "target", ["lang"]))


@query("running_shares", f"""{WITH_SPLIT}, {SCORED_SQL}, h AS (SELECT score, count(*) AS n, sum(target) AS bad FROM sc GROUP BY score),
r AS (SELECT score, n, bad, CAST(sum(bad) OVER w AS DOUBLE) / sum(bad) OVER () AS cb, CAST(sum(n - bad) OVER w AS DOUBLE) / sum(n - bad) OVER () AS cg
  FROM h WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT score, {N('n', 'n')}, {N('bad', 'bad')}, {R('cb', 'cum_bad_share')}, {R('cg', 'cum_good_share')}, {R('abs(cb - cg)', 'gap')} FROM r""")
def running_shares(spark, sf):
    shares = rankm.running_shares(_scored(spark, sf), "score", "target", bounded=True)
    return rounded(shares.withColumn("score", F.col("score").cast("int")))


@query("metric_report", f"{WITH_SPLIT}, {SCORED_SQL}, {auc_sql('sc', 'type', 'score', 'm')} "
       "SELECT 'demo' AS project_name, 'demo' AS client_batch, 'p' AS feature, "
       + ", ".join(R(f"max(CASE WHEN g = '{s}' THEN {x} END)", f"{s}_{x}") for x in ("auc", "ks") for s in ("test", "train"))
       + ", 7 AS feature_cnt, 40 AS n_estimators FROM m")
def metric_report(spark, sf):
    reports = model_statistics(with_time_split(loan_wide(spark, sf)), "p", Roles(), "demo", "demo", 7, 40)
    return rounded(reports["report"])


DESC_SQL = f"""{WITH_SPLIT}, {SCORED_SQL}, d AS (SELECT 'p' AS feature, p AS t FROM sc UNION ALL SELECT 'score', score FROM sc UNION ALL SELECT 'f_bal', f_bal FROM sc)
SELECT feature, {N('count(t)', '"count"')}, {R('avg(t)', 'mean')}, {R('stddev_samp(t)', 'std', 5)}, {R('min(t)', 'min')},
  {R('quantile_cont(t, 0.25)', 'q25')}, {R('quantile_cont(t, 0.5)', 'q50')}, {R('quantile_cont(t, 0.75)', 'q75')}, {R('max(t)', 'max')},
  {R('count(t) / CAST(count(*) AS DOUBLE)', 'coverage')} FROM d GROUP BY feature"""


@query("score_describe", DESC_SQL)
def score_describe(spark, sf):
    out = profile.describe_scores(_scored(spark, sf), ["p", "score", "f_bal"])
    return rounded(out.withColumn("std", F.round("std", 5)))


# --- stability --------------------------------------------------------------------------------

PSI_SQL = """
pl AS (SELECT type, 'c_seg' AS feature, c_seg AS value FROM ls UNION ALL SELECT type, 'c_prio', c_prio FROM ls
  UNION ALL SELECT type, 'f_nation', CAST(f_nation AS VARCHAR) FROM ls),
pc AS (SELECT feature, value, count(*) FILTER (WHERE type = 'test') AS cn, count(*) FILTER (WHERE type = 'train') AS bn
  FROM pl WHERE type IN ('test', 'train') GROUP BY 1, 2),
ps AS (SELECT feature, value, CASE WHEN cn > 0 THEN CAST(cn AS DOUBLE) / sum(cn) OVER (PARTITION BY feature) END AS x,
  CASE WHEN bn > 0 THEN CAST(bn AS DOUBLE) / sum(bn) OVER (PARTITION BY feature) END AS y FROM pc)"""
PSI_COLUMNS = ["c_seg", "c_prio", "f_nation"]


def _sides(spark, sf):
    wide = with_time_split(loan_wide(spark, sf))
    return wide.where(F.col("type") == "test"), wide.where(F.col("type") == "train")


@query("column_psi", f"{WITH_SPLIT}, {PSI_SQL} SELECT feature, {R('coalesce(sum((x - y) * ln(x / y)), 0)', 'psi', 9)} FROM ps GROUP BY feature")
def column_psi(spark, sf):
    return rounded(psi.psi_of_columns(*_sides(spark, sf), PSI_COLUMNS), 9)


@query("column_psi_detail", f"{WITH_SPLIT}, {PSI_SQL} SELECT feature, value, {R('x', 'current_share')}, {R('y', 'base_share')} FROM ps")
def column_psi_detail(spark, sf):
    return rounded(psi.psi_detail(*_sides(spark, sf), PSI_COLUMNS))


SCORE_PSI_SQL = """
bt AS (SELECT strftime(apply_time, '%Y') AS client_batch, CASE WHEN apply_no % 4 = 0 THEN 'test' WHEN apply_no % 4 = 1 THEN 'oot' ELSE 'train' END AS type,
  CASE WHEN f_price IS NOT NULL THEN p END AS p FROM lw),
bs AS (SELECT *, CASE WHEN p IS NOT NULL THEN {score} END AS s FROM bt),
tot AS (SELECT client_batch, count(s) FILTER (WHERE type = 'train') AS tr, count(s) FILTER (WHERE type = 'test') AS te,
  count(s) FILTER (WHERE type = 'oot') AS oo FROM bs GROUP BY 1),
gr AS (SELECT client_batch, tr, te, oo, unnest(range(300, 950, 50)) AS lo FROM tot),
sh AS (SELECT g.client_batch, 'p' AS feature, '[' || lo || ', ' || (lo + 50) || ')' AS bin,
  count(s) FILTER (WHERE type = 'train') / CAST(max(tr) AS DOUBLE) AS train_pct,
  count(s) FILTER (WHERE type = 'test') / CAST(max(te) AS DOUBLE) AS test_pct,
  count(s) FILTER (WHERE type = 'oot') / CAST(max(oo) AS DOUBLE) AS oot_pct
  FROM gr g LEFT JOIN bs b ON b.client_batch = g.client_batch AND s >= lo AND s < lo + 50 GROUP BY g.client_batch, lo),
dt AS (SELECT *, CASE WHEN train_pct > 0 AND test_pct > 0 THEN (train_pct - test_pct) * ln(train_pct / test_pct) END AS train_test_psi,
  CASE WHEN train_pct > 0 AND oot_pct > 0 THEN (train_pct - oot_pct) * ln(train_pct / oot_pct) END AS train_oot_psi FROM sh),
su AS (SELECT client_batch, feature, '[sum]' AS bin, sum(train_pct) AS train_pct, sum(test_pct) AS test_pct, sum(oot_pct) AS oot_pct,
  coalesce(sum(train_test_psi), 0) AS train_test_psi, coalesce(sum(train_oot_psi), 0) AS train_oot_psi FROM dt GROUP BY 1, 2),
al AS (SELECT * FROM dt UNION ALL BY NAME SELECT * FROM su)""".replace("{score}", score_sql("p"))
PSI_MEASURES = ["train_pct", "test_pct", "oot_pct", "train_test_psi", "train_oot_psi"]


def _batched(spark, sf):
    kind = F.col("apply_no") % 4
    return loan_wide(spark, sf).select(
        F.date_format("apply_time", "yyyy").alias("client_batch"),
        F.when(kind == 0, "test").when(kind == 1, "oot").otherwise("train").alias("type"),
        F.when(F.col("f_price").isNotNull(), F.col("p")).alias("p"),
    )


@query("score_psi_detail", f"{WITH}, {SCORE_PSI_SQL} SELECT client_batch, feature, bin, {', '.join(R(m, m) for m in PSI_MEASURES)} FROM al")
def score_psi_detail(spark, sf):
    return rounded(psi.score_psi_detail(_batched(spark, sf), ["p"], "client_batch", "type", ("train", "test", "oot")))


@query("score_psi", f"{WITH}, {SCORE_PSI_SQL} SELECT client_batch, feature, {R('train_test_psi', 'train_test_psi')}, {R('train_oot_psi', 'train_oot_psi')} FROM su")
def score_psi(spark, sf):
    return rounded(psi.score_psi(_batched(spark, sf), ["p"], "client_batch", "type", ("train", "test", "oot")))


# --- profile ----------------------------------------------------------------------------------


@query("numeric_describe", f"""{WITH}, d AS (SELECT 'f_price' AS feature, f_price AS t FROM lw UNION ALL SELECT 'f_bal', f_bal FROM lw UNION ALL SELECT 'f_nation', f_nation FROM lw)
SELECT feature, {N('count(t)', '"count"')}, {R('avg(t)', 'mean')}, {R('stddev_samp(t)', 'std', 5)}, {R('min(t)', 'min')}, {R('max(t)', 'max')},
  {', '.join(R(f'quantile_cont(t, {p})', f'q{int(p * 100)}') for p in profile.PERCENTILES)} FROM d GROUP BY feature""")
def numeric_describe(spark, sf):
    stats = profile.describe_numbers(numeric_histogram(loan_wide(spark, sf), NUMBERS))
    cuts = [F.get("quantiles", F.lit(i)).alias(f"q{int(p * 100)}") for i, p in enumerate(profile.PERCENTILES)]
    out = stats.select("feature", "count", "mean", "std", "min", "max", *cuts)
    return rounded(out.withColumn("std", F.round("std", 5)))


@query("monthly_sketches", f"""{WITH}, d AS (SELECT 'f_price' AS feature, f_price AS t FROM lw UNION ALL SELECT 'f_bal', f_bal FROM lw UNION ALL SELECT 'f_nation', f_nation FROM lw)
SELECT feature, {N('count(t)', '"count"')}, {R('avg(t)', 'mean')}, {R('stddev_samp(t)', 'std', 5)}, {R('min(t)', 'min')}, {R('max(t)', 'max')},
  CAST({len(profile.PERCENTILES)} AS BIGINT) AS near FROM d GROUP BY feature""")
def monthly_sketches(spark, sf):
    """Months are summarised on their own, stored, read back and merged; ``near`` counts the quantiles whose rank is off by less than 1 %."""
    wide = loan_wide(spark, sf)
    folder = scratch_path(spark, "sketches")
    sketches.store_sketches(sketches.batch_sketches(wide, NUMBERS, "month"), folder)
    merged = sketches.describe_sketches(sketches.merge_sketches(sketches.read_sketches(spark, folder)))
    hist, rows = materialize(numeric_histogram(wide, NUMBERS, "target"), "sketched")
    ranked = rank_histogram(hist, ["feature"], stored_rows=rows).rows
    cuts = merged.select(F.col("feature").alias("f"), F.posexplode("quantiles").alias("place", "cut"))  # a few per feature
    prob = F.get(F.array(*[F.lit(p) for p in profile.PERCENTILES]), F.col("place"))
    met = ranked.join(F.broadcast(cuts), (F.col("feature") == F.col("f")) & (F.col("value") == F.col("cut")))
    low, high = F.col("n_before") / F.col("n_total"), (F.col("n_before") + F.col("n")) / F.col("n_total")
    near = met.where((low <= prob + 0.01) & (high >= prob - 0.01)).groupBy("feature").agg(F.count(F.lit(1)).alias("near"))
    out = merged.select("feature", "count", "mean", F.round("std", 5).alias("std"), "min", "max").join(near, "feature", "left")
    return rounded(out)


FREQ_SQL = """
fv AS (SELECT 'c_seg' AS feature, c_seg AS v FROM lw UNION ALL SELECT 'c_nat', c_nat FROM lw UNION ALL SELECT 'c_prio', c_prio FROM lw),
fc AS (SELECT feature, v, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature) AS size FROM fv GROUP BY feature, v),
fr AS (SELECT feature, v, n, size, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS t,
  row_number() OVER (PARTITION BY feature ORDER BY n, v DESC) AS b FROM fc WHERE v IS NOT NULL),
fx AS (SELECT feature, 'top' AS kind, CAST(t AS INTEGER) AS place, v || ':' || printf('%.2f%%', 100.0 * n / size) AS text FROM fr WHERE t <= 5 UNION ALL
  SELECT feature, 'bottom', CAST(b AS INTEGER), v || ':' || printf('%.2f%%', 100.0 * n / size) FROM fr WHERE b <= 5)"""


@query("frequent_values", f"{WITH}, {FREQ_SQL} SELECT * FROM fx")
def frequent_values(spark, sf):
    return profile.frequent_values(text_histogram(loan_wide(spark, sf), ["c_seg", "c_nat", "c_prio"]))


@query("value_shape", f"""{WITH}, d AS (SELECT 'f_price' AS feature, CAST(f_price AS VARCHAR) AS v FROM lw UNION ALL SELECT 'f_nation', CAST(f_nation AS VARCHAR) FROM lw
UNION ALL SELECT 'f_sparse', CAST(f_sparse AS VARCHAR) FROM lw UNION ALL SELECT 'c_seg', c_seg FROM lw), k AS (SELECT feature, v, count(*) AS n FROM d GROUP BY 1, 2)
SELECT feature, {N('sum(n)', 'size')}, {R('coalesce(sum(n) FILTER (WHERE v IS NULL), 0) / CAST(sum(n) AS DOUBLE)', 'missing_q')},
  {N('count(v)', '"unique"')}, {R('max(n) / CAST(sum(n) AS DOUBLE)', 'value_max_percent')} FROM k GROUP BY feature""")
def value_shape(spark, sf):
    return rounded(profile.value_shape(text_histogram(loan_wide(spark, sf), ["f_price", "f_nation", "f_sparse", "c_seg"])))


@query("blank_counts", f"""{WITH}, d AS (SELECT 'f_price' AS feature, f_price IS NULL AS b FROM lw UNION ALL SELECT 'c_seg', c_seg IS NULL FROM lw UNION ALL SELECT 'f_nation', f_nation IS NULL FROM lw)
SELECT feature, {N('count(*) FILTER (WHERE b)', 'blanks')}, printf('%.2f%%', 100.0 * count(*) FILTER (WHERE b) / count(*)) AS blank_text,
 {R('count(*) FILTER (WHERE b) / CAST(count(*) AS DOUBLE)', 'blank_share')} FROM d GROUP BY feature""")
def blank_counts(spark, sf):
    return rounded(profile.blank_counts(loan_wide(spark, sf), ["f_price", "c_seg", "f_nation"]))


def _profile_sql() -> str:
    def text(e):
        return f"printf('%.6f', round({e}, 6))"

    values = ["avg(x)", "stddev_samp(x)", "min(x)", *[f"quantile_cont(x, {p})" for p in profile.PERCENTILES], "max(x)"]
    numeric = ", ".join(f"{text(v)} AS \"{n}\"" for v, n in zip(values, profile.DETAIL_NAMES))
    slots = [(s[:-1], s[-1]) for s in profile.DISCRETE_NAMES]
    discrete = ", ".join(f"max(CASE WHEN kind = '{k}' AND place = {i} THEN text END) AS \"{n}\"" for (k, i), n in zip(slots, profile.DETAIL_NAMES))
    return f"""{WITH}, {FREQ_SQL}, nv AS (SELECT 'f_price' AS feature, 'double' AS type, f_price AS x FROM lw UNION ALL SELECT 'f_nation', 'int', f_nation FROM lw),
av AS (SELECT feature, type, CAST(x AS VARCHAR) AS v FROM nv UNION ALL SELECT feature, 'string', v FROM fv),
ac AS (SELECT feature, type, v, count(*) AS n FROM av GROUP BY 1, 2, 3),
sh AS (SELECT feature, type, {N('sum(n)', 'size')}, coalesce(sum(n) FILTER (WHERE v IS NULL), 0) / CAST(sum(n) AS DOUBLE) AS mq, count(v) AS u, max(n) / CAST(sum(n) AS DOUBLE) AS mp FROM ac GROUP BY 1, 2),
dt AS (SELECT feature, {numeric} FROM nv GROUP BY feature UNION ALL SELECT feature, {discrete} FROM fx GROUP BY feature)
SELECT feature, type, size, printf('%.2f%%', 100 * mq) AS missing, {R('mq', 'missing_q')}, {N('u', '"unique"')}, {R('mp', 'value_max_percent')},
 {', '.join(f'"{n}"' for n in profile.DETAIL_NAMES)} FROM sh JOIN dt USING (feature)"""


@query("data_profile", _profile_sql())
def data_profile(spark, sf):
    return rounded(profile.profile(loan_wide(spark, sf), ["f_price", "f_nation", "c_seg", "c_nat", "c_prio"]))


# --- correlation and selection ----------------------------------------------------------------

CORR_COLUMNS = ["f_price", "f_bal", "f_price2", "f_nation", "p"]


def _pairs_sql(fill: bool = False) -> str:
    col = (lambda c: f"coalesce({c}, -999)") if fill else (lambda c: c)
    pairs = [(a, b) for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1:]]
    return "cp AS (" + " UNION ALL ".join(f"SELECT '{a}' AS f1, '{b}' AS f2, corr({col(a)}, {col(b)}) AS r FROM lw" for a, b in pairs) + ")"


@query("correlation_pairs", f"{WITH}, {_pairs_sql()} SELECT f1, f2, {R('r', 'corr')} FROM cp")
def correlation_pairs(spark, sf):
    return rounded(select.pairwise_corr(loan_wide(spark, sf), CORR_COLUMNS))


@query("correlation_many_pairs", f"{WITH}, {_pairs_sql()} SELECT f1, f2, {R('r', 'corr')} FROM cp")
def correlation_many_pairs(spark, sf):
    return rounded(select.corr_by_products(loan_wide(spark, sf), CORR_COLUMNS))


@query("correlation_table", f"{WITH}, {_pairs_sql()}, b AS (SELECT f1, f2, r FROM cp UNION ALL SELECT f2, f1, r FROM cp UNION ALL SELECT unnest({CORR_COLUMNS}), unnest({CORR_COLUMNS}), 1) "
       "SELECT f1 AS feature, " + ", ".join(R(f"max(CASE WHEN f2 = '{c}' THEN r END)", c) for c in CORR_COLUMNS) + " FROM b GROUP BY f1")
def correlation_table(spark, sf):
    return rounded(select.corr_table(loan_wide(spark, sf), CORR_COLUMNS))


@query("filled_correlation", f"{WITH}, {_pairs_sql(True)} SELECT f1, f2, {R('abs(r)', 'abs_corr')} FROM cp")
def filled_correlation(spark, sf):
    return rounded(select.filled_corr_table(loan_wide(spark, sf), CORR_COLUMNS))


PRUNE_SQL = f"""{WITH}, {_pairs_sql(True)}, {FEATURE_SQL.format(src='lw')},
f2 AS (SELECT * FROM fl UNION ALL SELECT 'f_price2', f_price2, target FROM lw), {auc_sql('f2', 'feature', 'v', 'm')},
im AS (SELECT g AS feature, abs(auc - 0.5) AS w, row_number() OVER (ORDER BY abs(auc - 0.5) DESC, g) AS i FROM m),
pr AS (SELECT f1 AS a, f2 AS b, abs(r) AS r FROM cp UNION ALL SELECT f2, f1, abs(r) FROM cp),
WALK
SELECT feature FROM im WHERE feature NOT IN (SELECT unnest(dropped) FROM walk WHERE i = (SELECT max(i) FROM walk))"""
WALK_SQL = """walk(i, dropped) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) UNION ALL
SELECT walk.i + 1, CASE WHEN list_contains(dropped, im.feature) THEN dropped ELSE list_concat(dropped,
  coalesce((SELECT list(b) FROM pr JOIN im o ON o.feature = b WHERE a = im.feature AND r > 0.9 AND o.w <= im.w), CAST([] AS VARCHAR[]))) END
FROM walk JOIN im ON im.i = walk.i + 1)"""


@query("correlation_pruning", PRUNE_SQL.replace("WALK", WALK_SQL, 1).replace("WITH ", "WITH RECURSIVE ", 1))
def correlation_pruning(spark, sf):
    wide = loan_wide(spark, sf).select("target", *CORR_COLUMNS)
    found = rankm.feature_metrics(wide, CORR_COLUMNS, "target").select("feature", F.abs(F.col("auc") - 0.5).alias("w"))
    weights = {r["feature"]: r["w"] for r in found.collect()}
    kept, _ = select.drop_correlated(wide.drop("target"), weights, 0.9)
    return spark.createDataFrame([(c,) for c in kept.columns], "feature string")


@query("forward_selection", f"{WITH}, {_pairs_sql()}, o AS (SELECT unnest(range(5)) AS position, unnest({CORR_COLUMNS}) AS feature) "
       "SELECT CAST(position AS INTEGER) AS position, feature FROM o WHERE NOT EXISTS (SELECT 1 FROM cp WHERE f2 = feature AND abs(r) >= 0.5)")
def forward_selection(spark, sf):
    return select.forward_kept(loan_wide(spark, sf), CORR_COLUMNS)


# Runs are order priorities, features are nations, weights are counts of orders.
IMPORTANCE_SQL = """ru AS (SELECT c_prio AS run, c_nat AS feature, count(*) AS weight FROM lw GROUP BY 1, 2),
mi AS (SELECT feature, avg(weight) AS mean_imp FROM ru GROUP BY feature)"""


def _runs(spark, sf):
    return loan_wide(spark, sf).groupBy(F.col("c_prio").alias("run"), F.col("c_nat").alias("feature")).agg(F.count(F.lit(1)).alias("weight"))


@query("mean_importance", f"{WITH}, {IMPORTANCE_SQL} SELECT feature, {R('mean_imp', 'mean_imp')}, "
       "CAST(row_number() OVER (ORDER BY mean_imp DESC, feature) AS INTEGER) AS place FROM mi")
def mean_importance(spark, sf):
    return rounded(select.ranked_importance(select.mean_importance(_runs(spark, sf))))


@query("top_features", f"{WITH}, {IMPORTANCE_SQL} SELECT feature FROM mi ORDER BY mean_imp DESC, feature LIMIT 5")
def top_features(spark, sf):
    imp, _ = materialize(select.mean_importance(_runs(spark, sf)), "importance")
    return spark.createDataFrame([(f,) for f in select.top_features(imp, 5)], "feature string")
