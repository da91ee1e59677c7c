"""SQL for fitted bins: proposals of each method by recursion over the rows, and the choice among them."""

from __future__ import annotations

from riskloom.plans.registry import woe_sql

# Upper edge of the special bin.
FLOOR = -999998.999
TOP = 10


def equal_frequency_sql() -> str:
    steps = " UNION ALL ".join(
        f"SELECT feature, {n} AS k, list_sort(list_distinct(quantile_cont(v, [{', '.join(repr(i / n) for i in range(n))}])))[2:] AS e FROM u GROUP BY feature"
        for n in range(2, TOP + 1)
    )
    return f"cd AS ({steps})"


def k_means_sql() -> str:
    """Lloyd's rounds over all values from equal-frequency centres until they move by no more than the tolerance."""
    starts = " UNION ALL ".join(
        f"SELECT feature, {n} AS k, list_sort(list_distinct(quantile_cont(v, [{', '.join(repr((2 * i + 1) / (2 * n)) for i in range(n))}]))) AS c FROM u GROUP BY feature"
        for n in range(2, TOP + 1)
    )
    return f"""
kh AS MATERIALIZED (SELECT feature, v, count(*) AS n FROM u GROUP BY ALL),
ka AS (SELECT feature, sum(n * v) / sum(n) AS mean FROM kh GROUP BY feature),
kv AS (SELECT feature, sum(n * (v - mean) * (v - mean)) / sum(n) AS spread FROM kh JOIN ka USING (feature) GROUP BY feature),
ks AS ({starts}),
km(feature, k, spread, c, done) AS (
  SELECT feature, k, spread, c, len(c) < 2 FROM ks JOIN kv USING (feature)
  UNION ALL
  SELECT feature, k, spread, c2, list_sum(list_transform(list_zip(c, c2), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) <= 1e-4 * spread
  FROM (SELECT feature, k, spread, c, list_sort(list_transform(range(1, len(c) + 1), lambda i: coalesce(map_from_entries(list((cell, mean)))[i - 1], c[i]))) AS c2
    FROM (SELECT feature, k, spread, c, cell, sum(n * v) / sum(n) AS mean
      FROM (SELECT km.feature, k, spread, c, v, n, len(list_filter(range(1, len(c)), lambda i: (c[i] + c[i + 1]) / 2 <= v)) AS cell
        FROM km JOIN kh ON km.feature = kh.feature WHERE NOT done)
      GROUP BY ALL)
    GROUP BY feature, k, spread, c)),
cd AS (SELECT feature, k, list_sort(list_distinct(list_transform(range(1, len(c)), lambda i: (c[i] + c[i + 1]) / 2))) AS e FROM km WHERE done)"""


def _purity(n: str, bad: str) -> str:
    return f"(CAST({bad} AS DOUBLE) * {bad} + CAST({n} - {bad} AS DOUBLE) * ({n} - {bad})) / {n}"


def _best_cut(rows: str) -> str:
    """Nodes of ``rows`` with the best cut of the fresh ones; the lowest of equal ones."""
    left_n, left_bad = "(c.nb + c.n - y.n0)", "(c.bb + c.bad - y.b0)"
    right_n, right_bad = "(y.n1 - c.nb - c.n)", "(y.b1 - c.bb - c.bad)"
    score = f"{_purity(left_n, left_bad)} + {_purity(right_n, right_bad)}"
    whole = _purity("(y.n1 - y.n0)", "(y.b1 - y.b0)")
    return f"""SELECT y.feature, y.step, y.node, y.n0, y.b0, y.n1, y.b1, y.leaf,
    CASE WHEN y.fresh THEN max({score}) - {whole} ELSE y.gain END AS gain,
    CASE WHEN y.fresh THEN first((c.v + c.nxt) / 2 ORDER BY {score} DESC, c.v) ELSE y.cut END AS cut,
    CASE WHEN y.fresh THEN first(c.nb + c.n ORDER BY {score} DESC, c.v) ELSE y.mn END AS mn,
    CASE WHEN y.fresh THEN first(c.bb + c.bad ORDER BY {score} DESC, c.v) ELSE y.mb END AS mb
  FROM ({rows}) y LEFT JOIN tc c ON y.fresh AND c.feature = y.feature AND c.nb >= y.n0 AND c.nb + c.n < y.n1 AND {left_n} >= y.leaf AND {right_n} >= y.leaf
    AND y.n1 - y.n0 >= 2 * y.leaf AND y.b1 > y.b0 AND y.b1 - y.b0 < y.n1 - y.n0
  GROUP BY y.feature, y.step, y.node, y.n0, y.b0, y.n1, y.b1, y.leaf, y.fresh, y.gain, y.cut, y.mn, y.mb"""


def decision_tree_sql() -> str:
    """A best-first tree: each step cuts the leaf of the highest gain at its best place."""
    root = """SELECT feature, 1 AS step, CAST(1 AS BIGINT) AS node, CAST(0 AS BIGINT) AS n0, CAST(0 AS BIGINT) AS b0, n1, b1, leaf, true AS fresh,
      CAST(NULL AS DOUBLE) AS gain, CAST(NULL AS DOUBLE) AS cut, CAST(NULL AS BIGINT) AS mn, CAST(NULL AS BIGINT) AS mb FROM tt"""
    split = f"""SELECT feature, step + 1 AS step, CASE WHEN hit THEN 2 * node + side ELSE node END AS node,
      CASE WHEN hit AND side = 1 THEN mn ELSE n0 END AS n0, CASE WHEN hit AND side = 1 THEN mb ELSE b0 END AS b0,
      CASE WHEN hit AND side = 0 THEN mn ELSE n1 END AS n1, CASE WHEN hit AND side = 0 THEN mb ELSE b1 END AS b1, leaf, hit AS fresh,
      CASE WHEN hit THEN NULL ELSE gain END AS gain, CASE WHEN hit THEN NULL ELSE cut END AS cut,
      CASE WHEN hit THEN NULL ELSE mn END AS mn, CASE WHEN hit THEN NULL ELSE mb END AS mb
    FROM (SELECT *, gain IS NOT NULL AND row_number() OVER (PARTITION BY feature ORDER BY gain DESC NULLS LAST, node) = 1 AS hit FROM tr WHERE step < {TOP}) w,
      (SELECT unnest([0, 1]) AS side) s WHERE hit OR side = 0"""
    return f"""
th AS (SELECT feature, v, count(*) AS n, CAST(sum(target) AS BIGINT) AS bad FROM u GROUP BY 1, 2),
tc AS MATERIALIZED (SELECT feature, v, n, bad, CAST(sum(n) OVER w - n AS BIGINT) AS nb, CAST(sum(bad) OVER w - bad AS BIGINT) AS bb,
  lead(v) OVER (PARTITION BY feature ORDER BY v) AS nxt FROM th WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
tt AS (SELECT feature, CAST(sum(n) AS BIGINT) AS n1, CAST(sum(bad) AS BIGINT) AS b1, CAST(greatest(1, ceil(0.05 * sum(n))) AS BIGINT) AS leaf FROM th GROUP BY 1),
tr(feature, step, node, n0, b0, n1, b1, leaf, gain, cut, mn, mb) AS ({_best_cut(root)} UNION ALL {_best_cut(split)}),
tp AS (SELECT feature, step, cut FROM tr WHERE gain IS NOT NULL QUALIFY row_number() OVER (PARTITION BY feature, step ORDER BY gain DESC, node) = 1),
cd AS (SELECT feature, k, list_sort(list(cut)) AS e FROM tp, range(2, {TOP + 1}) r(k) WHERE step < k GROUP BY feature, k)"""


# (feature, key, coarse, n, bad): points of chi-merge, equal-width ones where a feature has 100 or more distinct values.
CHI_POINT_SQL = """
cs AS (SELECT feature, min(v) AS low, (max(v) - min(v)) / 100 AS size, count(DISTINCT v) >= 100 AS coarse FROM u GROUP BY feature),
cq AS (SELECT feature, low + i * size AS point FROM cs, range(1, 101) r(i)),
cx AS (SELECT DISTINCT feature, v FROM u),
ck AS (SELECT cx.feature, cx.v, coalesce(min(point), CAST('inf' AS DOUBLE)) AS point FROM cx LEFT JOIN cq ON cx.feature = cq.feature AND point > cx.v GROUP BY ALL),
cp AS (SELECT u.feature, CASE WHEN coarse THEN point ELSE u.v END AS key, coarse, count(*) AS n, CAST(sum(target) AS BIGINT) AS bad
  FROM u JOIN cs ON u.feature = cs.feature JOIN ck ON u.feature = ck.feature AND u.v = ck.v GROUP BY ALL)"""


def chi_merge_sql() -> str:
    """The least different neighbours are merged one pair a step; cuts are noted for each wanted number of bins."""
    both = "(n[i] + n[i + 1])"
    rate = f"(CAST(bad[i] + bad[i + 1] AS DOUBLE) / {both})"
    off = [f"(bad[i{p}] - n[i{p}] * {rate})" for p in ("", " + 1")]
    spread = f"({off[0]} * {off[0]} / n[i] + {off[1]} * {off[1]} / n[i + 1])"
    chi = f"CASE WHEN bad[i] + bad[i + 1] IN (0, n[i] + n[i + 1]) THEN 0 ELSE {spread} / {rate} + {spread} / (1 - {rate}) END"
    gone = "(list_position(chis, list_min(chis)) + 1)"

    def joined(c: str, spot: str = "spot") -> str:
        return f"list_concat(list_concat({c}[:{spot} - 2], [{c}[{spot} - 1] + {c}[{spot}]]), {c}[{spot} + 1:])"

    return f"""
{CHI_POINT_SQL.strip()},
cl AS (SELECT feature, any_value(coarse) AS coarse, list(key ORDER BY key) AS key, list(n ORDER BY key) AS n, list(bad ORDER BY key) AS bad, CAST(sum(n) AS BIGINT) AS total FROM cp GROUP BY feature),
cm(feature, coarse, total, wanted, key, n, bad, noted) AS (
  SELECT feature, coarse, total, {TOP}, key, n, bad, false FROM cl
  UNION ALL
  SELECT feature, coarse, total, CASE WHEN enough THEN wanted - 1 ELSE wanted END,
    CASE WHEN enough THEN key ELSE list_concat(key[:spot - 1 - CAST(coarse AS INTEGER)], key[spot + 1 - CAST(coarse AS INTEGER):]) END,
    CASE WHEN enough THEN n ELSE {joined('n')} END, CASE WHEN enough THEN bad ELSE {joined('bad')} END, enough
  FROM (SELECT *, {gone} AS spot FROM (SELECT *, len(n) < 2 OR (len(n) <= wanted AND CAST(list_min(n) AS DOUBLE) / total > 0.05) AS enough,
    list_transform(range(1, len(n)), lambda i: {chi}) AS chis FROM cm WHERE wanted >= 2))),
cd AS (SELECT feature, wanted + 1 AS k, list_sort(list_distinct(CASE WHEN coarse THEN key[:-2] ELSE key[2:] END)) AS e FROM cm WHERE noted)"""


METHODS = {"equal_freq": equal_frequency_sql, "dt": decision_tree_sql, "kmeans": k_means_sql, "chi": chi_merge_sql}


def fitted_bins_sql(source: str, method: str, columns: str) -> str:
    """Evidence of the bins that ``method`` fits to the rows (feature, v, target) of the CTEs ``source``, whose last one is l.

    ``u`` holds the values that have a say in the edges. The largest passing number of bins is kept.
    """
    return f"""WITH RECURSIVE {source},
u AS MATERIALIZED (SELECT feature, v, target FROM l WHERE v <> -999999 AND isfinite(v)),
{METHODS[method]().strip()},
ce AS (SELECT feature, k, list_filter(e, lambda x: x > {FLOOR}) AS e FROM cd),
bb AS (SELECT l.feature, k, any_value(e) AS e, CASE WHEN v < {FLOOR} THEN -1 ELSE len(list_filter(e, lambda x: x <= v)) END AS b, count(*) AS n, sum(target) AS bad
  FROM l JOIN ce ON l.feature = ce.feature WHERE v IS NOT NULL GROUP BY l.feature, k, 4),
jd AS (SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY feature, k) AS share,
  CAST(bad AS DOUBLE) / n - lag(CAST(bad AS DOUBLE) / n) OVER (PARTITION BY feature, k ORDER BY b) AS step FROM bb WHERE b >= 0),
ok AS (SELECT feature, k, len(any_value(e)) + 1 AS size, min(share) > 0.05 AND count(*) = len(any_value(e)) + 1
  AND (coalesce(min(step), 0) >= 0 OR coalesce(max(step), 0) <= 0) AS fine FROM jd GROUP BY feature, k),
pk AS (SELECT feature, coalesce(max(k) FILTER (WHERE fine OR size <= 2), min(k)) AS k FROM ok GROUP BY feature),
bc AS (SELECT bb.feature, CAST(b + 1 AS INTEGER) AS bin_id, CAST(b AS DOUBLE) AS lo, n, bad FROM bb JOIN pk ON bb.feature = pk.feature AND bb.k = pk.k
  UNION ALL SELECT feature, NULL, NULL, count(*), sum(target) FROM l WHERE v IS NULL GROUP BY feature),
{woe_sql('bc')} SELECT feature, bin_id, {columns} FROM wf"""
