"""Registry pairing each query with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is checked by tests on small fixtures instead."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, negative zero made plain."""
    return df.select(
        *[
            (F.round(f.name, digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def R(expr: str, name: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name}"


def N(expr: str, name: str, kind: str = "BIGINT") -> str:
    return f"CAST({expr} AS {kind}) AS {name}"


def edges_sql(column: str, edges: list[float]) -> str:
    """Bin number of a column as a CASE; edges are the inner ones, outer ones infinite."""
    parts = " ".join(f"WHEN {column} < {e!r} THEN {i}" for i, e in enumerate(edges))
    return f"CASE WHEN {column} IS NULL THEN NULL {parts} ELSE {len(edges)} END"


def auc_sql(source: str, group: str, score: str, out: str, extra: str = "") -> str:
    """CTE chain h, c, m computing AUC and KS of ``score`` per ``group`` over distinct scores."""
    return f"""
h AS (SELECT {group} AS g, {score} AS v, count(*) AS n, sum(target) AS bad FROM {source}
      WHERE {score} IS NOT NULL AND {group} IS NOT NULL {extra} GROUP BY 1, 2),
c AS (SELECT g, v, n, bad, sum(n - bad) OVER w - (n - bad) AS gb, sum(bad) OVER w AS cb, sum(n - bad) OVER w AS cg,
        sum(bad) OVER (PARTITION BY g) AS ball, sum(n - bad) OVER (PARTITION BY g) AS gall,
        sum(n) OVER (PARTITION BY g) AS nall
      FROM h WINDOW w AS (PARTITION BY g ORDER BY v ROWS UNBOUNDED PRECEDING)),
{out} AS (SELECT g, sum(bad * (gb + (n - bad) / 2.0)) / nullif(CAST(max(ball) AS DOUBLE) * max(gall), 0) AS auc,
        max(abs(CAST(cb AS DOUBLE) / nullif(ball, 0) - CAST(cg AS DOUBLE) / nullif(gall, 0))) AS ks,
        max(nall) AS n, max(ball) AS bad FROM c GROUP BY g)"""


SCORE_SQL = (
    "CAST(1200 - least(greatest(round_even(404.65547022 - 72.1347520444 * "
    "ln(least(greatest({p}, 0.001), 0.999) / (1 - least(greatest({p}, 0.001), 0.999))), 0), 0), 1200) AS INTEGER)"
)


def score_sql(p: str) -> str:
    return SCORE_SQL.format(p=p)


def woe_sql(source: str) -> str:
    """SELECT list computing the evidence table of (feature, lo, n, bad, ...) rows."""
    good = "(n - bad)"
    whole = "OVER (PARTITION BY feature)"
    upto = "OVER (PARTITION BY feature ORDER BY lo NULLS LAST ROWS UNBOUNDED PRECEDING)"
    gs, bs = f"(CAST({good} AS DOUBLE) / sum({good}) {whole})", f"(CAST(bad AS DOUBLE) / sum(bad) {whole})"
    return f"""
wt AS (SELECT *, {good} AS good, CAST(n AS DOUBLE) / sum(n) {whole} AS n_share, {bs} AS bad_share, {gs} AS good_share,
         CAST(bad AS DOUBLE) / n AS bad_rate, sum(bad) {upto} AS cum_bad, sum({good}) {upto} AS cum_good,
         CAST(sum(bad) {upto} AS DOUBLE) / sum(bad) {whole} AS cum_bad_share,
         CAST(sum({good}) {upto} AS DOUBLE) / sum({good}) {whole} AS cum_good_share,
         CASE WHEN bad = 0 THEN 0 WHEN {good} = 0 THEN NULL ELSE ln({gs} / {bs}) END AS woe
       FROM {source}),
wi AS (SELECT *, abs(cum_bad_share - cum_good_share) AS ks, (good_share - bad_share) * woe AS iv FROM wt),
wf AS (SELECT *, coalesce(sum(iv) OVER (PARTITION BY feature), 0) AS total_iv FROM wi)"""
