"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from riskloom.operators import prefix, profile, split
from riskloom.operators.cut import INF, cut_columns
from riskloom.operators.hist import numeric_histogram, text_histogram
from riskloom.operators.rankm import auc_ks
from riskloom.operators.woe import bin_counts, encode_categories
from riskloom.plans.fixtures import loan_wide, table
from riskloom.plans.registry import QUERIES
from riskloom.plans import catalog  # noqa: F401


@pytest.fixture(autouse=True)
def without_caches(spark):
    spark.catalog.clearCache()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_are_combined_before_the_shuffle(spark, sf):
    text = plan(bin_counts(loan_wide(spark, sf), {"f_price": [-INF, 1e5, INF], "f_bal": [-INF, 1e3, INF]}, "target"))
    assert "partial_count" in text and text.count("Exchange hashpartitioning") <= 3


def test_scans_read_only_needed_columns(spark, sf):
    text = plan(bin_counts(loan_wide(spark, sf), {"f_bal": [-INF, 1e3, INF]}, "target"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("c_acctbal" in s for s in schemas)
    assert not any("o_orderdate" in s or "c_name" in s or "c_mktsegment" in s for s in schemas)


def test_filters_reach_the_scan(spark, sf):
    text = plan(table(spark, sf, "lineitem").where(F.col("l_linenumber").isin(1, 2)).select("l_orderkey"))
    assert re.search(r"PushedFilters: \[[^\]]*l_linenumber", text)


def test_rank_limits_run_before_the_shuffle(spark, sf):
    first = split.keep_first(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey"])
    assert plan(first).count("WindowGroupLimit") == 2
    top = profile.frequent_values(text_histogram(loan_wide(spark, sf), ["c_nat"]))
    assert plan(top).count("WindowGroupLimit") == 4


def test_row_level_windows_are_never_one_task(spark, sf):
    hist = numeric_histogram(loan_wide(spark, sf), ["f_price"], "target")
    text = plan(auc_ks(prefix.rank_histogram(hist, ["feature"], task_rows=50)))
    assert "SinglePartition" not in text
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", text)
    assert any("bucket" in w for w in windows)


def test_apply_side_has_no_shuffle_and_no_python(spark, sf):
    stored = spark.read.parquet(f"{sf}/orders.parquet").select("o_totalprice", "o_orderpriority")
    out = encode_categories(cut_columns(stored, {"o_totalprice": [-INF, 1e5, 2e5, INF]}), {"o_orderpriority": {"1-URGENT": 0.1, "other": 0.0}})
    text = plan(out)
    assert "Exchange" not in text and "Python" not in text and "Join" not in text


def test_split_labels_do_not_shuffle_the_table(spark, sf):
    out = split.stratified_split(table(spark, sf, "orders").withColumn("target", (F.col("o_totalprice") > 2e5).cast("int")), "o_orderkey", "target")
    assert "Exchange" not in plan(out)


@pytest.mark.parametrize("name", ["woe_iv_table", "auc_ks_by_feature", "score_psi_detail", "tree_dump_scores", "data_profile", "delivery_sample", "stratified_folds", "category_woe"])
def test_queries_stay_out_of_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
