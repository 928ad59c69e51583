"""Shape of the physical plans: one scan, pruned columns, no pair-making joins."""

import re

import pytest
from pyspark.sql import functions as F

from gapweave.operators import joins, neighbours, profile, rules, selection, stats, windows
from gapweave.plans.views import PRODUCT_ROLES, table, view


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_constraints_are_one_scan_without_shuffle(spark, sf):
    text = plan(rules.apply_constraints(view(spark, sf, "products"), PRODUCT_ROLES))
    assert text.count("FileScan") == 1 and "Exchange" not in text and "Python" not in text


def test_profile_reads_once_and_combines_before_the_shuffle(spark, sf):
    text = plan(profile.column_profile(table(spark, sf, "orders"), "orders", ["o_orderstatus", "o_totalprice"]))
    assert text.count("FileScan") == 1
    assert "o_custkey" not in text and "o_orderdate" not in text
    assert "partial_count" in text


def test_outlier_pass_prunes_columns(spark, sf):
    summary, capped = stats.iqr_outliers(table(spark, sf, "lineitem"), ["l_quantity", "l_tax"])
    read = re.findall(r"ReadSchema: (struct<[^>]*>)", plan(summary))
    assert read == ["struct<l_quantity:double,l_tax:double>"]
    assert "Exchange" not in plan(capped)


@pytest.mark.parametrize("name", ["diff", "growth", "duplicates", "modes"])
def test_no_cartesian_products(spark, sf, name):
    orders = table(spark, sf, "orders")
    df = {
        "diff": lambda: windows.version_diff(orders.select("o_custkey"), orders.where("o_orderkey > 5").select("o_custkey")),
        "growth": lambda: stats.group_growth(orders, orders.where("o_orderkey > 5"), ["o_orderstatus"]),
        "duplicates": lambda: windows.flag_duplicates(orders, "o_custkey", "o_orderkey"),
        "modes": lambda: stats.mode_by(orders, "o_orderpriority", ["o_orderstatus"]),
    }[name]()
    assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)


def test_filters_reach_the_scan(spark, sf):
    text = plan(stats.top_values(table(spark, sf, "orders").where(F.col("o_totalprice") > 1000), "o_orderstatus", 3))
    assert "GreaterThan(o_totalprice,1000.0)" in text and "TakeOrderedAndProject" in text


def test_row_limits_apply_before_the_shuffle(spark, sf):
    donors = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.array(F.col("p_size").cast("double")).alias("vec"), F.array("p_type").alias("values"))
    for df in (neighbours._distinct_donors(donors, 5), selection.outlier_samples(table(spark, sf, "events"), ["value"], "event_id")):
        text = plan(df)
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_a_large_lookup_is_not_broadcast(spark, sf):
    orders = table(spark, sf, "orders")
    counts = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    text = plan(joins.lookup_join(orders, counts, ["o_custkey"], rows=5))
    assert "SortMergeJoin" in text or "ShuffledHashJoin" in text or "__salt" in text
    small = plan(joins.lookup_join(orders, counts, ["o_custkey"]))
    assert "BroadcastHashJoin" in small
