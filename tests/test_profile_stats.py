import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gapweave.operators import joins, profile, quantiles, selection, stats, windows


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def gappy(spark):
    data = [(i, "abc"[i % 3] if i % 5 else None, float(i % 7) if i % 4 else None, None if i % 2 else i) for i in range(40)]
    return spark.createDataFrame(data, "k int, label string, v double, half int")


def test_profile_counts_and_ties(gappy):
    p = {r.column: r for r in profile.column_profile(gappy, "x").collect()}
    assert (p["label"].non_null, p["label"].nulls, p["label"].distinct) == (32, 8, 3)
    counts = pd.Series(["abc"[i % 3] for i in range(40) if i % 5]).value_counts()
    best = min(c for c in counts.index if counts[c] == counts.max())
    assert (p["label"].most_common, p["label"].most_common_count) == (best, counts.max())
    assert p["half"].fill_pct == 50.0 and p["k"].unique_pct == 100.0


def test_profile_of_empty_and_null_columns(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert [(r.non_null, r.nulls, r.fill_pct) for r in profile.column_profile(empty, "e").collect()] == [(0, 0, 0.0)] * 2
    nulls = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    b = profile.type_profile(nulls).where("column = 'b'").first()
    assert (b.observed_type, b.fill_pct, b.missing_pct) == ("NaN", 0.0, 100.0)


def test_type_profile_mixes_kinds(spark):
    df = spark.createDataFrame([("1",), ("2",), ("x",), ("NULL",), (None,), ("3",)], "a string")
    r = profile.type_profile(df).first()
    assert r.observed_type == "errorType(int: 60.00%, str: 40.00%)"
    assert r.bad_null_pct == pytest.approx(100 / 6) and r.duplicate_pct == 0.0
    plain = profile.type_profile(df, parse_text=False).first()
    assert plain.observed_type == "str(4)"


def test_categories_overlap(spark):
    df = spark.createDataFrame([("a", 100.0, 4, 50.0, "string"), ("b", 10.0, 3, 1.0, "int")], "column string, fill_pct double, distinct long, unique_pct double, dtype string")
    got = {r.column: r for r in profile.column_categories(df).collect()}
    assert got["a"].categorical and got["a"].binary
    assert got["b"].low_fill and not got["b"].binary


def test_quantiles_of_any_numbers(spark):
    rng = np.random.default_rng(8)
    special = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1.0, 1.0 + 2.0**-52, 1.0 - 2.0**-53, 2.0, 4.0, -1.0, 1e308, -1e308, float("inf"), float("-inf"), 0.1, 0.1 + 2.0**-56]
    a = np.concatenate([rng.normal(size=400), np.round(rng.normal(size=400), 1), 10.0 ** rng.uniform(-300, 300, 200), -(10.0 ** rng.uniform(-5, 5, 100)), special])
    data = pd.DataFrame({"g": [("x", "y", None)[i % 3] for i in range(len(a))], "a": a, "b": rng.integers(0, 5, len(a)).astype(float)})
    data.loc[::9, "b"] = np.nan
    df = spark.createDataFrame(data).withColumn("none", F.lit(None).cast("double"))
    probs = [0.0, 0.013, 0.25, 0.5, 0.75, 0.99, 1.0]
    for by in ([], ["g"]):
        got = {tuple(r)[:-1]: r["value"] for r in quantiles.quantiles(df, ["a", "b", "none"], probs, by).collect()}
        for key, part in [((), data)] if not by else [((k,), p) for k, p in data.groupby("g")]:
            for c in ("a", "b"):
                ordered = np.sort(part[c].dropna().to_numpy())
                for p in probs:
                    at = p * (len(ordered) - 1)
                    low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
                    want = low if low == high else low + (high - low) * (at - np.floor(at))
                    assert got[(*key, c, p)] == want or got[(*key, c, p)] == pytest.approx(want, rel=1e-12, nan_ok=True), (key, c, p)
    assert got.keys() and all(v is None for k, v in {tuple(r)[:-1]: r["value"] for r in quantiles.quantiles(df, ["none"], probs).collect()}.items())
    assert quantiles.medians(df.limit(0), ["a"]) == {"a": None}


def test_quantiles_need_no_window_and_count_only(spark):
    df = spark.range(5000).select(F.sqrt("id").alias("v"), (F.col("id") % 3).alias("g"))
    for by in ([], ["g"]):
        plan = quantiles.quantiles(df, ["v"], [0.5], by)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "percentile" not in plan
    assert quantiles.medians(df, ["v"])["v"] == pytest.approx((np.sqrt(2499) + np.sqrt(2500)) / 2)



def test_describe_matches_pandas(spark):
    data = pd.DataFrame({"a": [1.0, 2.0, 2.0, 9.0, 4.0]})
    r = stats.describe(spark.createDataFrame(data), ["a"]).first()
    assert r["mean"] == pytest.approx(3.6) and r["std"] == pytest.approx(data.a.std()) and r.skewness == pytest.approx(data.a.skew())


def test_iqr_counts_nulls_as_neither(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)] + [(None,)], "v double")
    summary, capped = stats.iqr_outliers(df, ["v"])
    r = summary.first()
    assert (r.outliers, r.outlier_pct, r.upper) == (1, 20.0, 7.0) and r.clean_mean == 2.5
    assert sorted(x.v for x in capped.collect() if x.v is not None) == [1.0, 2.0, 3.0, 4.0, 7.0]
    assert capped.where("v is null").count() == 1


def test_limit_outliers_without_clean_mean(spark):
    df = spark.createDataFrame([(0.0, -1.0), (0.0, 200.0)], "z double, v double")
    got = {r.column: r for r in stats.limit_outliers(df, {"z": 10.0, "v": 100.0})[0].collect()}
    assert got["z"].mean_change_pct == 0.0 and got["v"].clean_mean is None
    assert (got["v"].below, got["v"].above, got["v"].extreme_min, got["v"].extreme_max) == (1, 1, -1.0, 200.0)


def test_histogram_like_numpy(spark):
    values = np.random.default_rng(0).normal(size=500)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    got = {r.bin: r for r in stats.histogram(df, "v").collect()}
    bins = stats.sturges_bins(500)
    counts, edges = np.histogram(values, bins=bins)
    density, _ = np.histogram(values, bins=bins, density=True)
    assert bins == 10
    for i, n in enumerate(counts):
        if n:
            assert got[i].n == n and got[i].density == pytest.approx(density[i]) and got[i].left_edge == pytest.approx(edges[i])


def test_line_fit_needs_three_points_and_reports_both_fits(spark):
    pts = [("a", 0.0, 1.0, 10), ("a", 1.0, 3.0, 5), ("a", 2.0, 4.0, 1), ("b", 0.0, 0.0, 9), ("b", 1.0, 1.0, 9), ("c", 2.0, 1.0, 1), ("c", 2.0, 3.0, 1), ("c", 2.0, 5.0, 2)]
    got = {r.g: r for r in stats.weighted_line_fit(spark.createDataFrame(pts, "g string, x double, y double, w long"), "g", "x", "y", "w").collect()}
    assert set(got) == {"a", "c"}
    x, y, w = np.array([0, 1, 2.0]), np.array([1, 3, 4.0]), np.array([10, 5, 1.0])
    slope, intercept = np.polyfit(x, y, 1, w=np.sqrt(w))
    assert got["a"].slope == pytest.approx(slope) and got["a"].intercept == pytest.approx(intercept)
    rest = y - slope * x - intercept
    assert got["a"].r2 == pytest.approx(1 - (rest**2).sum() / ((y - y.mean()) ** 2).sum())
    assert got["c"].slope == 0.0 and got["c"].intercept == pytest.approx(3.5)


@pytest.mark.parametrize("limit", [1000, 1])
def test_running_total_small_and_ranged(spark, limit):
    df = spark.createDataFrame([(i, (i * 7) % 5 + 1) for i in range(60)], "k int, n long")
    got = rows(joins.running_total(df, [F.desc("n"), F.col("k")], "n", "run", rows=limit).select("k", "run"), "run")
    ordered = sorted([(i, (i * 7) % 5 + 1) for i in range(60)], key=lambda r: (-r[1], r[0]))
    total, want = 0, []
    for k, n in ordered:
        total += n
        want.append((k, total))
    assert got == want


def test_frequent_combinations_drop_the_crossing_row(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [("c",)] * 2, "x string")
    assert rows(stats.frequent_combinations(df, ["x"], 0.8).select("x", "running"), "running") == [("a", 5), ("b", 8)]
    assert [r.x for r in stats.frequent_combinations(df, ["x"], 0.79).collect()] == ["a"]
    assert stats.frequent_combinations(df, ["x"], 1.0).count() == 3


@pytest.mark.parametrize("limit", [1000, 0])
def test_lookup_join_paths_agree_with_hot_and_null_keys(spark, limit):
    left = spark.createDataFrame([(i, "hot" if i % 3 else (None if i % 2 else f"k{i}")) for i in range(90)], "i int, k string")
    table = spark.createDataFrame([("hot", 1), ("k0", 2), ("k6", 3)], "k string, v int")
    got = {r.i: r.v for r in joins.lookup_join(left, table, ["k"], rows=limit).collect()}
    want = {"hot": 1, "k0": 2, "k6": 3}
    assert len(got) == 90 and all(got[r.i] == want.get(r.k) for r in left.collect())
    assert joins.lookup_join(left, table, ["k"], "left_semi", rows=limit).count() == 62
    assert joins.lookup_join(left, table, ["k"], "left_anti", rows=limit).count() == 28


def test_hot_and_null_keys_are_spread_even_for_equal_rows(spark):
    left = spark.range(3000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    table = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")).unionByName(spark.createDataFrame([("hot", 2)], "k string, v int"))
    assert len(joins._hot_keys(left, ["k"], 4)) == 2  # the hot key and null
    out = joins.lookup_join(left, table, ["k"], rows=1)
    assert out.count() == 3000
    assert {(r.v, r["count"]) for r in out.groupBy("v").count().collect()} == {(2, 1000), (None, 1000), (1, 1000)}


def test_settle_leaves_a_callers_cache_alone(spark):
    df = spark.range(10).toDF("a").cache()
    df.count()
    assert joins.settle(df)[1] is True
    assert df.storageLevel.useMemory
    df.unpersist()


def test_growth_labels_and_null_safe_outer(spark):
    before = spark.createDataFrame([("a",)] * 2 + [("b",)], "g string")
    after = spark.createDataFrame([("a",)] * 5 + [("c",)], "g string")
    got = {r.g: (r.count_before, r.count_after, r.pct_change, r.pct_capped, r.label) for r in stats.group_growth(before, after, ["g"]).collect()}
    assert got == {"a": (2, 5, 150.0, 150.0, "150.0%"), "b": (1, 0, -100.0, 0.0, "-100.0%"), "c": (0, 1, 100.0, 100.0, "New")}
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, n long")
    b = spark.createDataFrame([(None, 3)], "k string, m long")
    assert sorted(map(tuple, joins.outer_counts(a, b, ["k"], ["n", "m"]).collect()), key=str) == sorted([(None, 1, 3), ("x", 2, 0)], key=str)


def test_duplicates_and_group_means(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, None, None), (4, "b", 5.0), (5, "a", 3.0)], "k int, g string, v double")
    assert rows(windows.flag_duplicates(df, "g", "k").select("k", "is_duplicate"), "k") == [(1, False), (2, True), (3, False), (4, False), (5, True)]
    assert rows(windows.fill_by_group_mean(df, "g", ["v"]).select("k", "v"), "k") == [(1, 1.0), (2, 2.0), (3, None), (4, 5.0), (5, 3.0)]


def test_version_diff_and_digest(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "x string, n int")
    new = spark.createDataFrame([("a", 1), ("c", 2)], "x string, n int")
    assert sorted(map(tuple, windows.version_diff(old, new).collect())) == [("b", None, "Removed"), ("c", 2, "Added")]
    assert windows.frame_digest(old) == windows.frame_digest(old.repartition(3)) != windows.frame_digest(new)
    assert windows.version_diff(None, new).count() == 2


def test_completeness_threshold_like_numpy(gappy):
    data = [[r.label is not None, r.v is not None, r.half is not None] for r in gappy.collect()]
    counts = np.array(data).sum(1)
    for p in (0, 37, 50, 65, 100):
        assert selection.completeness_threshold(gappy, ["label", "v", "half"], p) == pytest.approx(np.percentile(counts, p))


def test_samples_and_splits_ignore_partitioning(gappy):
    a = selection.exact_sample(gappy.repartition(1), 7, ["k"])
    b = selection.exact_sample(gappy.repartition(4), 7, ["k"])
    assert {r.k for r in a.collect()} == {r.k for r in b.collect()} and a.count() == 7
    train, test = selection.split(gappy, ["k"])
    assert train.count() + test.count() == 40 and train.join(test, "k").count() == 0


def test_confidence_report_orders_by_count(spark):
    df = spark.createDataFrame([("a", 0.9), ("a", 0.4), ("b", 0.8), ("a", 0.5)], "column string, confidence double")
    got = stats.confidence_report(df).collect()
    assert [(r.column, r.imputed) for r in got] == [("a", 3), ("b", 1)]
    assert got[0].low_pct == pytest.approx(100 / 3) and got[1].high_pct == 100.0
