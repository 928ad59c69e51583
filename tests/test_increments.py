import pytest
from pyspark.sql import functions as F

from gapweave.operators import increments


def test_merged_versions_equal_the_whole(spark, tmp_path):
    whole = spark.range(6000).select(
        "id", F.when(F.col("id") % 7 != 0, F.col("id") / 10).alias("x"), F.concat(F.lit("g"), (F.col("id") % 40) * (F.col("id") % 3)).alias("g"), F.lit(None).cast("double").alias("gap")
    )
    for i, (low, high) in enumerate([(0, 1000), (1000, 4500), (4500, 6000)]):
        increments.add_version(whole.where((F.col("id") >= low) & (F.col("id") < high)), str(tmp_path / "p"), str(i))
    with pytest.raises(FileExistsError):
        increments.add_version(whole, str(tmp_path / "p"), "1")
    merged = {r.column: r for r in increments.stored_profile(spark, str(tmp_path / "p")).collect()}
    assert set(merged) == {"id", "x", "g", "gap"}
    for c in whole.columns:
        known = whole.where(F.col(c).isNotNull())
        n, distinct = known.count(), known.select(c).distinct().count()
        r = merged[c]
        assert (r.non_null, r.nulls) == (n, 6000 - n) and abs(r.distinct - distinct) <= 0.05 * distinct
    assert (merged["id"].low, merged["id"].high) == (0.0, 5999.0)
    assert merged["id"].quantiles == pytest.approx([1500, 3000, 4500], abs=60)
    assert merged["g"].quantiles is None and merged["gap"].quantiles is None and merged["gap"].most_common is None
    top = whole.groupBy("g").count().orderBy(F.desc("count"), "g").first()
    assert (merged["g"].most_common, merged["g"].most_common_count) == (top["g"], top["count"])


def test_plan_shuffles_states_only_and_empty_frames(spark, tmp_path):
    df = spark.range(100)
    plan = increments.column_states(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan
    assert increments.column_states(df.limit(0)).count() == 0
    increments.add_version(df.limit(0), str(tmp_path / "e"), "0")
    increments.add_version(df, str(tmp_path / "e"), "1")
    assert increments.stored_profile(spark, str(tmp_path / "e")).first().non_null == 100
