"""Frames that one task would read are dealt to all tasks before long work."""

import threading

import pytest
from pyspark.sql import functions as F

from gapweave import session
from gapweave.operators import impute, models
from gapweave.plans import imputation


def held(df):
    return df.groupBy(F.spark_partition_id()).count().count()


def test_a_large_frame_of_one_task_is_dealt_anew(spark):
    df = spark.range(0, 5000, 1, 1)
    assert held(session.spread(df, 1000)) >= 4
    assert sorted(r.id for r in session.spread(df, 1000).collect()) == list(range(5000))
    assert held(session.spread(df)) == 1
    assert held(session.spread(spark.range(0).select("id"))) == 0


def test_model_steps_deal_their_rows(spark, monkeypatch):
    seen = []
    plain = session.spread
    for module in (impute, models):
        monkeypatch.setattr(module, "spread", lambda df: (seen.append(held(plain(df, 100))), plain(df, 100))[1])
    k = F.col("id")
    df = spark.range(0, 600, 1, 1).select(
        k.alias("code"), F.when(k % 7 != 1, (k * 13 % 50).cast("double")).alias("a"), (k * 17 % 40).cast("double").alias("b"), (k % 30).cast("double").alias("c")
    )
    filled = impute.ForestImputer(["a", "b", "c"], trees=3, depth=2).fit(df).transform(df)
    assert filled.where("a is null").count() == 0 and filled.count() == 600
    assert models.feature_relations(df, ["code"], trees=3, depth=2).count() > 0
    assert models.stratify(df, ["code"], max_strata=2).count() == 600
    assert len(seen) == 3 and min(seen) >= 4


def test_independent_works_run_beside_each_other(spark):
    meet = threading.Barrier(3)
    assert session.side_by_side(spark, [lambda i=i: (meet.wait(20), i)[1] for i in range(3)]) == [0, 1, 2]
    assert session.side_by_side(spark, [lambda: 7]) == [7] and session.side_by_side(spark, []) == []
    spark.sparkContext.setLocalProperty("gapweave.test", "kept")
    assert session.side_by_side(spark, [lambda: spark.sparkContext.getLocalProperty("gapweave.test")] * 2) == ["kept", "kept"]
    spark.sparkContext.setLocalProperty("gapweave.test", None)
    with pytest.raises(ZeroDivisionError):
        session.side_by_side(spark, [lambda: 1, lambda: 1 // 0])


def test_forests_and_strata_are_fitted_beside_each_other(spark, monkeypatch):
    seen = []
    plain = session.side_by_side
    for module in (models, imputation):
        monkeypatch.setattr(module, "side_by_side", lambda spark, works: (seen.append(len(works)), plain(spark, works))[1])
    k = F.col("id")
    df = spark.range(0, 400, 1, 2).select(
        k.alias("code"), F.when(k % 7 != 1, (k * 13 % 50).cast("double")).alias("a"), (k * 17 % 40).cast("double").alias("b"), (k % 2 * 90 + k % 5).cast("double").alias("c")
    )
    together = models.feature_relations(df, ["code"], trees=3, depth=2)
    assert seen == [3] and [r.target for r in together.select("target").distinct().orderBy("target").collect()] == ["a", "b", "c"]
    run = imputation.ImputationRun("code", {}, levels=(("high", 0.8),), relations=True)
    out = run.fit_transform(df)
    # Relations beside strata, the forests, the numbers of clusters, and the strata themselves.
    assert sorted(seen[1:4]) == [2, 3, 8] and len(seen) >= 5 and seen[4] >= 2
    assert out.where("a is null").count() == 0 and run.feature_relations.where("target = 'a'").count() > 0
