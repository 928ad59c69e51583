from pyspark.sql import functions as F

from gapweave.functions import scalars as fn
from gapweave.operators import impute, rules
from gapweave.plans import rule_tables as rt
from gapweave.streaming import rowwise

ROLES = {r: r for r in (*rt.NUTRIENTS, "group")}


def test_rules_give_the_same_rows_on_a_stream(spark, tmp_path):
    df = spark.range(200).select(
        F.col("id").alias("k"), (F.col("id") * 7 % 120 - 5.0).alias("fat"), (F.col("id") * 11 % 90 + 0.0).alias("carbohydrates"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 30 + 0.0).alias("proteins"), (F.col("id") * 13 % 900 + 0.0).alias("energy"),
    )
    path = str(tmp_path / "in")
    df.repartition(3).write.parquet(path)
    clean = lambda x: rules.apply_constraints(x, ROLES)
    batch = sorted(map(tuple, clean(df).collect()))
    assert sorted(map(tuple, rowwise.drain(spark, path, df.schema, clean).collect())) == batch


def test_a_fitted_model_runs_on_a_stream_and_resumes(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, 4.0), (3, 8.0)], "k int, v double")
    path, out, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))
    df.write.parquet(path)
    model = impute.ConstantImputer(["v"], "mean").fit(df)
    step = lambda x: model.transform(x.withColumn("v", fn.clip("v", 0.0, 7.0)))
    for _ in range(2):
        rowwise.clean_stream(rowwise.read_parquet_stream(spark, path, df.schema), step, out, progress).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, 6.0), (2, 4.0), (3, 7.0)]
    spark.createDataFrame([(9, None)], df.schema).write.mode("append").parquet(path)
    rowwise.clean_stream(rowwise.read_parquet_stream(spark, path, df.schema), step, out, progress).awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_counters_of_all_batches_of_a_stream(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.range(100).repartition(10).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    counted = lambda x: x.observe("seen", F.count("*").alias("n"), F.sum("id").alias("total")).withColumn("twice", F.col("id") * 2)
    rows, totals = rowwise.drain_counted(spark, str(tmp_path / "in"), schema, counted, "seen", files_per_trigger=1)
    assert totals == {"n": 100, "total": 4950} and rows.columns == ["id", "twice"] and rows.count() == 100
