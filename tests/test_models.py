import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gapweave.operators import models
from gapweave.plans.views import view

COLUMNS = ["energy", "fat", "carbohydrates", "sugars", "sodium"]


@pytest.fixture(scope="module")
def products(spark, sf):
    return view(spark, sf, "products").where("code < 600").cache()


def test_projection_equals_numpy(products):
    p = models.project(products, COLUMNS, 2, ["code"])
    data = products.orderBy("code").toPandas()[COLUMNS].astype(float)
    x = data.fillna(data.median())
    z = ((x - x.mean()) / x.std(ddof=0)).to_numpy()
    values, vectors = np.linalg.eigh(z.T @ z)
    order = np.argsort(-values)[:2]
    assert p.explained == pytest.approx(list(values[order] / values.sum()))
    load = p.loadings.toPandas().pivot(index="column", columns="component", values="loading").loc[COLUMNS].to_numpy()
    assert np.abs(load) == pytest.approx(np.abs(vectors[:, order]))
    assert (load[np.abs(load).argmax(0), [0, 1]] > 0).all()
    scores = p.scores.orderBy("code").toPandas()[["PC1", "PC2"]].to_numpy()
    assert scores == pytest.approx(z @ load, abs=1e-8)
    plot = models.biplot_table(p, 3).toPandas()
    assert plot.labelled.sum() == 3 and plot[["x", "y"]].abs().to_numpy().max() == pytest.approx(0.8 * np.abs(scores).max())


def test_component_choice_accumulates(products):
    table, reached = models.component_choice(products, COLUMNS)
    rows = table.orderBy("component").collect()
    assert rows[-1].cumulative == pytest.approx(1.0) and set(reached) == {0.7, 0.8, 0.9}
    assert rows[reached[0.8] - 1].cumulative >= 0.8 and (reached[0.8] == 1 or rows[reached[0.8] - 2].cumulative < 0.8)


def test_strata_cover_all_rows(products):
    out = models.stratify(products, ["code"], COLUMNS)
    assert out.count() == 600 and out.where("stratum is null").count() == 0
    assert models.stratify(products, ["code"], ["energy", "fat"]) is None


def test_relations_and_report_keys(products):
    found = models.feature_relations(products, ["code"], ["grp", "fr_score", "uk_score", "energy"], trees=10)
    rows = found.collect()
    assert all(r.importance > 0.01 and r.target != r.feature for r in rows)
    best = [r.feature for r in rows if r.target == "uk_score"][0]
    assert best == "fr_score" and {r.model_type for r in rows if r.target == "grp"} == {"classification"}
    report = models.projection_report(products, COLUMNS, "grade", ["code"], clusters=3, choose=True)
    assert report["centers"].count() == 3 and report["clustered"].count() == 600
    assert report["top_loadings"].count() == 15


def test_task_detection(spark):
    df = spark.createDataFrame([(i, i % 4, str(i)) for i in range(20)], "a int, b int, c string")
    assert [models.task_of(df, c) for c in "abc"] == ["regression", "classification", "classification"]


def test_comparison_picks_the_best_and_names_features(products):
    forest = RandomForestClassifier(numTrees=5, maxDepth=3, seed=1)
    weak = RandomForestClassifier(numTrees=1, maxDepth=1, seed=1)
    got = models.compare_models(products, "grade", ["code"], COLUMNS, ["grp"], {"weak": (weak, [{}]), "forest": (forest, [{}])}, folds=2)
    scores = {r.model: r.f1 for r in got.results.collect()}
    assert got.task == "classification" and got.best == max(scores, key=scores.get)
    names = {r.feature for r in models.named_importances(got.models["forest"], products, ["grp"], COLUMNS, 100).collect()}
    assert "grp=meat" in names and set(COLUMNS) <= names
    target = products.where("energy is not null and fat is not null").withColumn("y", F.col("energy") * 2 + F.col("fat"))
    line = models.compare_models(target, "y", ["code"], ["energy", "fat"], (), {"line": (LinearRegression(), [{}])}, folds=2)
    assert line.task == "regression" and line.results.first().r2 > 0.9


def test_class_report_with_absent_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "d")], "y string, p string")
    got = {r["class"]: r for r in models.class_report(df, "y", "p").collect()}
    assert got["d"].support == 0 and got["c"].recall == 0.0 and got["a"].f1 == pytest.approx(2 / 3)
    assert got["Accuracy"].precision == 0.5 and got["Weighted Avg"].support == 4


def test_encoding_is_alphabetical_with_nan(spark):
    df = spark.createDataFrame([("z",), ("a",), (None,)], "x string")
    out, names = models.encode_labels(df, ["x"])
    assert [r.x for r in out.collect()] == [2, 0, 1] and names["x"] == ["a", "nan", "z"]


def test_predictions_for_every_row(products):
    out = models.predict_labels(products, "grp", COLUMNS, trees=3)
    assert out.count() == 600 and out.where("predicted is null").count() == 0


def test_comparison_scores_as_cross_validation_does(spark, products, monkeypatch):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from gapweave.operators import kernels

    rows = products.where("grade is not null").select("code", "energy", "grade").na.drop()
    ready = models.Pipeline(stages=[models.StringIndexer(inputCol="grade", outputCol="label"), models.VectorAssembler(inputCols=["energy"], outputCol="features")]).fit(rows).transform(rows)
    ready = ready.withColumn("__fold", (F.col("code") % 3).cast("int")).persist()
    forest, machine = RandomForestClassifier(numTrees=3, seed=1), kernels.SupportVectorMachine(True, components=8)
    choices = {
        "forest": (forest, ParamGridBuilder().addGrid(forest.maxDepth, [1, 3]).build()),
        "machine": (machine, ParamGridBuilder().addGrid(machine.kernel, ["linear", "rbf"]).build()),
    }
    scored = MulticlassClassificationEvaluator(metricName="f1")
    got = models._validated(ready, choices, scored, "__fold", 3, 4)
    for name, (estimator, grid) in choices.items():
        search = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=scored, numFolds=3, foldCol="__fold", seed=42)
        assert list(got[name]) == pytest.approx(search.fit(ready).avgMetrics, abs=1e-9)
    with pytest.raises(ValueError):
        models._validated(ready, choices, scored, "__fold", 4, 4)
    ready.unpersist()


def test_relations_prepare_their_rows_once_and_large_ones_grow_one_by_one(spark, products, monkeypatch):
    from gapweave.operators import selection

    beside, encoded = [], []
    plain, encode = models.side_by_side, models.encode_labels
    monkeypatch.setattr(models, "side_by_side", lambda *a: beside.append(len(a[1])) or plain(*a))
    monkeypatch.setattr(models, "encode_labels", lambda *a: encoded.append(1) or encode(*a))
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    found = [sorted(map(tuple, models.feature_relations(products, ["code"], ["grp", "fr_score", "energy"], trees=5).collect()))]
    monkeypatch.setattr(models, "ROWS_AT_ONCE", 10)
    found.append(sorted(map(tuple, models.feature_relations(products, ["code"], ["grp", "fr_score", "energy"], trees=5).collect())))
    assert beside == [3] and encoded == [1, 1] and found[0] == found[1] and found[0]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= kept
    assert selection.threshold_of({3: 2, 1: 1, 5: 1}, 50) == 3 and selection.threshold_of({}, 50) == 0.0 and selection.threshold_of({0: 1, 1: 1}, 65) == 0.65
