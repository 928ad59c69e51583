"""Feature relations, strata, projection, clustering and predictive models on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from gapweave.functions.scalars import quoted
from gapweave.operators.impute import ConstantImputer, fill_constants
from gapweave.operators.kernels import SupportVectorMachine
from gapweave.operators.neighbours import feature_vector
from gapweave.operators.quantiles import medians
from gapweave.operators.selection import columns_of_kind, exact_sample, fill_percentages, hash_order, split
from gapweave.operators.stats import cross_counts, modes
from gapweave.session import ROWS_AT_ONCE, side_by_side, spread


def encode_labels(df: DataFrame, columns: Sequence[str], null_text: str = "nan") -> tuple[DataFrame, dict[str, list[str]]]:
    """Text columns to codes 0.. in alphabetical order, a null as the label ``nan``; with the labels."""
    text = df.withColumns({f"__t{i}": F.coalesce(F.col(quoted(c)).cast("string"), F.lit(null_text)) for i, c in enumerate(columns)})
    codes = [f"__c{i}" for i in range(len(columns))]
    model = StringIndexer(inputCols=[f"__t{i}" for i in range(len(columns))], outputCols=codes, stringOrderType="alphabetAsc").fit(text)
    out = model.transform(text)
    place = {c: codes[i] for i, c in enumerate(columns)}
    encoded = out.select(*[F.col(place[c]).cast("int").alias(c) if c in place else F.col(quoted(c)) for c in df.columns])
    return encoded, {c: list(model.labelsArray[i]) for i, c in enumerate(columns)}


def _sampled(df: DataFrame, rows: int | None, key: Sequence[str], seed: int) -> DataFrame:
    return df if rows is None else exact_sample(df, rows, key, seed=seed)


def feature_relations(
    df: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    sample_rows: int | None = None,
    max_targets: int | None = None,
    min_known: int = 50,
    trees: int = 50,
    depth: int = 5,
    floor: float = 0.01,
    top: int = 10,
    seed: int = 42,
) -> DataFrame:
    """(target, feature, importance, model_type): forest importances above ``floor``, at most ``top`` per target.

    Every row and every column with less than half of its cells missing counts, unless ``sample_rows`` or ``max_targets`` is
    given. A target with under ``min_known`` known cells has no model and no rows."""
    spark = df.sparkSession
    columns = [c for c in (columns or df.columns) if c not in key]
    usable = [c for c, fill in fill_percentages(df, columns).items() if fill > 50]
    numbers = [c for c in columns_of_kind(df, "number") if c in usable]
    texts = [c for c in usable if c not in numbers]
    rows = spread(_sampled(df.select(*[quoted(c) for c in (*key, *usable)]), sample_rows, key, seed)).persist()
    ready = None
    try:
        known = fill_percentages(rows, usable)
        total = rows.count()
        middle, common = medians(rows, numbers) if numbers else {}, modes(rows, texts)
        ready = rows.withColumns({f"__known_{i}": F.col(quoted(c)).isNotNull() for i, c in enumerate(usable)})
        ready = fill_constants(ready, {**middle, **common})
        if texts:
            ready, _ = encode_labels(ready, texts)
        inputs = {c: f"__x{i}" for i, c in enumerate(usable)}
        # Filled and encoded once: every forest reads these rows several times.
        ready = ready.select(*[F.col(quoted(c)).cast("double").alias(n) for c, n in inputs.items()], *[f"__known_{i}" for i in range(len(usable))]).persist()
        ready.count()
        rows.unpersist()

        def related(i: int, target: str) -> list[tuple]:
            others = [c for c in usable if c != target]
            if not others or known[target] < 50 or known[target] / 100 * total < min_known:
                return []
            part = VectorAssembler(inputCols=[inputs[c] for c in others], outputCol="__f", handleInvalid="keep").transform(ready.where(F.col(f"__known_{i}")))
            kind = RandomForestRegressor if target in numbers else RandomForestClassifier
            model = kind(featuresCol="__f", labelCol=inputs[target], numTrees=trees, maxDepth=depth, seed=seed).fit(part)
            weights = sorted(zip(model.featureImportances.toArray().tolist(), others), key=lambda w: (-w[0], w[1]))
            task = "regression" if target in numbers else "classification"
            return [(target, c, w, task) for w, c in weights if w > floor][:top]

        works = [partial(related, i, target) for i, target in enumerate(usable[:max_targets])]
        # Each forest keeps a copy of its rows while it grows.
        tables = side_by_side(spark, works) if total <= ROWS_AT_ONCE else [work() for work in works]
        found = [row for table in tables for row in table]
    finally:
        rows.unpersist()
        if ready is not None:
            ready.unpersist()
    return spark.createDataFrame(found, "target string, feature string, importance double, model_type string")


def _scale_of(df: DataFrame, columns: Sequence[str], fill: Mapping[str, float] | None = None) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column; a constant column keeps deviation 1."""
    cells = [F.coalesce(F.col(quoted(c)).cast("double"), F.lit((fill or {}).get(c))) for c in columns]
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cells)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cells)]).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def stratify(
    df: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, sample_rows: int | None = None, out: str = "stratum", seed: int = 42, max_strata: int = 9
) -> DataFrame | None:
    """Frame with a stratum per row: K-means over standardised, well-filled numeric columns, k chosen by
    silhouette from 2 to ``max_strata`` at every size. All rows count unless ``sample_rows`` is given. None when fewer than
    3 columns, or no complete rows for two strata, qualify."""
    numbers = [c for c in (columns or columns_of_kind(df, "number")) if c not in key]
    usable = [c for c, fill in fill_percentages(df, numbers).items() if fill > 60]
    if len(usable) < 3:
        return None
    complete = spread(_sampled(df.select(*[quoted(c) for c in (*key, *usable)]), sample_rows, key, seed).na.drop()).persist()
    try:
        n = complete.count()
        if n < 3:
            return None
        scale = _scale_of(complete, usable)
        ready = complete.select(array_to_vector(feature_vector(usable, scale)).alias("__f")).persist()

        def scored(k: int):
            model = KMeans(k=k, seed=seed, featuresCol="__f", predictionCol="__s").fit(ready)
            return model, ClusteringEvaluator(featuresCol="__f", predictionCol="__s").evaluate(model.transform(ready))

        best, best_score = None, -1.0
        for model, score in side_by_side(df.sparkSession, [partial(scored, k) for k in range(2, min(max_strata, n - 1) + 1)]):
            if best is None or score > best_score:
                best, best_score = model, score
        best = best or KMeans(k=2, seed=seed, featuresCol="__f", predictionCol="__s").fit(ready)
        ready.unpersist()
    finally:
        complete.unpersist()
    means = {c: m for c, (m, _) in scale.items()}
    placed = best.transform(df.withColumn("__f", array_to_vector(feature_vector(usable, scale, means))))
    return placed.withColumn(out, F.col("__s")).drop("__f", "__s")


@dataclass
class Projection:
    """Principal components of a frame: scores per row, explained share, loadings (column, pc, loading)."""

    scores: DataFrame
    explained: list[float]
    loadings: DataFrame
    columns: list[str]
    k: int

    @property
    def score_columns(self) -> list[str]:
        return [f"PC{i + 1}" for i in range(self.k)]


def _standardised(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    fill = medians(df, columns)
    return df.withColumn("__f", array_to_vector(feature_vector(columns, _scale_of(df, columns, fill), fill)))


def project(df: DataFrame, columns: Sequence[str], k: int = 3, keep: Sequence[str] = ()) -> Projection:
    """PCA of median-filled, standardised columns. The greatest loading of each component is positive."""
    columns = list(columns)
    ready = _standardised(df, columns)
    model = PCA(k=k, inputCol="__f", outputCol="__p").fit(ready)
    matrix = model.pc.toArray()
    signs = np.sign(matrix[np.abs(matrix).argmax(0), range(k)])
    signs[signs == 0] = 1.0
    scores = model.transform(ready).withColumn("__a", vector_to_array("__p"))
    named = scores.select(
        *[F.col(quoted(c)) for c in keep], *[(F.get("__a", F.lit(i)) * F.lit(float(signs[i]))).alias(f"PC{i + 1}") for i in range(k)]
    )
    rows = [(c, f"PC{j + 1}", float(matrix[i, j] * signs[j])) for i, c in enumerate(columns) for j in range(k)]
    loadings = df.sparkSession.createDataFrame(rows, "column string, component string, loading double")
    return Projection(named, model.explainedVariance.toArray().tolist(), loadings, columns, k)


def component_choice(df: DataFrame, columns: Sequence[str], thresholds: Sequence[float] = (0.7, 0.8, 0.9)) -> tuple[DataFrame, dict[float, int]]:
    """(component, explained, cumulative) for all components, and the first count reaching each threshold."""
    ready = _standardised(df, columns)
    shares = PCA(k=len(columns), inputCol="__f", outputCol="__p").fit(ready).explainedVariance.toArray()
    total = np.cumsum(shares)
    rows = [(i + 1, float(s), float(t)) for i, (s, t) in enumerate(zip(shares, total))]
    reached = {t: int(np.argmax(total >= t - 1e-12)) + 1 for t in thresholds if (total >= t - 1e-12).any()}
    return df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double"), reached


def cluster_components(projection: Projection, k: int = 5, color: str | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """K-means on component scores: ``rows`` with a cluster, ``centers``, and cluster x label counts."""
    names = projection.score_columns
    ready = projection.scores.withColumn("__f", array_to_vector(F.array(*names)))
    model = KMeans(k=k, seed=seed, featuresCol="__f", predictionCol="cluster").fit(ready)
    rows = model.transform(ready).drop("__f")
    centers = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    out = {
        "rows": rows,
        "centers": rows.sparkSession.createDataFrame(centers, "cluster int, " + ", ".join(f"{n} double" for n in names)),
    }
    if color:
        out["by_label"] = cross_counts(rows, "cluster", color)
    return out


def biplot_table(projection: Projection, top: int = 8) -> DataFrame:
    """Loadings on the first two components, scaled to 0.8 of the greatest score, with the top columns flagged."""
    reach = projection.scores.agg(F.max(F.greatest(F.abs("PC1"), F.abs("PC2")))).first()[0] or 0.0
    wide = projection.loadings.groupBy("column").agg(
        F.max(F.when(F.col("component") == "PC1", F.col("loading"))).alias("l1"), F.max(F.when(F.col("component") == "PC2", F.col("loading"))).alias("l2")
    )
    rows = sorted(((r["column"], r["l1"], r["l2"]) for r in wide.collect()), key=lambda r: (-(abs(r[1]) + abs(r[2])), r[0]))
    greatest = max((max(abs(a), abs(b)) for _, a, b in rows), default=0.0)
    scale = 0.8 * reach / greatest if greatest else 0.0
    table = [(c, a * scale, b * scale, i < top) for i, (c, a, b) in enumerate(rows)]
    return projection.scores.sparkSession.createDataFrame(table, "column string, x double, y double, labelled boolean")


def top_loadings(projection: Projection, n: int = 10) -> DataFrame:
    """The n greatest loadings by size of each component (the table has columns x components rows)."""
    from pyspark.sql import Window

    w = Window.partitionBy("component").orderBy(F.abs("loading").desc(), "column")
    return projection.loadings.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def projection_report(df: DataFrame, columns: Sequence[str], color: str, key: Sequence[str], k: int = 3, clusters: int = 5, choose: bool = False) -> dict[str, DataFrame]:
    """PCA, loadings, biplot and clusters as tables."""
    p = project(df, columns, k, keep=[*key, color])
    grouped = cluster_components(p, clusters, color)
    out = {
        "scores": p.scores,
        "loadings": p.loadings,
        "top_loadings": top_loadings(p),
        "biplot": biplot_table(p),
        "clustered": grouped["rows"],
        "centers": grouped["centers"],
        "cluster_by_label": grouped["by_label"],
    }
    if choose:
        out["explained"] = component_choice(df, columns)[0]
    return out


# --- predictive models --------------------------------------------------------------------------


def task_of(df: DataFrame, target: str) -> str:
    """``classification`` for text or fewer than 10 distinct values, else ``regression``."""
    return tasks_of(df, [target])[target]


def tasks_of(df: DataFrame, targets: Sequence[str], few: int = 10) -> dict[str, str]:
    """Task of every target, from one aggregation for all of them."""
    kinds = dict(df.dtypes)
    numbers = [c for c in targets if kinds[c] != "string"]
    counts = df.agg(*[F.count_distinct(F.col(quoted(c))).alias(f"n{i}") for i, c in enumerate(numbers)]).first() if numbers else []
    distinct = dict(zip(numbers, counts))
    return {c: "classification" if kinds[c] == "string" or distinct[c] < few else "regression" for c in targets}


def preprocessing(numbers: Sequence[str], texts: Sequence[str], output: str = "features") -> list:
    """Stages: exact median + scaling for numbers, mode + one-hot for text; unseen labels become zeros."""
    stages: list = []
    parts: list[str] = []
    if texts:
        indexed = [f"{c}__index" for c in texts]
        encoded = [f"{c}__onehot" for c in texts]
        stages += [
            ConstantImputer(texts, "mode"),
            StringIndexer(inputCols=list(texts), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
            # The extra index for unseen labels is the dropped last category.
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
        parts += encoded
    if numbers:
        stages += [
            ConstantImputer(numbers, "median"),
            VectorAssembler(inputCols=list(numbers), outputCol="numbers__raw", handleInvalid="keep"),
            StandardScaler(inputCol="numbers__raw", outputCol="numbers__scaled", withMean=True),
        ]
        parts.append("numbers__scaled")
    return [*stages, VectorAssembler(inputCols=parts, outputCol=output)]


def default_models(task: str, rows: int, seed: int = 42) -> dict[str, tuple]:
    """Name -> (estimator, grid). Regularisation strengths are those of C = 0.1, 1 and 10 on ``rows`` rows."""
    strengths = [1.0 / (c * max(rows, 1)) for c in (0.1, 1.0, 10.0)]
    if task == "classification":
        logistic = LogisticRegression(maxIter=1000)
        svc = SupportVectorMachine(True, seed=seed)
        gbt = GBTClassifier(maxIter=100, seed=seed)
        forest = RandomForestClassifier(numTrees=100, seed=seed)
        return {
            "LogisticRegression": (logistic, ParamGridBuilder().addGrid(logistic.regParam, strengths).addGrid(logistic.elasticNetParam, [0.0, 0.5]).build()),
            "SVC": (svc, ParamGridBuilder().addGrid(svc.cost, [0.1, 1.0, 10.0]).addGrid(svc.kernel, ["linear", "rbf"]).build()),
            "GradientBoosting": (OneVsRest(classifier=gbt), ParamGridBuilder().addGrid(gbt.stepSize, [0.05, 0.1]).addGrid(gbt.maxDepth, [3, 5]).build()),
            "RandomForest": (forest, ParamGridBuilder().addGrid(forest.maxDepth, [10, 20]).addGrid(forest.minInstancesPerNode, [1, 2]).build()),
        }
    line = LinearRegression()
    svr = SupportVectorMachine(False, seed=seed)
    gbt = GBTRegressor(maxIter=100, seed=seed)
    forest = RandomForestRegressor(numTrees=100, seed=seed)
    return {
        "ElasticNet": (line, ParamGridBuilder().addGrid(line.regParam, [0.1, 1.0]).addGrid(line.elasticNetParam, [0.2, 0.5, 0.8]).build()),
        "SVR": (svr, ParamGridBuilder().addGrid(svr.cost, [0.1, 1.0]).addGrid(svr.kernel, ["linear", "rbf"]).build()),
        "GradientBoosting": (gbt, ParamGridBuilder().addGrid(gbt.stepSize, [0.05, 0.1]).addGrid(gbt.maxDepth, [3, 5]).build()),
        "RandomForest": (forest, ParamGridBuilder().addGrid(forest.maxDepth, [10, 20]).addGrid(forest.minInstancesPerNode, [1, 2]).build()),
    }


@dataclass
class Comparison:
    task: str
    results: DataFrame
    best: str
    models: dict[str, PipelineModel]
    predictions: dict[str, DataFrame] = field(default_factory=dict)
    labels: list[str] = field(default_factory=list)


def _validated(ready: DataFrame, choices: Mapping[str, tuple], evaluator, fold: str, folds: int, at_once: int) -> dict[str, np.ndarray]:
    """Mean score per model and candidate over the folds 0, 1, ... of a kept frame, each scored by a fit on the others.

    Fits of all models and folds run beside each other; what fits all folds by the same passes (``fit_folds``) does so."""
    sizes = {r[0]: r[1] for r in ready.groupBy(fold).count().collect()}
    total = sum(sizes.values())
    for i in range(folds):
        if sizes.get(i, 0) == total:
            raise ValueError(f"The training data at fold {i} is empty.")
        if not sizes.get(i):
            raise ValueError(f"The validation data at fold {i} is empty.")
    scores = {name: np.zeros((folds, len(grid))) for name, (_, grid) in choices.items()}

    def score(name: str, i: int, j: int, model) -> None:
        scores[name][i, j] = evaluator.evaluate(model.transform(ready.where(F.col(fold) == i)))

    def together(name: str) -> None:
        estimator, grid = choices[name]
        found = estimator.fit_folds(ready, grid, fold, folds)
        side_by_side(ready.sparkSession, [partial(score, name, i, j, model) for i, models in enumerate(found) for j, model in enumerate(models)], at_once)

    def alone(name: str, i: int, j: int) -> None:
        estimator, grid = choices[name]
        score(name, i, j, estimator.fit(ready.where(F.col(fold) != i), grid[j]))

    joint = [name for name, (estimator, _) in choices.items() if hasattr(estimator, "fit_folds")]
    works = [partial(together, name) for name in joint]
    works += [partial(alone, name, i, j) for name, (_, grid) in choices.items() if name not in joint for i in range(folds) for j in range(len(grid))]
    side_by_side(ready.sparkSession, works, at_once)
    return {name: s.mean(0) for name, s in scores.items()}


def compare_models(
    df: DataFrame,
    target: str,
    key: Sequence[str],
    numbers: Sequence[str] | None = None,
    texts: Sequence[str] = (),
    models: Mapping[str, tuple] | None = None,
    folds: int = 5,
    parallelism: int = 4,
    seed: int = 42,
) -> Comparison:
    """Grid search with cross validation per model, hold-out metrics on a stable 20 % split, best model
    by weighted F1 or RMSE. Columns derived from the target should not be passed as features."""
    spark = df.sparkSession
    task = task_of(df, target)
    numbers = [c for c in (numbers or columns_of_kind(df, "number", (target, *key))) if c != target]
    texts = [c for c in texts if c != target]
    rows = spread(df.where(F.col(quoted(target)).isNotNull()).select(*[F.col(quoted(c)) for c in dict.fromkeys([*key, *numbers, *texts, target])]))
    labels: list[str] = []
    if task == "classification":
        indexer = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(rows)
        labels, rows = list(indexer.labels), indexer.transform(rows)
    else:
        rows = rows.withColumn("label", F.col(quoted(target)).cast("double"))
    train, test = split(rows, key, 80, seed=seed)
    # Folds come from the key, so they do not depend on how rows are partitioned.
    train = train.withColumn("__fold", F.pmod(hash_order(key, seed + 1), F.lit(folds)).cast("int"))
    prepared = Pipeline(stages=preprocessing(numbers, texts)).fit(train)
    ready, held = prepared.transform(train).persist(), prepared.transform(test).persist()
    if task == "classification":
        evaluator = MulticlassClassificationEvaluator(metricName="f1")
    else:
        evaluator = RegressionEvaluator(metricName="mse")
    try:
        count = ready.count()
        choices = dict(models or default_models(task, count, seed))
        # Forests keep a copy of their rows while they grow, so those of large frames, whose tasks fill the cores anyhow, grow one after the other.
        at_once = parallelism if count <= ROWS_AT_ONCE else 1
        scores = _validated(ready, choices, evaluator, "__fold", folds, at_once)

        def finished(name: str) -> tuple:
            estimator, grid = choices[name]
            chosen = grid[int(np.argmax(scores[name]) if evaluator.isLargerBetter() else np.argmin(scores[name]))]
            text = ", ".join(f"{p.name}={v if isinstance(v, str) else format(v, 'g')}" for p, v in sorted(chosen.items(), key=lambda x: x[0].name))
            model = estimator.fit(ready, chosen)
            predicted = model.transform(held)
            if task == "classification":
                m = classification_metrics(predicted, "label", "prediction").first()
                return model, (name, m["accuracy"], m["f1"], None, None, None, None, text)
            m = regression_metrics(predicted, "label", "prediction").first()
            return model, (name, None, None, m["mse"], m["rmse"], m["mae"], m["r2"], text)

        done = dict(zip(choices, side_by_side(spark, [partial(finished, name) for name in choices], at_once)))
    finally:
        ready.unpersist()
        held.unpersist()
    table = [row for _, row in done.values()]
    fitted = {name: PipelineModel(stages=[*prepared.stages, model]) for name, (model, _) in done.items()}
    predictions = {name: model.transform(test) for name, model in fitted.items()}
    best = max(table, key=lambda r: r[2])[0] if task == "classification" else min(table, key=lambda r: r[4])[0]
    schema = "model string, accuracy double, f1 double, mse double, rmse double, mae double, r2 double, params string"
    return Comparison(task, spark.createDataFrame(table, schema), best, fitted, predictions, labels)


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return cross_counts(df, label, prediction)


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class, then the support-weighted average and the accuracy.

    Works on the confusion counts, which have one row per pair of classes that occurs."""
    counts = df.where(F.col(quoted(label)).isNotNull() & F.col(quoted(prediction)).isNotNull()).groupBy(
        F.col(quoted(label)).cast("string").alias("l"), F.col(quoted(prediction)).cast("string").alias("p")
    ).agg(F.count("*").alias("n"))
    sides = counts.select(F.explode(F.array(F.struct(F.col("l").alias("c"), F.lit(True).alias("actual")), F.struct(F.col("p").alias("c"), F.lit(False).alias("actual")))).alias("x"), "l", "p", "n")
    per_class = sides.groupBy("x.c").agg(
        F.sum(F.when(F.col("x.actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("x.actual"), F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("x.actual") & (F.col("l") == F.col("p")), F.col("n")).otherwise(0)).alias("hits"),
    )
    zero = F.lit(0).cast("long")
    precision = F.coalesce(F.col("hits") / F.nullif("predicted", zero), F.lit(0.0))
    recall = F.coalesce(F.col("hits") / F.nullif("support", zero), F.lit(0.0))
    scored = per_class.select(
        F.col("c").alias("class"), precision.alias("precision"), recall.alias("recall"), "support", "hits",
        F.coalesce(2 * F.col("hits") / F.nullif(F.col("support") + F.col("predicted"), zero), F.lit(0.0)).alias("f1"),
    )
    weight = F.nullif(F.sum("support"), zero)
    total = scored.agg(
        *[(F.sum(F.col(c) * F.col("support")) / weight).alias(c) for c in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
        (F.sum("hits") / weight).alias("accuracy"),
    )
    null = F.lit(None).cast("double")
    classes = scored.select("class", "precision", "recall", "f1", "support")
    average = total.select(F.lit("Weighted Avg").alias("class"), "precision", "recall", "f1", "support")
    accuracy = total.select(F.lit("Accuracy").alias("class"), F.col("accuracy").alias("precision"), null.alias("recall"), null.alias("f1"), F.lit(None).cast("long").alias("support"))
    return classes.unionByName(average).unionByName(accuracy)


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(accuracy, f1): share of hits and the support-weighted F1."""
    report = class_report(df, label, prediction)
    return report.agg(
        F.max(F.when(F.col("class") == "Accuracy", F.col("precision"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "Weighted Avg", F.col("f1"))).alias("f1"),
    )


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(mse, rmse, mae, r2) in one aggregation."""
    y, p = F.col(quoted(label)).cast("double"), F.col(quoted(prediction)).cast("double")
    rows = df.where(y.isNotNull() & p.isNotNull())
    error = (y - p) * (y - p)
    return rows.agg(F.avg(error).alias("mse"), F.avg(F.abs(y - p)).alias("mae"), F.var_pop(y).alias("v")).select(
        "mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.col("mse") / F.nullif("v", F.lit(0.0))).alias("r2")
    )


def named_importances(model: PipelineModel, frame: DataFrame, texts: Sequence[str], numbers: Sequence[str], top: int = 15) -> DataFrame:
    """The greatest importances as ``column=category`` or number columns, named from the fitted stages."""
    indexers = [s for s in model.stages if type(s).__name__ == "StringIndexerModel"]
    names: list[str] = []
    if texts and indexers:
        for c, values in zip(texts, indexers[0].labelsArray):
            names += [f"{c}={v}" for v in values]
    names += list(numbers)
    weights = model.stages[-1].featureImportances.toArray().tolist()
    if len(weights) != len(names):
        raise ValueError("the model does not fit the given columns")
    rows = sorted(zip(names, weights), key=lambda r: (-r[1], r[0]))[:top]
    return frame.sparkSession.createDataFrame(rows, "feature string, importance double")


def predict_labels(df: DataFrame, target: str, numbers: Sequence[str], trees: int = 100, depth: int = 5, out: str = "predicted", seed: int = 42) -> DataFrame:
    """A forest trained on the rows that know the label, applied to every row; gaps take the median."""
    from pyspark.ml.feature import IndexToString

    middle = medians(df, numbers)
    ready = df.withColumn("__f", array_to_vector(feature_vector(numbers, fill=middle)))
    known = ready.where(F.col(quoted(target)).isNotNull())
    index = StringIndexer(inputCol=target, outputCol="__y", stringOrderType="alphabetAsc").fit(known)
    forest = RandomForestClassifier(featuresCol="__f", labelCol="__y", predictionCol="__p", numTrees=trees, maxDepth=depth, seed=seed).fit(index.transform(known))
    named = IndexToString(inputCol="__p", outputCol=out, labels=index.labels).transform(forest.transform(ready))
    return named.select(*[F.col(quoted(c)) for c in df.columns], out)
