"""Imputers: fit on one frame, apply to any frame with the same columns. Observed cells never change."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, functions as F, types as T

from gapweave.functions.scalars import grade_to_number, number_to_grade, quoted, score_to_grade
from gapweave.operators.joins import lookup_join, map_values
from gapweave.operators.neighbours import feature_vector, nearest, significant
from gapweave.operators.random_trees import SUMS, Forest, grow
from gapweave.operators.quantiles import medians, quantile_map, quantiles
from gapweave.operators.rules import replace_columns
from gapweave.operators.selection import fill_percentages, present_count, threshold_of
from gapweave.operators.stats import mode_by, modes
from gapweave.operators.windows import fill_by_group_mean
from gapweave.plans import rule_tables as rt
from gapweave.session import cut, spread


class Fitted(Model):
    """A learned column rewrite."""

    def __init__(self, apply: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.apply = apply

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.apply(dataset)


class _Step(Estimator):
    def _fit(self, dataset: DataFrame) -> Fitted:
        return Fitted(self._learn(dataset))

    def _learn(self, df: DataFrame) -> Callable[[DataFrame], DataFrame]:
        raise NotImplementedError


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Null cells of each column take its constant; a null constant changes nothing. A whole-number column
    becomes double when its constant is not whole."""
    changes = {}
    for f in df.schema:
        value = values.get(f.name)
        if value is None:
            continue
        broken = isinstance(f.dataType, T.IntegralType) and isinstance(value, float) and not value.is_integer()
        kind = T.DoubleType() if broken else f.dataType
        changes[f.name] = F.coalesce(F.col(quoted(f.name)).cast(kind), F.lit(value).cast(kind))
    return replace_columns(df, changes)


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(columns)}


class ConstantImputer(_Step):
    """Median, mean or mode of each column."""

    def __init__(self, columns: Sequence[str], statistic: str = "median"):
        super().__init__()
        self.columns = list(columns)
        self.statistic = statistic

    def _learn(self, df):
        learn = {"median": medians, "mean": column_means, "mode": modes}[self.statistic]
        values = learn(df, self.columns)
        return lambda x: fill_constants(x, values)


class HierarchyImputer(_Step):
    """Child from the parent's commonest child, then parent from the child's commonest parent."""

    def __init__(self, pairs: Sequence[tuple[str, str]] = (("pnns_groups_1", "pnns_groups_2"),)):
        super().__init__()
        self.pairs = list(pairs)

    def _learn(self, df):
        maps = []
        for parent, child in self.pairs:
            known = df.where(F.col(quoted(parent)).isNotNull() & F.col(quoted(child)).isNotNull())
            maps.append((parent, child, mode_by(known, child, [parent]), mode_by(known, parent, [child])))

        def apply(x: DataFrame) -> DataFrame:
            for parent, child, child_of, parent_of in maps:
                for source, target, table in ((parent, child, child_of), (child, parent, parent_of)):
                    x = map_values(x, source, table, source, "mode", out="__guess")
                    x = replace_columns(x, {target: F.coalesce(F.col(quoted(target)), F.col("__guess"))}).drop("__guess")
            return x

        return apply


class ScoreGradeImputer(_Step):
    """Score takes the median; grade is read off the filled score, else the commonest grade."""

    def __init__(self, score: str, grade: str):
        super().__init__()
        self.score, self.grade = score, grade

    def _learn(self, df):
        score, grade = self.score, self.grade
        has_score = score in df.columns
        median = medians(df, [score]).get(score) if has_score else None
        commonest = None
        if grade in df.columns:
            top = mode_by(df.select(grade_to_number(grade).alias("g")), "g").first()
            commonest = top["mode"] if top else 3

        def apply(x: DataFrame) -> DataFrame:
            if has_score and median is not None:
                x = fill_constants(x, {score: median})
            if grade in x.columns:
                guess = score_to_grade(score) if has_score else F.lit(None).cast("string")
                x = replace_columns(
                    x, {grade: F.coalesce(number_to_grade(grade_to_number(grade)), guess, number_to_grade(F.lit(commonest)))}
                )
            return x

        return apply


def _spread(df: DataFrame, features: Sequence[str], fill: Mapping[str, float]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) of the filled features, rounded to ten significant digits so that the order of
    summation cannot change which neighbour is nearest; a constant feature keeps spread 1."""
    filled = {f: F.coalesce(F.col(quoted(f)).cast("double"), F.lit(fill.get(f))) for f in features}
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(filled.values())],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(filled.values())],
    ).first()

    def number(name: str) -> float:
        x = row[name] or 0.0
        return float(np.sign(x) * significant(abs(x), 9))

    out = {}
    for i, f in enumerate(features):
        centre, spread = number(f"m{i}"), number(f"s{i}")
        # What is left of equal values after summation is no spread.
        out[f] = (centre, spread if spread > 1e-12 * abs(centre) else 1.0)
    return out


def _label_votes(donors: DataFrame, queries: DataFrame, key: str, column: str, features: Sequence[str], k: int, **options) -> DataFrame:
    """(vec, label): the majority label of the k nearest donors; ties by the lowest label."""
    del key
    hits = nearest(queries.select("vec", F.array(F.lit(0)).alias("wanted")), donors, k, **options)
    counted = hits.groupBy("vec", "value").agg(F.count("*").alias("n"))
    return counted.groupBy("vec").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("b")).select("vec", F.col("b.value").alias("__guess"))


class KnnLabelImputer(_Step):
    """Text columns by a vote of the nearest known rows over median-filled, standardised features.

    A column with at most ``min_samples`` known rows, and any row left over, takes the mode."""

    def __init__(self, columns: Sequence[str], key: str, features: Sequence[str] = (), min_samples: int = 50, k: int = 5, **options):
        super().__init__()
        self.columns, self.key, self.features = list(columns), key, list(features)
        self.min_samples, self.k, self.options = min_samples, k, options

    def _learn(self, df):
        best = modes(df, self.columns)
        row = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(self.columns)]).first()
        known = {c: row[f"c{i}"] for i, c in enumerate(self.columns)}
        features = [f for f in self.features if f in df.columns]
        fitted = {}
        for c in self.columns:
            if features and known[c] > self.min_samples:
                rows = df.where(F.col(quoted(c)).isNotNull())
                fill = medians(rows, features)
                scale = _spread(rows, features, fill)
                donors = rows.select(
                    F.col(quoted(self.key)).alias("key"),
                    feature_vector(features, scale, fill).alias("vec"),
                    F.array(F.col(quoted(c)).cast("string")).alias("values"),
                )
                fitted[c] = (fill, scale, donors)

        def apply(x: DataFrame) -> DataFrame:
            for c in self.columns:
                if c in fitted:
                    fill, scale, donors = fitted[c]
                    missing = F.col(quoted(c)).isNull()
                    vec = F.when(missing, feature_vector(features, scale, fill)).alias("vec")
                    votes = _label_votes(donors, x.where(missing).select(vec), self.key, c, features, self.k, **self.options)
                    joined = lookup_join(x.withColumn("vec", vec), votes, ["vec"])
                    x = replace_columns(joined, {c: F.coalesce(F.col(quoted(c)), F.col("__guess"))}).drop("vec", "__guess")
            return fill_constants(x, best)

        return apply


def restrict_to_fitted(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that never occur in the fitted frame become its mode."""
    best = modes(fitted, columns)
    for c in columns:
        valid = fitted.where(F.col(quoted(c)).isNotNull()).select(F.col(quoted(c)).alias("__v")).distinct().withColumn("__ok", F.lit(True))
        joined = lookup_join(df.withColumn("__v", F.col(quoted(c))), valid, ["__v"])
        invalid = F.col(quoted(c)).isNotNull() & F.col("__ok").isNull()
        df = replace_columns(joined, {c: F.when(invalid, F.lit(best.get(c))).otherwise(F.col(quoted(c)))}).drop("__v", "__ok")
    return df


def knn_fill(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    k: int = 5,
    weights: str = "uniform",
    donors: DataFrame | None = None,
    scale: dict[str, tuple[float, float]] | None = None,
    **options,
) -> DataFrame:
    """Null numbers take the (inverse-distance weighted) mean of the k nearest rows that know the column.

    At distance zero only the zero-distance donors count. A cell without any donor stays null."""
    columns = list(columns)
    vec = feature_vector(columns, scale)
    gaps = F.array_compact(F.array(*[F.when(F.col(quoted(c)).isNull(), F.lit(i)) for i, c in enumerate(columns)]))
    source = df if donors is None else donors
    pool = source.select(
        F.col(quoted(key)).alias("key"),
        vec.alias("vec"),
        F.array(*[F.col(quoted(c)).cast("double").cast("string") for c in columns]).alias("values"),
    ).where(F.exists("vec", lambda v: v.isNotNull()))
    flagged = df.withColumn("__gaps", gaps).withColumn("__vec", F.when(F.size(gaps) > 0, vec))
    asked = flagged.where(F.size("__gaps") > 0).select(F.col("__vec").alias("vec"), F.col("__gaps").alias("wanted"))
    hits = nearest(asked, pool, k, **options).withColumn("v", F.col("value").cast("double"))
    if weights == "distance":
        zero = F.col("distance") == 0
        inverse = 1 / F.nullif("distance", F.lit(0.0))
        mean = F.when(F.count_if(zero) > 0, F.avg(F.when(zero, F.col("v")))).otherwise(F.sum(F.col("v") * inverse) / F.sum(inverse))
    else:
        mean = F.avg("v")
    per_cell = hits.groupBy("vec", "target").agg(mean.alias("fill"))
    per_row = per_cell.groupBy("vec").agg(*[F.max(F.when(F.col("target") == i, F.col("fill"))).alias(f"__f{i}") for i in range(len(columns))])
    joined = lookup_join(flagged, per_row.withColumnRenamed("vec", "__vec"), ["__vec"])
    changes = {c: F.coalesce(F.col(quoted(c)).cast("double"), F.col(f"__f{i}")) for i, c in enumerate(columns)}
    return replace_columns(joined, changes).select(*[F.col(quoted(c)) for c in df.columns])


# --- chained equations --------------------------------------------------------------------------


class _Chain:
    """Fitted rounds of models; filling a batch replays them, from the start or from a stored state."""

    def __init__(self, means: np.ndarray, spreads: np.ndarray, order: list[int]):
        self.means, self.spreads, self.order = means, spreads, order
        self.rounds: list[dict[int, np.ndarray | Forest]] = []

    def begin(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(standardised matrix with gaps at the mean, null mask)."""
        x = (raw - self.means) / self.spreads
        missing = np.isnan(x)
        return np.where(missing, 0.0, x), missing

    def go_on(self, x: np.ndarray, missing: np.ndarray, rounds: list[dict]) -> tuple[np.ndarray, float]:
        """The matrix after more rounds, and the greatest change of a cell in the last of them. A round may hold only its first columns."""
        change = 0.0
        for number, fitted in enumerate(rounds):
            for j in self.order:
                gaps = missing[:, j]
                if j not in fitted or not gaps.any():
                    continue
                new = self._predicted(fitted[j], x[gaps], j)
                if number == len(rounds) - 1:
                    change = max(change, float(np.abs((new - x[gaps, j]) * self.spreads[j]).max()))
                x[gaps, j] = new
        return x, change

    @staticmethod
    def _predicted(model: np.ndarray | Forest, x: np.ndarray, j: int) -> np.ndarray:
        if isinstance(model, Forest):
            return model.predict(x)
        return np.column_stack([np.ones(len(x)), np.delete(x, j, axis=1)]) @ model

    def fill(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, missing = self.begin(raw)
        return self.go_on(x, missing, self.rounds)[0], missing


_STATE = "x array<double>, missing array<boolean>, change double"


def _states(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for pdf in frames:
        if len(pdf):
            yield np.array(pdf["x"].tolist(), dtype=float), np.array(pdf["missing"].tolist(), dtype=bool)


class ChainedImputer(_Step):
    """Iterative imputation: each gappy column is modelled by all others, in ascending order of missing cells, until the greatest
    change of a cell falls below ``tolerance`` x the greatest value.

    ``estimator="linear"``: a round is one pass; tasks return one Gram matrix per gappy column and the small systems are solved on the
    driver. ``estimator="trees"``: ``trees`` extremely randomised trees per column, one pass per level over all trees of the column, each
    column on the state that the columns before it left.

    The state of the chain (standardised cells and gaps) is written every ``store_every`` rounds, with trees every round, so a pass replays
    few rounds however many there were."""

    def __init__(
        self, columns: Sequence[str], max_rounds: int = 10, tolerance: float = 1e-3, ridge: float = 1e-6, estimator: str = "linear",
        trees: int = 10, depth: int = 6, seed: int = 42, store_every: int = 5,
    ):
        super().__init__()
        if estimator not in ("linear", "trees"):
            raise ValueError("estimator is linear or trees")
        self.columns, self.max_rounds, self.tolerance, self.ridge = list(columns), max_rounds, tolerance, ridge
        self.estimator, self.trees, self.depth, self.seed, self.store_every = estimator, trees, depth, seed, store_every
        self.rounds_used = 0

    def _learn(self, df):
        columns = self.columns
        cells = [F.col(quoted(c)).cast("double") for c in columns]
        row = df.agg(
            F.count("*").alias("n"),
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cells)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cells)],
            *[F.count(c).alias(f"c{i}") for i, c in enumerate(cells)],
            *[F.min(c).alias(f"l{i}") for i, c in enumerate(cells)],
            *[F.max(c).alias(f"h{i}") for i, c in enumerate(cells)],
        ).first()
        n, p = row["n"], len(columns)
        means = np.array([row[f"m{i}"] or 0.0 for i in range(p)])
        spreads = np.array([row[f"s{i}"] or 1.0 for i in range(p)])
        ends = np.array([[row[f"l{i}"] or 0.0, row[f"h{i}"] or 0.0] for i in range(p)])
        gaps = {i: n - row[f"c{i}"] for i in range(p)}
        order = sorted((i for i in range(p) if 0 < gaps[i] < n), key=lambda i: (gaps[i], i))
        chain = _Chain(means, spreads, order)
        limit = self.tolerance * (np.abs(ends).max() if p else 0.0)

        def begin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                if len(pdf):
                    x, missing = chain.begin(pdf.to_numpy(dtype=float))
                    yield pd.DataFrame({"x": list(x), "missing": list(missing), "change": 0.0})

        if order:
            state = df.select(*[c.alias(f"x{i}") for i, c in enumerate(cells)]).mapInPandas(begin, _STATE)
            step = self._tree_round if self.estimator == "trees" else self._linear_round
            boxes = (ends - means[:, None]) / spreads[:, None]
            every = 1 if self.estimator == "trees" else self.store_every
            stored = cut(state)
            since: list[dict] = []
            for _ in range(self.max_rounds):
                fitted, change = step(stored, chain, since, boxes)
                if fitted is None or (change is not None and change < limit):
                    break
                chain.rounds.append(fitted)
                self.rounds_used = len(chain.rounds)
                since = [*since, fitted]
                if len(since) == every:
                    stored = cut(stored.mapInPandas(_advanced(chain, since), _STATE))
                    since = []

        @F.pandas_udf("array<double>")
        def replay(*batch: pd.Series) -> pd.Series:
            raw = np.column_stack([b.to_numpy(dtype=float) for b in batch])
            x, missing = chain.fill(raw)
            return pd.Series(list(np.where(missing, x * chain.spreads + chain.means, raw)))

        def apply(x: DataFrame) -> DataFrame:
            filled = x.withColumn("__x", replay(*[F.col(quoted(c)).cast("double") for c in columns]))
            changes = {c: F.coalesce(F.col(quoted(c)).cast("double"), F.get("__x", F.lit(i))) for i, c in enumerate(columns)}
            return replace_columns(filled, changes).drop("__x")

        return apply

    def _linear_round(self, stored: DataFrame, chain: _Chain, since: list[dict], boxes: np.ndarray) -> tuple[dict, float | None]:
        """(coefficients per column, greatest change of the round before): one pass for the Gram matrices of all columns."""
        del boxes
        p = len(chain.means)
        sums = {
            (r["target"], r["pos"]): r["v"]
            for r in stored.mapInPandas(_gram_pass(chain, since), "target int, pos int, v double")
            .groupBy("target", "pos")
            .agg(F.when(F.col("target") < 0, F.max("v")).otherwise(F.sum("v")).alias("v"))
            .collect()
        }
        change = sums.get((-1, 0), 0.0) if chain.rounds else None
        fitted = {}
        for j in chain.order:
            size = p + 1
            gram = np.array([sums.get((j, i), 0.0) for i in range(size * size)]).reshape(size, size)
            keep = [i for i in range(size) if i != j + 1]
            a = gram[np.ix_(keep, keep)] + self.ridge * max(gram[0, 0], 1.0) * np.diag([0.0] + [1.0] * (p - 1))
            fitted[j] = np.linalg.lstsq(a, gram[keep, j + 1], rcond=None)[0]
        return fitted, change

    def _tree_round(self, stored: DataFrame, chain: _Chain, since: list[dict], boxes: np.ndarray) -> tuple[dict | None, float | None]:
        """(forest per column, None), or None for the forests once the written round changed too little."""
        if chain.rounds:
            last = stored.agg(F.max("change")).first()[0] or 0.0
            widest = np.abs(boxes * chain.spreads[:, None] + chain.means[:, None]).max()
            if last < self.tolerance * widest:
                return None, None
        fitted: dict[int, Forest] = {}
        for j in chain.order:
            earlier = [*since, dict(fitted)] if fitted else since

            def run(level, j=j, earlier=earlier) -> list:
                def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                    def batches():
                        for x, missing in _states(frames):
                            x, _ = chain.go_on(x, missing, earlier)
                            known = ~missing[:, j]
                            yield x[known], x[known, j]

                    yield from level(batches())

                return stored.mapInPandas(task, SUMS).groupBy("tree", "node", "feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()

            others = [i for i in range(len(chain.means)) if i != j]
            fitted[j] = grow(run, boxes, others, self.trees, self.depth, seed=self.seed * 1000 + j)
        return fitted, None


def _advanced(chain: _Chain, rounds: list[dict]):
    """The state after more rounds, with the greatest change of each row's batch in the last one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x, missing in _states(frames):
            x, change = chain.go_on(x, missing, rounds)
            yield pd.DataFrame({"x": list(x), "missing": list(missing), "change": change})

    return run


def _gram_pass(chain: _Chain, since: list[dict]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = len(chain.means)
        grams = {j: np.zeros((p + 1, p + 1)) for j in chain.order}
        change = 0.0
        for pdf in frames:
            if not len(pdf):
                continue
            change = max(change, float(pdf["change"].max()) if not since else 0.0)
            x, missing = np.array(pdf["x"].tolist(), dtype=float), np.array(pdf["missing"].tolist(), dtype=bool)
            x, moved = chain.go_on(x, missing, since)
            change = max(change, moved)
            design = np.column_stack([np.ones(len(x)), x])
            for j in chain.order:
                known = design[~missing[:, j]]
                grams[j] += known.T @ known
        rows = [(j, i, v) for j, g in grams.items() for i, v in enumerate(g.ravel())]
        rows.append((-1, 0, change))
        yield pd.DataFrame(rows, columns=["target", "pos", "v"])

    return run


class ClusterMeanImputer(_Step):
    """Mean fill, K-means, then the mean of the cluster's known cells in the fitted frame; a column that a cluster does
    not know takes its overall mean."""

    def __init__(self, columns: Sequence[str], k: int = 5, seed: int = 42):
        super().__init__()
        self.columns, self.k, self.seed = list(columns), k, seed

    def _learn(self, df):
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.feature import VectorAssembler

        means = column_means(df, self.columns)
        inputs = [f"__i{i}" for i in range(len(self.columns))]

        def filled(x: DataFrame) -> DataFrame:
            return x.withColumns({n: F.coalesce(F.col(quoted(c)).cast("double"), F.lit(means[c] or 0.0)) for n, c in zip(inputs, self.columns)})

        assembler = VectorAssembler(inputCols=inputs, outputCol="__f")
        model = KMeans(k=self.k, seed=self.seed, featuresCol="__f", predictionCol="__cluster").fit(assembler.transform(filled(df)))

        def placed(x: DataFrame) -> DataFrame:
            return model.transform(assembler.transform(filled(x))).drop("__f", *inputs)

        # One row for each of the k clusters.
        rows = placed(df).groupBy("__cluster").agg(*[F.avg(F.col(quoted(c)).cast("double")).alias(f"m{i}") for i, c in enumerate(self.columns)]).collect()
        centre = {r["__cluster"]: r for r in rows}

        def mean_of(i: int, c: str):
            known = [F.lit(x) for cluster, r in centre.items() if r[f"m{i}"] is not None for x in (cluster, r[f"m{i}"])]
            own = F.create_map(*known)[F.col("__cluster")] if known else F.lit(None)
            return F.coalesce(F.col(quoted(c)).cast("double"), own, F.lit(means[c]))

        def apply(x: DataFrame) -> DataFrame:
            return replace_columns(placed(x), {c: mean_of(i, c) for i, c in enumerate(self.columns)}).drop("__cluster")

        return apply


class ForestImputer(_Step):
    """One random forest per gappy column, trained on the rows that know it; other gaps take the median."""

    def __init__(self, columns: Sequence[str], trees: int = 100, depth: int = 5, seed: int = 42):
        super().__init__()
        self.columns, self.trees, self.depth, self.seed = list(columns), trees, depth, seed

    def _learn(self, df):
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import RandomForestRegressor

        fills = fill_percentages(df, self.columns)
        middle = medians(df, self.columns)
        inputs = {c: f"__i{i}" for i, c in enumerate(self.columns)}

        def filled(x: DataFrame) -> DataFrame:
            return x.withColumns({n: F.coalesce(F.col(quoted(c)).cast("double"), F.lit(middle[c] or 0.0)) for c, n in inputs.items()})

        models = []
        rows = spread(df.select(*[F.col(quoted(c)) for c in self.columns])).persist()
        try:
            for c in self.columns:
                if 0 < fills[c] < 100:
                    features = VectorAssembler(inputCols=[n for o, n in inputs.items() if o != c], outputCol="__f")
                    forest = RandomForestRegressor(featuresCol="__f", labelCol=inputs[c], predictionCol="__p", numTrees=self.trees, maxDepth=self.depth, seed=self.seed)
                    known = filled(rows.where(F.col(quoted(c)).isNotNull()))
                    models.append((c, features, forest.fit(features.transform(known))))
        finally:
            rows.unpersist()

        def apply(x: DataFrame) -> DataFrame:
            out = filled(x)
            for c, features, model in models:
                out = model.transform(features.transform(out))
                out = replace_columns(out, {c: F.coalesce(F.col(quoted(c)).cast("double"), F.col("__p"))}).drop("__f", "__p")
            return out.drop(*inputs.values())

        return apply


class MultiStageImputer(_Step):
    """Robust scaling, nearest neighbours weighted by distance, chained equations (by default with trees) for what is left, then means.

    Columns with more than ``max_missing_pct`` percent missing are left alone. ``strategy="zero"`` puts 0
    into every gap instead, as an unscaled fill before the stages would."""

    def __init__(
        self, columns: Sequence[str], key: str, k: int = 5, max_rounds: int = 50, max_missing_pct: float = 50.0, strategy: str = "staged", estimator: str = "trees", **options
    ):
        super().__init__()
        self.estimator = estimator
        self.columns, self.key, self.k = list(columns), key, k
        self.max_rounds, self.max_missing_pct, self.strategy, self.options = max_rounds, max_missing_pct, strategy, options

    def _learn(self, df):
        fills = fill_percentages(df, self.columns)
        columns = [c for c in self.columns if 100 - fills[c] <= self.max_missing_pct]
        if self.strategy == "zero" or not columns:
            return lambda x: fill_constants(x, {c: 0.0 for c in columns})
        q = quantile_map(df, columns, [0.25, 0.5, 0.75])
        scale = {c: (q[(c, 0.5)] or 0.0, ((q[(c, 0.75)] or 0.0) - (q[(c, 0.25)] or 0.0)) or 1.0) for c in columns}
        means = column_means(df, columns)
        chained = ChainedImputer(columns, self.max_rounds, estimator=self.estimator)

        def apply(x: DataFrame) -> DataFrame:
            near = knn_fill(x, columns, self.key, self.k, "distance", donors=df, scale=scale, **self.options)
            # A gap outlives the neighbours only in rows that share no feature with any donor.
            left = near.where(present_count(columns) < len(columns)).limit(1).count()
            if left:
                near = chained.fit(df).transform(near)
            return fill_constants(near, means)

        return apply


def stratified_fill(df: DataFrame, stratum: str, columns: Sequence[str], min_rows: int = 20, statistic: str = "median") -> DataFrame:
    """Gaps take the statistic of their stratum if it has more than ``min_rows`` rows, else the global one."""
    s = F.col(quoted(stratum))
    sizes = df.where(s.isNotNull()).groupBy(s.alias("__s")).agg(F.count("*").alias("__n")).where(F.col("__n") > min_rows).select("__s")
    rows = df.withColumn("__s", s)
    if statistic == "median":
        long = quantiles(rows, columns, [0.5], ["__s"]).select("__s", "column", "value")
        table = long.groupBy("__s").agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"__v{i}") for i, c in enumerate(columns)])
        general = medians(df, columns)
    elif statistic == "mean":
        table = rows.groupBy("__s").agg(*[F.avg(quoted(c)).alias(f"__v{i}") for i, c in enumerate(columns)])
        general = column_means(df, columns)
    else:
        table = sizes
        for i, c in enumerate(columns):
            table = table.join(mode_by(rows.where(s.isNotNull()), c, ["__s"]).select("__s", F.col("mode").alias(f"__v{i}")), "__s", "left")
        general = modes(df, columns)
    joined = lookup_join(rows, table.join(sizes, "__s", "left_semi"), ["__s"])
    changes = {c: F.coalesce(F.col(quoted(c)), F.col(f"__v{i}")) for i, c in enumerate(columns)}
    return fill_constants(replace_columns(joined, changes).select(*[F.col(quoted(c)) for c in df.columns]), general)


def imputed_confidence(df: DataFrame, key: Sequence[str], columns: Sequence[str], threshold: float = 0.5, stage: str = "fill") -> DataFrame:
    """(key..., column, confidence, stage) for every gap: the column's share of known cells, at least
    ``threshold`` and at most 0.95."""
    fills = fill_percentages(df, columns)
    items = [
        F.when(
            F.col(quoted(c)).isNull(),
            F.struct(F.lit(c).alias("column"), F.lit(min(0.95, max(threshold, fills[c] / 100))).alias("confidence"), F.lit(stage).alias("stage")),
        )
        for c in columns
    ]
    keys = [F.col(quoted(k)) for k in key]
    return df.select(*keys, F.explode(F.array_compact(F.array(*items))).alias("i")).select(*keys, "i.*")


def iterative_labels(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    features: Sequence[str],
    percentiles: Sequence[float] = rt.LABEL_PERCENTILES,
    confidences: Sequence[float] = rt.LABEL_CONFIDENCE,
    last_confidence: float = rt.LABEL_LAST_CONFIDENCE,
    k: int = 5,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Labels of the most complete rows first, then of all rows: (filled frame, confidence table).

    Each pass works on the rows with at least the given percentile of known features; the last one on all."""
    columns, features = list(columns), [f for f in features if f in df.columns]
    if not features:
        return df, df.select(F.col(quoted(key)), F.lit("").alias("column"), F.lit(0.0).alias("confidence"), F.lit("").alias("stage")).limit(0)
    state = label_pass_state(df, columns, key, features, percentiles, confidences, last_confidence, k, **options)
    table = state.select(F.col(quoted(key)), F.explode("__conf").alias("i")).select(quoted(key), "i.*")
    return state.drop("__conf"), table


def label_pass_state(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    features: Sequence[str],
    percentiles: Sequence[float] = rt.LABEL_PERCENTILES,
    confidences: Sequence[float] = rt.LABEL_CONFIDENCE,
    last_confidence: float = rt.LABEL_LAST_CONFIDENCE,
    k: int = 5,
    **options,
) -> DataFrame:
    """The filled frame with its notes in ``__conf``, an array of (column, confidence, stage)."""
    columns = list(columns)
    entry = "array<struct<column:string,confidence:double,stage:string>>"
    state = df.withColumn("__conf", F.array().cast(entry))
    passes = [(p, c, f"labels-{i + 1}", 20) for i, (p, c) in enumerate(zip(percentiles, confidences))]
    gap = reduce(or_, [F.col(quoted(c)).isNull() for c in columns])
    for percentile, confidence, stage, least in [*passes, (None, last_confidence, "labels-last", 5)]:
        # At most one row more than there are features.
        counts = state.groupBy(present_count(features).alias("k")).agg(F.count("*").alias("n"), F.count_if(gap).alias("gaps")).collect()
        if not any(r["gaps"] for r in counts):
            break  # nothing is left to vote on
        if percentile is None:
            focus, rest = state, None
        else:
            least_known = threshold_of({r["k"]: r["n"] for r in counts}, percentile)
            enough = present_count(features) >= least_known
            focus, rest = state.where(enough), state.where(~enough)
            if not any(r["gaps"] for r in counts if r["k"] >= least_known):
                continue  # two percentiles may pick the same rows
        gap_flags = F.array(*[F.col(quoted(c)).isNull() for c in columns])
        filled = KnnLabelImputer(columns, key, features, least, k, **options).fit(focus).transform(focus.withColumn("__label_null", gap_flags))
        new = F.array_compact(
            F.array(
                *[
                    F.when(
                        F.get("__label_null", F.lit(i)) & F.col(quoted(c)).isNotNull(),
                        F.struct(F.lit(c).alias("column"), F.lit(confidence).alias("confidence"), F.lit(stage).alias("stage")),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        ).cast(entry)
        filled = filled.withColumn("__conf", F.concat("__conf", new)).drop("__label_null")
        state = cut(filled if rest is None else filled.unionByName(rest))
    return state


def impute_numbers(df: DataFrame, method: str, columns: Sequence[str], key: str, **options) -> DataFrame:
    """One numeric method by name: median, knn, kmeans, random_forest or iterative_imputer."""
    if method == "knn":
        return fill_constants(knn_fill(df, columns, key, **options), column_means(df, columns))
    steps = {
        "kmeans": lambda: ClusterMeanImputer(columns, **options),
        "random_forest": lambda: ForestImputer(columns, **options),
        "iterative_imputer": lambda: ChainedImputer(columns, **options),
        "median": lambda: ConstantImputer(columns, "median"),
    }
    return steps.get(method, steps["median"])().fit(df).transform(df)
