import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from gapweave.operators import impute, metric_index, neighbours, random_trees
from gapweave.plans import imputation
from gapweave.plans.views import PRODUCT_ROLES, view

COLUMNS = ["energy", "fat", "carbohydrates", "proteins", "sodium"]


@pytest.fixture(scope="module")
def products(spark, sf):
    return view(spark, sf, "products").where("code < 400").cache()


def brute_knn(frame: pd.DataFrame, k: int, weights: str) -> np.ndarray:
    m, codes = frame[COLUMNS].to_numpy(float), frame["code"].to_numpy()
    out = m.copy()
    for i, row in enumerate(m):
        shared = ~np.isnan(m) & ~np.isnan(row)
        with np.errstate(all="ignore"):
            d = np.where(shared.any(1), np.where(shared, (m - row) ** 2, 0).sum(1) * len(COLUMNS) / shared.sum(1), np.inf)
        for c in np.flatnonzero(np.isnan(row)):
            pool = np.flatnonzero(~np.isnan(m[:, c]) & np.isfinite(d))
            near = pool[np.lexsort((codes[pool], np.round(d[pool], 9)))][:k]
            if weights == "uniform":
                out[i, c] = m[near, c].mean()
            elif (d[near] == 0).any():
                out[i, c] = m[near[d[near] == 0], c].mean()
            else:
                w = 1 / np.sqrt(d[near])
                out[i, c] = (w * m[near, c]).sum() / w.sum()
    return out


@pytest.mark.parametrize("donor_rows", [10_000, 5])
@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_knn_fill_is_exact_on_both_paths(products, donor_rows, weights):
    # A third of the rows are copies of one row, gaps included.
    one = products.where("code = 10").first()
    copies = products.where("code < 130").select(*[F.col(c) if c == "code" else F.lit(one[c]).cast(t).alias(c) for c, t in products.dtypes])
    df = products.where("code >= 130").unionByName(copies)
    got = impute.knn_fill(df, COLUMNS, "code", 4, weights, donor_rows=donor_rows).orderBy("code").toPandas()
    want = brute_knn(df.orderBy("code").toPandas(), 4, weights)
    assert np.allclose(got[COLUMNS].to_numpy(float), want)


def gappy_points(width, n, seed, gaps):
    """Points in clumps, rounded, some with gaps of a few kinds and some with any."""
    rng = np.random.default_rng(seed)
    clumps = rng.normal(0, 10, (12, width))
    points = np.round(clumps[rng.integers(0, 12, n)] + rng.normal(0, 1, (n, width)), 2)
    kinds = [rng.random(width) < 0.3 for _ in range(3)]
    for i in range(n):
        if gaps and rng.random() < 0.5:
            points[i, kinds[i % 3] if rng.random() < 0.8 else rng.random(width) < 0.5] = np.nan
    return points


def brute_hits(asked, points, usable, k, digits=9):
    """Per query and target the positions of the k nearest usable points, in the order of the key."""
    out = {}
    width = points.shape[1]
    for i, q in enumerate(asked):
        shared = ~np.isnan(points) & ~np.isnan(q)
        diff = np.where(shared, points - q, 0.0)
        d = (diff * diff).sum(1) * width / np.maximum(shared.sum(1), 1)
        d[shared.sum(1) == 0] = np.inf
        d = neighbours.significant(d, digits)
        for t in range(usable.shape[1]):
            order = [j for j in np.lexsort((np.arange(len(d)), d)) if usable[j, t] and np.isfinite(d[j])]
            out[i, t] = order[:k]
    return out


@pytest.mark.parametrize(("width", "gaps"), [(2, False), (2, True), (8, True), (15, True)])
@pytest.mark.parametrize("rows", [100_000, 5])
def test_index_finds_the_same_neighbours(spark, monkeypatch, width, gaps, rows):
    monkeypatch.setattr(neighbours, "INDEXED_ROWS", 10)
    monkeypatch.setattr(neighbours, "MAX_PATTERNS", 3)
    monkeypatch.setattr(neighbours, "PART_ROWS", 20)
    monkeypatch.setattr(neighbours, "LOT_ROWS", 7)
    points, asked = gappy_points(width, 500, 1, gaps), gappy_points(width, 40, 2, gaps)
    usable = np.random.default_rng(3).random((500, 2)) < 0.8

    def cells(p):
        return [None if np.isnan(x) else float(x) for x in p]

    donors = spark.createDataFrame([(i, cells(p), [str(i) if u else None for u in us]) for i, (p, us) in enumerate(zip(points, usable, strict=True))], "key long, vec array<double>, values array<string>")
    queries = spark.createDataFrame([(cells(p), [0, 1]) for p in asked], "vec array<double>, wanted array<int>")
    found = {}
    for h in neighbours.nearest(queries, donors, 4, donor_rows=rows).collect():
        found.setdefault((tuple(h.vec), h.target), []).append((h["rank"], h.donor))
    for (i, t), want in brute_hits(asked, points, usable, 4).items():
        assert [d for _, d in sorted(found.get((tuple(cells(asked[i])), t), []))] == want


def test_index_leaves_cells_out():
    for width in (2, 8, 15):
        points, asked = gappy_points(width, 4000, 1, False), gappy_points(width, 2000, 1, False)
        index = metric_index.Pivots.learn(points, {(True,) * width: len(points)}, cell_rows=64)
        pool = neighbours._Donors(list(range(4000)), [list(p) for p in points], [["x"]] * 4000, 9, index)
        hits = list(pool.search([list(q) for q in asked], [{0}] * 2000, 5))
        assert sum(map(len, hits)) == 10_000
        # The pairs that were compared: cells hold 64 of 4,000 donors.
        assert pool.visited < 0.15 * 4000 * 2000, (width, pool.visited / 4000 / 2000)


def test_a_cell_part_meets_each_lot_of_queries_once(spark):
    dealt = spark.createDataFrame([(i, [float(i)], ["v"], i % 3, 0) for i in range(30)], "key long, vec array<double>, values array<string>, cell int, part int")
    visits = spark.createDataFrame([([float(i)], [0], [0, 2]) for i in range(20)], "vec array<double>, wanted array<int>, cells array<int>")
    plan = neighbours._met(dealt, visits, 2, 9)
    assert plan.count() == 20 * 2 * 2  # two cells of 10 donors each, two hits a visit


def test_label_votes_and_mode_fallback(spark):
    rows = [(i, "a" if i < 30 else "b", float(i)) for i in range(60)] + [(100, None, 2.0), (101, None, 55.0), (102, None, None)]
    df = spark.createDataFrame(rows, "k int, g string, v double")
    for donor_rows in (1000, 3):
        out = impute.KnnLabelImputer(["g"], "k", ["v"], 20, donor_rows=donor_rows).fit(df).transform(df)
        got = {r.k: r.g for r in out.where("k >= 100").collect()}
        assert got[100] == "a" and got[101] == "b" and got[102] in ("a", "b")
    few = impute.KnnLabelImputer(["g"], "k", ["v"], 1000).fit(df).transform(df)
    assert {r.g for r in few.where("k >= 100").collect()} == {"a"}


def test_imputers_never_touch_observed_cells(products):
    before = {r.code: r for r in products.collect()}
    steps = [
        impute.ConstantImputer(COLUMNS, "mean"),
        impute.MultiStageImputer(COLUMNS, "code"),
        impute.ChainedImputer(COLUMNS, 3),
        impute.ClusterMeanImputer(COLUMNS),
        impute.ForestImputer(COLUMNS, trees=3),
        impute.HierarchyImputer([("grp", "grade")]),
        impute.ScoreGradeImputer("fr_score", "grade"),
    ]
    for step in steps:
        out = step.fit(products).transform(products)
        assert out.columns == products.columns and out.count() == len(before)
        for r in out.collect():
            for c in products.columns:
                if before[r.code][c] is not None:
                    assert r[c] == pytest.approx(before[r.code][c]) if isinstance(r[c], float) else r[c] == before[r.code][c]


def test_stages_compose_in_a_pipeline(products):
    model = Pipeline(stages=[impute.ConstantImputer(["energy"]), impute.ScoreGradeImputer("fr_score", "grade")]).fit(products)
    assert model.transform(products).where("energy is null or grade is null").count() == 0


def test_hierarchy_order_and_ties(spark):
    rows = [("p", "x"), ("p", "x"), ("p", "y"), ("q", "y"), ("q", "y"), ("p", None), (None, "y"), (None, None), ("new", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k int, p string, c string")
    out = impute.HierarchyImputer([("p", "c")]).fit(df).transform(df).orderBy("k").collect()
    assert [(r.p, r.c) for r in out[5:]] == [("p", "x"), ("q", "y"), (None, None), ("new", None)]


def test_zero_strategy_and_skipped_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 2.0), (3, 1.0, 4.0)], "k int, a double, b double")
    out = impute.MultiStageImputer(["a", "b"], "k", strategy="zero").fit(df).transform(df).orderBy("k").collect()
    assert [(r.a, r.b) for r in out] == [(None, 0.0), (None, 2.0), (1.0, 4.0)]


def test_chained_equations_recover_a_plane(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=400), rng.normal(size=400)
    data = pd.DataFrame({"k": range(400), "a": a, "b": b, "c": 2 * a - b + 3})
    truth = data.copy()
    data.loc[::7, "c"] = np.nan
    data.loc[3::11, "a"] = np.nan
    df = spark.createDataFrame(data).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in "abc"})
    step = impute.ChainedImputer(["a", "b", "c"], 30)
    for parts in (1, 4):
        got = step.fit(df.repartition(parts)).transform(df).orderBy("k").toPandas()
        both = data.a.isna() & data.c.isna()
        assert np.abs(got.c - truth.c)[~both].max() < 0.05 and np.abs(got.a - truth.a)[~both].max() < 0.05
    assert step.rounds_used < 30


def test_randomised_trees_against_one_task(spark):
    """Level sums over many tasks give the forest of one task, and it fits steps of two columns."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 4, (600, 2)).astype(float)
    y = np.where(x[:, 0] > 1, 10.0, 0.0) + x[:, 1]
    state = spark.createDataFrame([([*map(float, r), float(t)],) for r, t in zip(x, y, strict=True)], "x array<double>")
    boxes = np.array([[0.0, 3.0], [0.0, 3.0], [0.0, 13.0]])
    forests, levels = [], []
    for parts in (1, 5):

        def run(level, parts=parts):
            def task(frames):
                yield from level((m, m[:, 2]) for m in (np.array(pdf["x"].tolist()) for pdf in frames if len(pdf)))

            levels.append(parts)
            rows = state.repartition(parts).mapInPandas(task, random_trees.SUMS)
            return rows.groupBy("tree", "node", "feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()

        forests.append(random_trees.grow(run, boxes, [0, 1], trees=10, depth=6))
    one, many = forests
    assert (one.feature == many.feature).all() and np.allclose(one.threshold, many.threshold) and np.allclose(one.value, many.value)
    assert levels.count(1) <= 9  # passes for all trees together: the depth, and three for draws that missed
    data = np.column_stack([x, y])
    assert np.abs(one.predict(data) - y).max() < 1e-9


def test_chained_trees(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 5, 500).astype(float)
    data = pd.DataFrame({"k": range(500), "a": a, "b": np.where(a > 2, 8.0, -3.0), "c": a * 3})
    truth = data.copy()
    data.loc[::7, "c"], data.loc[3::11, "b"] = np.nan, np.nan
    df = spark.createDataFrame(data).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in "abc"})
    step = impute.ChainedImputer(["a", "b", "c"], 20, estimator="trees")
    got = step.fit(df).transform(df).orderBy("k").toPandas()
    assert np.abs(got.c - truth.c).max() < 1e-6 and np.abs(got.b - truth.b).max() < 1e-6
    assert step.rounds_used < 20
    assert impute.ChainedImputer(["a"], estimator="trees").fit(df).transform(df).count() == 500
    with pytest.raises(ValueError):
        impute.ChainedImputer(["a"], estimator="boosted")


def test_stored_state_gives_the_same_rounds(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame(rng.normal(size=(300, 3)), columns=list("abc"))
    data["c"] = data.a - data.b + 0.1 * data.c
    data.loc[::5, "c"], data.loc[1::6, "a"] = np.nan, np.nan
    df = spark.createDataFrame(data).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in "abc"}).withColumn("k", F.monotonically_increasing_id())
    every, never = impute.ChainedImputer(list("abc"), 12, 1e-9, store_every=2), impute.ChainedImputer(list("abc"), 12, 1e-9, store_every=100)
    left, right = (s.fit(df).transform(df).orderBy("k").toPandas() for s in (every, never))
    assert every.rounds_used == never.rounds_used and np.allclose(left[list("abc")], right[list("abc")])


def test_stratified_fill_uses_the_global_value_for_small_strata(spark):
    rows = [(i, "big", float(i)) for i in range(25)] + [(100, "big", None), (101, "small", None), (102, None, None), (103, "small", 1000.0)]
    df = spark.createDataFrame(rows, "k int, s string, v double")
    got = {r.k: r.v for r in impute.stratified_fill(df, "s", ["v"]).collect()}
    assert got[100] == 12.0 and got[101] == got[102] == 12.5


def test_whole_number_columns_keep_a_broken_median(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    out = impute.ConstantImputer(["v"]).fit(df).transform(df)
    assert sorted(r.v for r in out.collect()) == [1.0, 1.5, 2.0]
    whole = impute.fill_constants(df, {"v": 7.0})
    assert dict(whole.dtypes)["v"] == "int" and sorted(r.v for r in whole.collect()) == [1, 2, 7]


def test_fitted_values_only(spark):
    fitted = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    df = spark.createDataFrame([("b",), ("zzz",), (None,)], "x string")
    assert [r.x for r in impute.restrict_to_fitted(df, fitted, ["x"]).collect()].count("a") == 1


def test_iterative_labels_note_their_confidence(products):
    filled, notes = impute.iterative_labels(products, ["grp"], "code", COLUMNS)
    missing = products.where("grp is null").count()
    assert filled.where("grp is null").count() == 0 and filled.count() == products.count()
    assert notes.count() == missing and notes.select("code").distinct().count() == missing
    assert {r.confidence for r in notes.select("confidence").distinct().collect()} <= {0.9, 0.75, 0.3}


def test_label_passes_end_once_no_label_is_missing(products, monkeypatch):
    seen = []
    plain = impute.KnnLabelImputer.fit
    monkeypatch.setattr(impute.KnnLabelImputer, "fit", lambda self, df: (seen.append(self.min_samples), plain(self, df))[1])
    whole = impute.fill_constants(products, {c: 1.0 for c in COLUMNS})
    filled, notes = impute.iterative_labels(whole, ["grp"], "code", COLUMNS)
    # Every row knows all features, so the first pass fills all labels.
    assert seen == [20] and filled.where("grp is null").count() == 0
    assert notes.count() == products.where("grp is null").count() > 0
    assert {r.stage for r in notes.select("stage").distinct().collect()} == {"labels-1"}
    again, none = impute.iterative_labels(filled, ["grp"], "code", COLUMNS)
    assert seen == [20] and none.count() == 0 and again.exceptAll(filled).count() == 0 and again.columns == filled.columns
    # The rows that know too little wait for the last pass; the second picks the same rows as the first.
    del seen[:]
    k = F.col("id")
    few = products.sparkSession.range(200).select(
        k.alias("code"), F.when(k % 9 != 1, F.when(k % 3 == 0, "a").otherwise("b")).alias("grp"), (k * 7 % 30).cast("double").alias("x"), F.when(k % 4 != 2, k.cast("double")).alias("y")
    )
    filled, notes = impute.iterative_labels(few, ["grp"], "code", ["x", "y"])
    assert seen == [20, 5] and filled.where("grp is null").count() == 0 and filled.count() == 200
    got = {r.code: r.stage for r in notes.collect()}
    assert got == {i: "labels-last" if i % 4 == 2 else "labels-1" for i in range(200) if i % 9 == 1}


def test_full_run_fills_everything_and_notes_every_gap(products):
    run = imputation.ImputationRun("code", PRODUCT_ROLES, levels=(("high", 0.8),), max_iterations=2, stratified=False)
    out = run.fit_transform(products)
    assert out.columns == products.columns and out.count() == products.count()
    assert run.missing_cells(out).count() == 0
    gaps = sum(r.missing for r in imputation.missing_report(products).collect())
    assert run.confidence.count() == gaps == run.history[0][2]
    report = {r.column: r for r in run.report().collect()}
    assert report["uk_score"].mean_confidence == pytest.approx(0.1)
    assert report["salt"].mean_confidence >= 0.8 - 1e-9


def test_a_run_leaves_out_steps_that_cannot_fill_anything(products):
    run = imputation.ImputationRun("code", PRODUCT_ROLES, stratified=False, numeric="zero")
    out = run.fit_transform(products)
    stages = [stage for stage, *_ in run.store.written]
    # Grades are filled before the text step begins, and only the other score has gaps after the first round.
    assert [s for s in stages if s.endswith(("-score", "-text"))] == ["high-score"]
    assert "medium-constraints" in stages
    assert run.missing_cells(out).count() == 0


def test_a_run_counts_the_gaps_of_each_state_once(products, monkeypatch):
    alone, counted = [], []
    plain = imputation.ImputationRun._counts
    fills = imputation.fill_percentages

    def counts(self):
        known = self._counted
        got = plain(self)
        counted.extend([self.store.step] if self._counted is not known else [])
        return got

    monkeypatch.setattr(imputation.ImputationRun, "_counts", counts)
    monkeypatch.setattr(imputation, "fill_percentages", lambda *a: alone.append(1) or fills(*a))
    run = imputation.ImputationRun("code", PRODUCT_ROLES, stratified=False, numeric="zero")
    out = run.fit_transform(products)
    assert not alone and counted == list(range(len(run.store.written)))
    # What was counted is what each state lacks.
    known = fills(products)
    assert run.history[0][2] == sum(round(products.count() * (1 - p / 100)) for p in known.values()) and run.missing_cells(out).count() == 0
    report = {r.column: r.mean_confidence for r in run.report().collect()}
    assert report["energy"] == pytest.approx(min(0.95, max(run.levels[0][1], known["energy"] / 100)))


def test_a_failure_of_the_relations_ends_the_run(products, monkeypatch):
    monkeypatch.setattr(imputation.models, "feature_relations", lambda *a, **b: 1 / 0)
    run = imputation.ImputationRun("code", PRODUCT_ROLES, levels=(("high", 0.8),), max_iterations=1, stratified=False, numeric="zero", relations=True)
    with pytest.raises(ZeroDivisionError):
        run.fit_transform(products)


def test_single_level_run_stops_when_little_changes(products):
    run = imputation.single_level_run("code", PRODUCT_ROLES, max_iterations=3, numeric="zero")
    out = run.fit_transform(products)
    assert len(run.history) <= 3
    assert out.where("uk_score is null").count() == products.where("uk_score is null").count()


def test_quality_of_a_constant_fill(spark):
    df = spark.createDataFrame([(i, 10.0 if i % 2 else 0.0, "a") for i in range(100)], "k int, v double, g string")
    fill = lambda x: impute.fill_constants(x, {"v": 5.0, "g": "a"})
    got = {r.column: r for r in imputation.imputation_quality(df, "k", fill, sample_rows=None).collect()}
    assert got["v"].rmse == pytest.approx(5.0) and got["v"].mape == pytest.approx(50.0) and got["g"].accuracy == 1.0
    assert 5 <= got["v"].hidden <= 35


def test_knn_is_the_same_at_every_scale(spark):
    from gapweave.operators.impute import KnnLabelImputer, knn_fill

    for scale in (1.0, 1e-3, 1e-6, 1e-9):
        rows = [(i, i * scale, float(i) if i % 7 else None) for i in range(120)]
        df = spark.createDataFrame(rows, "k long, x double, y double")
        filled = knn_fill(df, ["x", "y"], "k", k=1, scale={"x": (0.0, 1.0), "y": (0.0, 1.0)})
        # Rows with a gap share only x with others: the neighbour is one step away.
        assert all(abs(r["y"] - r["k"]) <= 1.0 for r in filled.collect())
        labelled = spark.createDataFrame([(i, (i % 2 + (i % 10) * 0.01) * scale, ("a", "b")[i % 2] if i % 5 else None) for i in range(200)], "k long, x double, g string")
        done = KnnLabelImputer(["g"], "k", ["x"]).fit(labelled).transform(labelled)
        assert all(r["g"] == ("a", "b")[r["k"] % 2] for r in done.collect())


def test_cluster_means_leave_no_gaps(spark):
    from gapweave.operators.impute import ClusterMeanImputer

    rows = [(i, 0.0 + i % 3, 5.0) for i in range(50)] + [(100 + i, 1000.0 + i % 3, None) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    model = ClusterMeanImputer(["a", "b"], k=2).fit(df)
    assert all(r["b"] == 5.0 for r in model.transform(df).collect())
    # Means are those of the fitted frame, also for a frame that knows nothing.
    assert [r["b"] for r in model.transform(df.where("k >= 100")).select("b").distinct().collect()] == [5.0]


def test_write_back_keeps_the_number_of_rows(spark):
    from gapweave.operators.joins import write_back

    df = spark.createDataFrame([(1, None), (2, 7.0), (None, None)], "k long, x double")
    updates = spark.createDataFrame([(1, 3.0), (1, 2.0), (None, 9.0)], "k long, x double")
    assert sorted(map(tuple, write_back(df, updates, ["k"], ["x"]).collect()), key=str) == sorted([(1, 2.0), (2, 7.0), (None, None)], key=str)


def test_a_query_goes_once_to_a_shelf_however_many_cells_it_reaches(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 1000)
    points, asked = gappy_points(12, 3000, 1, False), gappy_points(12, 50, 2, False)
    donors = spark.createDataFrame([(i, p.tolist(), [str(i)]) for i, p in enumerate(points)], "key long, vec array<double>, values array<string>")
    queries = spark.createDataFrame([(p.tolist(), [0]) for p in asked], "vec array<double>, wanted array<int>")
    sent, met = [], neighbours._met
    monkeypatch.setattr(neighbours, "_met", lambda dealt, visits, *more: (sent.append(visits.selectExpr("sum(size(cells)) n").first()["n"]), met(dealt, visits, *more))[1])
    hits = neighbours.nearest(queries, donors, 3, donor_rows=5)
    assert hits.count() == 50 * 3
    # 3,000 donors lie on at most six shelves; each search visits a shelf once.
    assert max(sent) <= 50 * 6
