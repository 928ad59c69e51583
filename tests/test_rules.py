import pytest
from pyspark.sql import functions as F

from gapweave.operators import rules
from gapweave.plans import rule_tables as rt

ROLES = {r: r for r in (*rt.NUTRIENTS, "fr_score", "uk_score", "grade", "group")}


def frame(spark, rows, columns):
    kinds = {"group": "string", "grade": "string", "k": "int"}
    schema = ", ".join(f"`{c}` {kinds.get(c, 'double')}" for c in columns)
    return spark.createDataFrame(rows, schema)


def result(df, *columns):
    return [tuple(r) for r in df.orderBy("k").select(*columns).collect()]


def test_integrity_limits_then_pairs(spark):
    df = frame(spark, [(1, 96.0, 50.0), (2, 40.0, 41.0), (3, 10.0, 56.0), (4, None, 3.0)], ["k", "fat", "saturated_fat"])
    out = rules.check_integrity(df, columns=ROLES)
    # Row 1: fat is cleared by its limit, so the pair is not compared any more.
    assert result(out, "fat", "saturated_fat") == [(None, 50.0), (40.0, None), (10.0, None), (None, 3.0)]
    found = rules.integrity_violations(df, "k", columns=ROLES)
    assert sorted(map(tuple, found.collect())) == [(1, "fat > 95", 96.0), (2, "saturated_fat > fat", 41.0), (3, "saturated_fat > 55", 56.0)]


def test_grade_ranges(spark):
    rows = [(1, "a", -5.0, -5.0), (2, "A", 5.0, 5.0), (3, "c", 5.0, -3.0), (4, "b", None, 1.0), (5, "z", 99.0, 1.0), (6, None, 1.0, 1.0)]
    df = frame(spark, rows, ["k", "grade", "fr_score", "uk_score"])
    out = result(rules.check_grades(df, ROLES), "grade", "fr_score")
    assert out == [("a", -5.0), (None, None), ("c", 5.0), (None, None), ("z", 99.0), (None, 1.0)]
    strict = result(rules.check_grades(df, ROLES, strict_case=True), "grade")
    assert strict == [("a",), (None,), ("c",), ("b",), ("z",), (None,)]


def test_datetime_fill_and_discrepancies(spark):
    df = spark.createDataFrame(
        [(1, 0, None), (2, 86400, "1970-01-02T10:00:00Z"), (3, 86400, "1970-01-03T00:00:00Z"), (4, None, "bad")], "k int, t long, d string"
    )
    filled = rules.fill_datetime(df, "t", "d").orderBy("k").select(F.col("d").cast("string")).collect()
    assert [r[0] for r in filled] == ["1970-01-01 00:00:00", "1970-01-02 10:00:00", "1970-01-03 00:00:00", None]
    assert [r.k for r in rules.datetime_discrepancies(df, "k", "t", "d").collect()] == [3]


def test_constraints_zero_rules_and_drinks(spark):
    rows = [(1, "meat", 0.0, 0.0), (2, "dairy", 0.0, -3.0), (3, "beverages", 0.0, 0.0), (4, None, 0.0, 0.0), (5, "sweets", 0.0, 0.0)]
    df = frame(spark, rows, ["k", "group", "proteins", "fat"])
    out = result(rules.apply_constraints(df, ROLES), "proteins", "fat")
    assert out == [(10.0, 0.01), (3.0, 0.01), (0.0, 0.0), (0.1, 0.01), (0.1, 0.01)]


def test_constraints_salt(spark):
    rows = [(1, 1.0, None), (2, None, 5.0), (3, 0.0, 0.0), (4, 0.0, 1.0), (5, 1.0, 2.45), (6, 1.0, 4.0)]
    df = frame(spark, rows, ["k", "sodium", "salt"])
    assert result(rules.apply_constraints(df, ROLES), "sodium", "salt") == [(1.0, 2.5), (2.0, 5.0), (0.0, 0.0), (0.0, 0.0), (1.0, 2.45), (1.0, 2.5)]


def test_constraints_parts_and_null_group(spark):
    rows = [(1, "dairy", 10.0, 0.0), (2, None, 10.0, 0.0), (3, "fish", 10.0, 12.0), (4, "other", 0.4, 0.0)]
    df = frame(spark, rows, ["k", "group", "fat", "saturated_fat"])
    assert result(rules.apply_constraints(df, ROLES), "saturated_fat") == [(6.0,), (0.0,), (8.0,), (0.0,)]
    without = rules.apply_constraints(df.drop("group"), {**ROLES})
    assert result(without, "saturated_fat")[1] == (3.0,)


def test_constraints_balance_and_energy(spark):
    rows = [(1, 1000.0, 80.0, 80.0, 50.0), (2, None, 1.0, 1.0, 1.0), (3, 100.0, 1.0, 1.0, 1.0), (4, 17.0, 1.0, 1.0, 1.0)]
    df = frame(spark, rows, ["k", "energy", "fat", "carbohydrates", "proteins"])
    out = result(rules.apply_constraints(df, ROLES), "energy", "fat", "carbohydrates", "proteins")
    total = 210.0
    fat, carbs, protein = 80 * 100 / total, 80 * 100 / total, 50 * 100 / total
    theory = protein * 4 + carbs * 4 + fat * 9
    assert out[0][1:] == pytest.approx((fat, carbs, protein))
    assert out[0][0] == pytest.approx((950 + theory) / 2 if abs(950 - theory) / theory > 0.2 else 950.0)
    assert [r[0] for r in out[1:]] == [17.0, 58.5, 17.0]


def test_constraints_respect_caps(spark):
    rows = [(i, *[float((i * p) % 1200) for p in (7, 11, 13, 17, 19, 23, 29, 31)]) for i in range(50)]
    names = ["energy", "fat", "saturated_fat", "carbohydrates", "sugars", "proteins", "sodium", "salt"]
    out = rules.apply_constraints(frame(spark, rows, ["k", *names]), ROLES)
    top = out.agg(*[F.max(c).alias(c) for c in names]).first()
    assert all(top[c] <= rt.LIMITS_KCAL[c] for c in names)


def test_relation_rules_with_zero_denominators(spark):
    rows = [
        (1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),  # nothing at all is consistent
        (2, 0.0, 1.0, 5.0, 0.0, 0.0, 0.0),  # zero expected, something measured
        (3, 1.0, 2.4, 17.0, 1.0, 1.0, 1.0),
        (4, None, 1.0, 17.0, None, 1.0, 1.0),
        (5, 1.0, None, 2000.0, 100.0, 100.0, 100.0),
    ]
    df = frame(spark, rows, ["k", "sodium", "salt", "energy", "fat", "carbohydrates", "proteins"])
    summary, fixed = rules.validate_relations(df, ROLES)
    got = {r.relation: r for r in summary.collect()}
    assert (got["sodium-salt"].checked, got["sodium-salt"].inconsistent) == (3, 1)
    assert (got["energy-macronutrients"].checked, got["energy-macronutrients"].inconsistent) == (4, 1 + 0)
    assert got["energy-macronutrients"].fat_solved == 1
    out = result(fixed, "salt", "energy", "fat")
    assert out[1][:2] == (0.0, 0.0)
    assert out[3][2] == pytest.approx(1.0)


def test_energy_cap_and_solved_parts(spark):
    rows = [(1, 10.0, 100.0, 100.0, 100.0), (2, 900.0, None, 1.0, 1.0), (3, 1.0, 50.0, None, 1.0)]
    df = frame(spark, rows, ["k", "energy", "fat", "carbohydrates", "proteins"])
    out = result(rules.fix_energy_macros(df, ROLES), "energy", "fat", "carbohydrates")
    assert out == [(950.0, 100.0, 100.0), (900.0, 95.0, 1.0), (1.0, 50.0, 0.0)]


def test_score_alignment(spark):
    rows = [(1, "A", 5.0, 5.4), (2, "a", 5.0, 9.0), (3, "b", None, 2.0), (4, None, 7.5, 1.0), (5, "a", None, None), (6, "e", 20.0, None)]
    df = frame(spark, rows, ["k", "grade", "fr_score", "uk_score"])
    out = rules.align_scores(df, ROLES)
    assert "uk_score" not in out.columns
    assert result(out, "grade", "fr_score") == [("a", 5), ("a", 9), ("b", 2), (None, 8), ("a", None), ("e", 20)]


def test_counters_are_taken_in_the_pass_that_writes(spark, sf, tmp_path):
    from gapweave.plans.views import PRODUCT_ROLES, view

    df = view(spark, sf, "products")
    fixed, seen = rules.observed_relations(df, PRODUCT_ROLES)
    fixed.write.parquet(str(tmp_path / "fixed"))
    want = rules.relation_summary(df, PRODUCT_ROLES).collect()
    assert rules.relation_rows(spark, seen.get).collect() == want and len(want) == 2
    assert rules.relation_rows(spark, {}).count() == 0
    limited, broken = rules.observed_integrity(df, columns=PRODUCT_ROLES)
    plan = limited._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == df._jdf.queryExecution().executedPlan().toString().count("FileScan") and "CollectMetrics" in plan
    limited.write.parquet(str(tmp_path / "limited"))
    found = {r.rule: r.n for r in rules.integrity_violations(df, "code", columns=PRODUCT_ROLES).groupBy("rule").count().withColumnRenamed("count", "n").collect()}
    counted = {r.rule: r.n for r in rules.counter_rows(spark, broken.get).collect()}
    assert {k: v for k, v in counted.items() if v} == found and sum(found.values()) > 0
