import random
import re

import pytest
from pyspark.sql import functions as F

from gapweave.functions.similarity import text_ratio
from gapweave.operators import labels


def clean(text):
    return re.sub(r"\W", " ", text).lower().strip()


def sequential(items, cutoff, best, key_first):
    """The plain one-by-one scan over (label, n)."""
    leaders, out = [], {}
    for label, n in sorted(items, key=lambda r: (-r[1], r[0])):
        scores = [(text_ratio(clean(label), clean(x)) if key_first else text_ratio(clean(x), clean(label)), i) for i, x in enumerate(leaders)]
        scores = [s for s in scores if s[0] >= cutoff]
        if not scores:
            leaders.append(label)
            out[label] = label
        else:
            out[label] = leaders[max(scores, key=lambda s: (s[0], -s[1]))[1] if best else scores[0][1]]
    return out


# Fixed case: a~b and b~c are alike, a and c are not.
CHAIN = [("abcdefghij", 30), ("abcdefghXY", 20), ("abcdefWZXY", 10)]


@pytest.mark.parametrize("best,key_first,cutoff,batch", [(True, True, 85, 4), (False, False, 85, 4), (True, True, 70, 100)])
def test_leader_rounds_equal_the_scan(spark, best, key_first, cutoff, batch):
    rng = random.Random(5)
    words = ["red ring", "red rings", "old bolt", "cold bolt", "blue plate", "small gear", "small gears", "Item 00001"]
    items = {w: rng.randint(1, 50) for w in words}
    for _ in range(30):
        w = list(rng.choice(words))
        w[rng.randrange(len(w))] = rng.choice("abcxyz -")
        items["".join(w)] = rng.randint(1, 50)
    items.update({f"Item {i:05d}": 7 for i in range(25)})  # near copies of one another
    items = list(items.items())
    df = spark.createDataFrame(items, "id string, n long").withColumn("text", labels.clean_text("id"))
    got = {r.id: r.leader for r in labels.leader_groups(df, cutoff, best, key_first, batch).collect()}
    assert got == sequential(items, cutoff, best, key_first)


def test_chained_labels_stay_with_their_own_leader(spark):
    df = spark.createDataFrame(CHAIN, "id string, n long").withColumn("text", labels.clean_text("id"))
    got = {r.id: r.leader for r in labels.leader_groups(df, 75).collect()}
    assert got == sequential(CHAIN, 75, True, True)
    assert got["abcdefghXY"] == "abcdefghij" and got["abcdefWZXY"] == "abcdefWZXY"


# Combinations of two counters and their published groups and scores.
COMBINATIONS = [
    (0.0, 0.0, 233891, "0.0 ", 100), (1.0, 0.0, 3309, "0.0 ", 55), (2.0, 0.0, 38, "0.0 ", 55), (None, None, 71833, "nan ", 100),
    (0.0, 1.0, 8944, "1.0 ", 100), (1.0, 1.0, 1079, "1.0 ", 73), (2.0, 1.0, 14, "1.0 ", 55), (0.0, 2.0, 1019, "2.0 ", 100),
    (1.0, 2.0, 296, "2.0 ", 55), (2.0, 2.0, 6, "2.0 ", 73), (0.0, 3.0, 217, "3.0 ", 100), (1.0, 3.0, 69, "3.0 ", 55),
    (1.0, 4.0, 23, "4.0 ", 100), (0.0, 4.0, 21, "4.0 ", 55), (2.0, 4.0, 1, "4.0 ", 55), (0.0, 5.0, 6, "5.0 ", 100), (0.0, 6.0, 1, "6.0 ", 100),
]


def test_combination_groups_match_known_results(spark):
    df = spark.createDataFrame([c[:3] for c in COMBINATIONS], "a double, b double, frequency long")
    groups = labels.group_combinations(df, ["a", "b"], counted=True)
    got = {(r.a, r.b): (r.group, r.score, r.frequency) for r in groups.collect()}
    assert got == {(a, b): (g, s, n) for a, b, n, g, s in COMBINATIONS}
    totals = {r.group: r.total_frequency for r in groups.collect()}
    assert totals == {"0.0 ": 237238, "nan ": 71833, "1.0 ": 10037, "2.0 ": 1321, "3.0 ": 286, "4.0 ": 45, "5.0 ": 6, "6.0 ": 1}
    assert sum(r.percentage for r in groups.collect()) == pytest.approx(100.0)


def test_groups_partition_their_input(spark):
    df = spark.createDataFrame([(i % 3, f"name {i % 7}", "x" if i % 2 else None) for i in range(50)], "a int, b string, c string")
    groups = labels.group_combinations(df, ["a", "b", "c"], batch=3)
    assert groups.agg(F.sum("frequency")).first()[0] == 50
    assert groups.select("a", "b", "c").distinct().count() == groups.count()
    with pytest.raises(ValueError):
        labels.group_combinations(df, ["a"])


def test_best_and_all_matches_over_several_batches(spark):
    choices = [("red ring", 5), ("red rings", 9), ("blue bolt", 1), ("cold bolt", 3)]
    keys = ["red ringz", "bold bolt", "nothing"]
    c = spark.createDataFrame(choices, "choice string, n long").withColumn("text", F.col("choice"))
    k = spark.createDataFrame([(x, x) for x in keys], "key string, text string")
    ranked = sorted(choices, key=lambda r: (-r[1], r[0]))
    want_all = {(x, y, text_ratio(x, y)) for x in keys for y, _ in ranked if text_ratio(x, y) >= 80}
    for batch in (1, 10):
        assert {tuple(r) for r in labels.all_matches(k, c, 80, batch).collect()} == want_all
        best = {r.key: (r.match, r.score) for r in labels.best_match(k, c, 80, batch).collect()}
        for x in {w[0] for w in want_all}:
            top = max((text_ratio(x, y), -i, y) for i, (y, _) in enumerate(ranked))
            assert best[x] == (top[2], top[0])
        assert "nothing" not in best


def test_rare_labels_fall_back_to_parent_then_other(spark):
    counts = spark.createDataFrame([("fresh fruit", 200), ("fruit fresh", 5), ("zzz", 3), ("qqq", 2), ("unknown", 1)], "label string, n long")
    parents = spark.createDataFrame([("zzz", "sweets")], "label string, parent string")
    got = {r.label: r.target for r in labels.rare_label_mapping(counts, 100, parents).collect()}
    assert got == {"fresh fruit": "fresh fruit", "fruit fresh": "fresh fruit", "zzz": "sweets-other", "qqq": "Other", "unknown": "unknown"}
    none = {r.label: r.target for r in labels.rare_label_mapping(counts.where("n < 100"), 100, parents).collect()}
    assert none["zzz"] == "Other"


def test_two_level_simplification(spark):
    rows = [("Sweet-Snacks", "Candy bars")] * 12 + [("sweet snack", "candy bar")] * 3 + [("unknown", "unknown")] * 2 + [("drinks", "x")] * 11 + [(None, None)]
    out, maps = labels.simplify_categories(spark.createDataFrame(rows, "p string, c string"), "p", "c", 10)
    got = {tuple(r) for r in out.distinct().collect()}
    assert got == {("sweet snacks", "candy bars"), (None, None), ("drinks", "drinks-other")} or got == {
        ("sweet snacks", "candy bars"), (None, None), ("drinks", "x"),
    }
    assert out.count() == len(rows) and set(maps) == {"p", "c"}
    # A merged spelling maps to its standard name.
    assert {r.label: r.target for r in maps["p"].collect()}["sweet snack"] == "sweet snacks"


def test_canonical_combination_takes_the_most_frequent(spark):
    df = spark.createDataFrame([("g", "a", "b", 5), ("g", "c", "d", 9), ("h", "e", None, 1)], "group string, x string, y string, frequency long")
    got = {(r.group, r.frequency): (r.x, r.y) for r in labels.canonical_combinations(df, ["x", "y"]).collect()}
    assert got == {("g", 5): ("c", "d"), ("g", 9): ("c", "d"), ("h", 1): ("e", None)}
