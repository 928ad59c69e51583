
from pyspark.sql import Row, functions as F

from gapweave.functions import scalars as fn
from gapweave.functions.similarity import possible_pairs, char_profile, ratio, text_ratio


def one(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_nan_becomes_null_once(spark):
    df = fn.nan_to_null(spark.createDataFrame([(1, float("nan")), (2, 3.0), (3, None)], "k int, v double"))
    assert [r.v for r in df.orderBy("k").collect()] == [None, 3.0, None]


def test_labels_and_tokens(spark):
    df = spark.createDataFrame([(" Fruits-and   Vegetables ",), (None,), ("Été-Noix!",)], "x string")
    assert one(df, fn.normalize_label("x")) == [("fruits and vegetables",), (None,), ("été noix!",)]
    assert one(df, fn.clean_text("x")) == [("fruits and   vegetables",), (None,), ("été noix",)]
    assert one(df, fn.token_sorted("x"))[0] == ("and fruits vegetables",)
    assert one(df, fn.tags(F.lit("a, b ,,c"))) == [(["a", "b", "c"],)] * 3


def test_grades_round_half_even_and_null_stays_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (2.5,), (3.5,), (9.0,), (-4.0,)], "x double")
    assert [r[0] for r in one(df, fn.number_to_grade("x"))] == [None, "a", "b", "d", "e", "a"]
    scores = spark.createDataFrame([(None,), (0.0,), (0.5,), (3.0,), (10.0,), (18.0,), (18.5,)], "x double")
    assert [r[0] for r in one(scores, fn.score_to_grade("x"))] == [None, "a", "b", "b", "c", "d", "e"]
    letters = spark.createDataFrame([("A",), ("e",), ("x",), (None,)], "x string")
    assert [r[0] for r in one(letters, fn.grade_to_number("x"))] == [1, 5, None, None]
    assert [r[0] for r in one(df, fn.round_half_even("x"))] == [None, 0, 2, 4, 9, -4]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (5.0,), (99.0,)], "x double")
    assert [r[0] for r in one(df, fn.clip("x", 0.0, 90.0))] == [None, 0.0, 5.0, 90.0]


def test_numbers_dates_and_tiny_negatives(spark):
    df = spark.createDataFrame([("1.5", "86399", "2020-01-02T03:04:05Z"), ("x", "86400", "no"), ("nan", None, None)], "n string, t string, d string")
    assert [r[0] for r in one(df, fn.to_number("n"))] == [1.5, None, None]
    assert [str(r[0]) for r in one(df, fn.unix_to_date("t"))] == ["1970-01-01", "1970-01-02", "None"]
    assert [str(r[0]) for r in one(df, fn.iso_to_timestamp("d"))] == ["2020-01-02 03:04:05", "None", "None"]
    tiny = fn.zero_tiny_negatives(spark.createDataFrame([(-5e-6, -5e-6), (-1.0, 2.0)], "fat_100g double, other double"))
    assert [tuple(r) for r in tiny.collect()] == [(0.0, -5e-6), (-1.0, 2.0)]


def test_tuple_text(spark):
    df = spark.createDataFrame([("('a', 1.0, nan)",), ("(None, nan, 2.5)",), ("('x nan y', 1.0, 3.0)",)], "x string")
    got = one(df, fn.tuple_text_to_struct("x", {"g": "string", "a": "double", "b": "double"}))
    assert got == [(Row(g="a", a=1.0, b=None),), (Row(g=None, a=None, b=2.5),), (Row(g="x nan y", a=1.0, b=3.0),)]


def test_change_label_and_bad_nulls(spark):
    df = spark.createDataFrame([(12.25, False), (100.0, True), (None, False)], "p double, new boolean")
    assert [r[0] for r in one(df, fn.change_label("p", F.col("new")))] == ["12.2%", "New", None]
    words = spark.createDataFrame([("",), ("None",), ("null",), ("ok",), (None,)], "x string")
    assert [r[0] for r in one(words, fn.is_bad_null("x"))] == [True, True, True, False, False]


def test_ratio_matches_known_scores(spark):
    pairs = [("1.0 0.0", "0.0 "), ("1.0 1.0", "1.0 "), ("a", ""), ("same", "same")]
    assert [text_ratio(a, b) for a, b in pairs] == [55, 73, 0, 100]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert [r[0] for r in one(df, ratio(F.col("a"), F.col("b")))] == [55, 73, 0, 100]


def test_pair_bound_never_loses_a_match():
    words = ["red ring", "red rings", "RED RING", "cold bolt", "old bolt", "größe", "grosse", "", "aaaa", "aaab", "x" * 300]
    profile = char_profile(words)
    for cutoff in (50, 70, 85, 100):
        mask = possible_pairs(profile, profile, cutoff)
        for i, a in enumerate(words):
            for j, b in enumerate(words):
                if a and b and text_ratio(a, b) >= cutoff:
                    assert mask[i, j]
