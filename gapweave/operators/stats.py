"""Aggregations: frequencies, modes, moments, outliers, histograms, fits and comparisons."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gapweave.functions.scalars import change_label, clip, quoted
from gapweave.operators.joins import lookup_join, outer_counts, running_total, settle
from gapweave.operators.quantiles import long_values, quantile_map, quantiles


def combination_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Frequency of each value combination, nulls included."""
    return df.groupBy(*[F.col(quoted(f)) for f in fields]).agg(F.count("*").alias("frequency"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent non-null values; ties by value."""
    c = F.col(quoted(column))
    return (
        df.where(c.isNotNull()).groupBy(c.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)
    )


def mode_by(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null value per group (by..., mode, n); ties by the lowest value."""
    by = list(by)
    counted = df.where(F.col(quoted(column)).isNotNull()).groupBy(*[F.col(quoted(b)).alias(b) for b in by], F.col(quoted(column)).alias("__v")).agg(F.count("*").alias("__n"))
    best = counted.groupBy(*by).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col("__v").alias("v"))).alias("b"))
    return best.select(*by, F.col("b.v").alias("mode"), (-F.col("b.n")).alias("n")).where(F.col("mode").isNotNull())


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Mode per text column on the driver, from one pass over the frame."""
    from gapweave.operators.profile import value_counts

    if not columns:
        return {}
    best = (
        value_counts(df, columns)
        .where(F.col("value").isNotNull())
        .groupBy("column")
        .agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("b"))
    )
    return {r["column"]: r["b"]["value"] for r in best.collect()}


def describe(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, n, mean, std, skewness, lowest, highest, q...) with exact quantiles and the bias-corrected skewness."""
    moments = (
        long_values(df, columns)
        .groupBy("column")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.skewness("value").alias("g"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    )
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("g") * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2))
    q = quantiles(df, columns, probs).groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(f"q{round(p * 100)}") for p in probs]
    )
    return moments.withColumn("skewness", skew).drop("g").join(q, "column")


def iqr_bounds(df: DataFrame, columns: Sequence[str], multiplier: float = 1.5) -> dict[str, tuple[float, float]]:
    q = quantile_map(df, columns, [0.25, 0.75])
    out = {}
    for c in columns:
        q1, q3 = q.get((c, 0.25)), q.get((c, 0.75))
        if q1 is not None:
            out[c] = (q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1))
    return out


def _bounds_table(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(c, float(lo), float(hi)) for c, (lo, hi) in bounds.items()], "column string, lower double, upper double"
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str], multiplier: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """(summary, capped frame). Pass 1 finds the quartiles, pass 2 is one aggregation for all columns."""
    bounds = iqr_bounds(df, columns, multiplier)
    v, outside = F.col("value"), (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    inside = F.when(~outside, v)
    n = F.col("n").cast("double")
    summary = (
        long_values(df, list(bounds))
        .join(F.broadcast(_bounds_table(df, bounds)), "column")
        .groupBy("column", "lower", "upper")
        .agg(
            F.count_if(outside).alias("outliers"),
            F.count("*").alias("n"),
            F.skewness(v).alias("g"),
            F.avg(v).alias("mean"),
            F.avg(inside).alias("clean_mean"),
            F.stddev_samp(v).alias("std"),
            F.stddev_samp(inside).alias("clean_std"),
            (F.min(v) > 0).alias("log_scale_ok"),
        )
        .select(
            "column",
            "outliers",
            (F.col("outliers") * 100.0 / F.col("n")).alias("outlier_pct"),
            F.when(n > 2, F.col("g") * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)).alias("skewness"),
            "mean",
            "clean_mean",
            "std",
            "clean_std",
            "lower",
            "upper",
            "log_scale_ok",
        )
        .orderBy(F.desc("outliers"), "column")
    )
    capped = df.select(*[clip(c, *bounds[c]).alias(c) if c in bounds else F.col(quoted(c)) for c in df.columns])
    return summary, capped


def limit_outliers(df: DataFrame, limits: Mapping[str, float], lower: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(summary, frame with out-of-range cells set to null) for fixed limits per column."""
    bounds = {c: (lower, hi) for c, hi in limits.items() if c in df.columns}
    v = F.col("value")
    below, above = v < F.col("lower"), v > F.col("upper")
    summary = (
        long_values(df, list(bounds))
        .join(F.broadcast(_bounds_table(df, bounds)), "column")
        .groupBy("column", "upper")
        .agg(
            F.count_if(below | above).alias("outliers"),
            F.count("*").alias("n"),
            F.count_if(below).alias("below"),
            F.count_if(above).alias("above"),
            F.min(F.when(below, v)).alias("extreme_min"),
            F.max(F.when(above, v)).alias("extreme_max"),
            F.avg(v).alias("mean"),
            F.avg(F.when(~(below | above), v)).alias("clean_mean"),
        )
        .select(
            "column",
            "outliers",
            (F.col("outliers") * 100.0 / F.col("n")).alias("outlier_pct"),
            "below",
            "above",
            "upper",
            "extreme_min",
            "extreme_max",
            "mean",
            "clean_mean",
            F.when(F.col("clean_mean") != 0, (F.col("mean") - F.col("clean_mean")) * 100.0 / F.nullif("clean_mean", F.lit(0.0)))
            .when(F.col("clean_mean") == 0, 0.0)
            .alias("mean_change_pct"),
        )
        .orderBy(F.desc("outliers"), "column")
    )
    cleaned = df.select(
        *[
            F.when(~((F.col(quoted(c)) < bounds[c][0]) | (F.col(quoted(c)) > bounds[c][1])), F.col(quoted(c))).alias(c)
            if c in bounds
            else F.col(quoted(c))
            for c in df.columns
        ]
    )
    return summary, cleaned


def sturges_bins(n: int) -> int:
    """Bin count from the row count, kept between 10 and 50."""
    return min(50, max(10, math.ceil(math.log2(n)) + 1)) if n > 0 else 10


def bin_of(value: Column, low: Column | float, high: Column | float, bins: int | Column) -> Column:
    """Equal-width bin 0..bins-1; the last bin is closed on the right."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    bins = bins if isinstance(bins, Column) else F.lit(bins)
    raw = F.floor((value - low) / F.nullif(high - low, F.lit(0.0)) * bins)
    return F.coalesce(F.when(raw >= bins, bins - 1).otherwise(raw), F.lit(0)).cast("int")


def histogram(df: DataFrame, column: str, bins: int | None = None, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, left, right, n, density); edges and bin count default to the data and its size."""
    c = F.col(quoted(column)).cast("double")
    stats = df.agg(F.min(c).alias("a"), F.max(c).alias("b"), F.count(c).alias("n")).first()
    low = stats["a"] if low is None else low
    high = stats["b"] if high is None else high
    bins = sturges_bins(stats["n"]) if bins is None else bins
    inside = df.where((c >= low) & (c <= high)) if low is not None else df.where(F.lit(False))
    width = ((high - low) / bins) if low is not None else 0.0
    counted = inside.groupBy(bin_of(c, low or 0.0, high or 0.0, bins).alias("bin")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # at most `bins` rows
    return counted.select(
        "bin",
        (F.lit(float(low or 0.0)) + F.col("bin") * F.lit(width)).alias("left_edge"),
        (F.lit(float(low or 0.0)) + (F.col("bin") + 1) * F.lit(width)).alias("right_edge"),
        "n",
        (F.col("n") / F.nullif(total * F.lit(width), F.lit(0.0))).alias("density"),
    )


def box_statistics(df: DataFrame, group: str, columns: Sequence[str], min_rows: int = 5) -> DataFrame:
    """Quartiles, mean and range per group and column, for groups of at least ``min_rows`` rows."""
    known = df.where(F.col(quoted(group)).isNotNull()).withColumn("__g", F.col(quoted(group)))
    sizes = known.groupBy("__g").agg(F.count("*").alias("__size")).where(F.col("__size") >= min_rows)
    moments = (
        long_values(known, columns, ["__g"])
        .groupBy("__g", "column")
        .agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    )
    q = quantiles(known, columns, [0.25, 0.5, 0.75], ["__g"]).groupBy("__g", "column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(a) for p, a in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    )
    return (
        moments.join(q, ["__g", "column"])
        .join(sizes.select("__g"), "__g", "left_semi")
        .select(F.col("__g").alias(group), "column", "n", "q1", "median", "q3", "mean", "lowest", "highest")
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation (a, b, corr), both orders and the diagonal; one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(F.col(quoted(a)).cast("double"), F.col(quoted(b)).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    items = []
    for i, (a, b) in enumerate(pairs):
        items.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr")))
        if a != b:
            items.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"c{i}").alias("corr")))
    return wide.select(F.explode(F.array(*items)).alias("x")).select("x.*")


def category_statistics(df: DataFrame, category: str, columns: Sequence[str], top: int = 6) -> DataFrame:
    """Mean, median and count of each column in the most frequent categories."""
    best = top_values(df, category, top).select(F.col("value").alias("category"))
    rows = df.withColumn("category", F.col(quoted(category))).join(F.broadcast(best), "category", "left_semi")
    moments = long_values(rows, columns, ["category"]).groupBy("category", "column").agg(F.avg("value").alias("mean"), F.count("*").alias("n"))
    median = quantiles(rows, columns, [0.5], ["category"]).select("category", "column", F.col("value").alias("median"))
    return moments.join(median, ["category", "column"]).select("category", "column", "mean", "median", "n")


def cross_counts(df: DataFrame, a: str, b: str, ignore: Sequence = ()) -> DataFrame:
    """Long cross-tabulation of two columns without nulls and ignored labels; counts are positive."""
    ca, cb = F.col(quoted(a)), F.col(quoted(b))
    rows = df.where(ca.isNotNull() & cb.isNotNull())
    if ignore:
        rows = rows.where(~ca.isin(*ignore) & ~cb.isin(*ignore))
    return rows.groupBy(ca.alias(a), cb.alias(b)).agg(F.count("*").alias("n"))


def cross_table(df: DataFrame, a: str, b: str, values: Sequence) -> DataFrame:
    """Wide cross-tabulation with one column per listed value of ``b``, zeros where nothing occurs."""
    wide = df.groupBy(F.col(quoted(a)).alias(a)).pivot(b, list(values)).agg(F.count(F.lit(1)))
    return wide.select(F.col(a), *[F.coalesce(F.col(quoted(str(v))), F.lit(0).cast("long")).alias(str(v)) for v in values])


def frequent_combinations(df: DataFrame, fields: Sequence[str], threshold: float) -> DataFrame:
    """Combinations in descending frequency while their running share stays within the threshold.

    The comparison is made on whole counts, so a share of exactly the threshold is kept."""
    counted, _ = settle(combination_counts(df, fields))
    order = [F.desc("frequency"), *[F.col(quoted(f)).asc_nulls_first() for f in fields]]
    ranked = running_total(counted, order, "frequency", "running")
    total = counted.agg(F.sum("frequency")).first()[0] or 0
    return ranked.where(F.col("running") <= F.lit(threshold) * F.lit(total)).withColumn(
        "cumulative_pct", F.col("running") * 100.0 / F.lit(max(total, 1))
    )


def weighted_line_fit(points: DataFrame, group: str, x: str, y: str, weight: str, min_points: int = 3) -> DataFrame:
    """Weighted least squares per group from mergeable sums centred on the group means.

    ``r2`` is unweighted, ``r2_weighted`` uses the weights."""
    g, cx, cy, w = F.col(quoted(group)).alias("__g"), F.col(quoted(x)).cast("double"), F.col(quoted(y)).cast("double"), F.col(quoted(weight)).cast("double")
    rows = points.select(g, cx.alias("x"), cy.alias("y"), w.alias("w")).where("x is not null and y is not null and w > 0")
    rows = rows.where(F.col("__g").isNotNull())
    means = rows.groupBy("__g").agg(
        (F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("mx"),
        (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("my"),
        F.count("*").alias("points"),
    )
    dx, dy = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    sums = (
        lookup_join(rows, means.where(F.col("points") >= min_points), ["__g"], "inner")
        .groupBy("__g", "mx", "my", "points")
        .agg(
            F.sum("w").alias("sw"),
            F.sum(F.col("w") * dx * dx).alias("wxx"),
            F.sum(F.col("w") * dx * dy).alias("wxy"),
            F.sum(F.col("w") * dy * dy).alias("wyy"),
            F.sum(dx).alias("ux"),
            F.sum(dy).alias("uy"),
            F.sum(dx * dx).alias("uxx"),
            F.sum(dx * dy).alias("uxy"),
            F.sum(dy * dy).alias("uyy"),
            F.min("x").alias("min_x"),
            F.max("x").alias("max_x"),
            F.min("y").alias("min_y"),
            F.max("y").alias("max_y"),
        )
    )
    # A group with a single x value has no slope; least squares then returns slope 0 at the mean.
    slope = F.when(F.col("wxx") > 0, F.col("wxy") / F.nullif("wxx", F.lit(0.0))).otherwise(F.lit(0.0))
    s = F.col("slope")
    residual_u = F.col("uyy") - 2 * s * F.col("uxy") + s * s * F.col("uxx")
    total_u = F.col("uyy") - F.col("uy") * F.col("uy") / F.col("points")
    residual_w = F.col("wyy") - 2 * s * F.col("wxy") + s * s * F.col("wxx")
    return sums.withColumn("slope", slope).select(
        F.col("__g").alias(group),
        "points",
        "slope",
        (F.col("my") - s * F.col("mx")).alias("intercept"),
        (1 - residual_u / F.nullif(total_u, F.lit(0.0))).alias("r2"),
        (1 - residual_w / F.nullif("wyy", F.lit(0.0))).alias("r2_weighted"),
        "min_x",
        "max_x",
        "min_y",
        "max_y",
    )


def score_line_fit(df: DataFrame, grade: str, x: str, y: str, valid: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Line per grade over the most frequent (grade, x, y) combinations."""
    rows = df.select(F.lower(F.col(quoted(grade))).alias("grade"), F.col(quoted(x)).alias("x"), F.col(quoted(y)).alias("y"))
    rows = rows.where(F.col("grade").isin(*valid) & F.col("x").isNotNull() & F.col("y").isNotNull())
    return weighted_line_fit(frequent_combinations(rows, ["grade", "x", "y"], threshold), "grade", "x", "y", "frequency")


def missing_shares(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column, missing_share, frame) of two versions of a frame."""

    def one(df: DataFrame, tag: str) -> DataFrame:
        wide = df.agg(F.count("*").alias("rows"), *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
        items = F.array(
            *[
                F.struct(F.lit(c).alias("column"), ((F.col("rows") - F.col(f"c{i}")) / F.nullif("rows", F.lit(0).cast("long"))).alias("missing_share"))
                for i, c in enumerate(df.columns)
            ]
        )
        return wide.select(F.explode(items).alias("x")).select("x.*", F.lit(tag).alias("frame"))

    return one(before, "before").unionByName(one(after, "after"))


def compare_statistics(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median and standard deviation before and after, with the change of the mean."""

    def one(df: DataFrame, tag: str) -> DataFrame:
        m = long_values(df, columns).groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
        q = quantiles(df, columns, [0.5]).select("column", F.col("value").alias("median"))
        return m.join(q, "column").select("column", *[F.col(c).alias(f"{tag}_{c}") for c in ("mean", "median", "std")])

    both = one(before, "before").join(one(after, "after"), "column")
    diff = F.col("after_mean") - F.col("before_mean")
    return both.select(
        "column",
        F.round("before_mean", 2).alias("before_mean"),
        F.round("after_mean", 2).alias("after_mean"),
        F.round(diff, 2).alias("mean_diff"),
        F.round(F.when(F.col("before_mean") != 0, diff * 100.0 / F.nullif("before_mean", F.lit(0.0))).otherwise(0.0), 1).alias("mean_change_pct"),
        F.round("before_median", 2).alias("before_median"),
        F.round("after_median", 2).alias("after_median"),
        F.round("before_std", 2).alias("before_std"),
        F.round("after_std", 2).alias("after_std"),
    )


def group_growth(before: DataFrame, after: DataFrame, keys: Sequence[str], cap: float = 1000.0) -> DataFrame:
    """Group sizes before and after with growth in percent (100 for new groups), capped, and a label."""

    def sizes(df: DataFrame, name: str) -> DataFrame:
        known = df
        for k in keys:
            known = known.where(F.col(quoted(k)).isNotNull())
        return known.groupBy(*[F.col(quoted(k)).alias(k) for k in keys]).agg(F.count("*").alias(name))

    both = outer_counts(sizes(before, "count_before"), sizes(after, "count_after"), keys, ["count_before", "count_after"])
    a, b = F.col("count_before"), F.col("count_after")
    is_new = (a == 0) & (b > 0)
    both = both.withColumn("difference", b - a).withColumn(
        "pct_change", F.when(a > 0, (b - a) * 100.0 / F.nullif(a, F.lit(0).cast("long"))).when(is_new, 100.0).otherwise(0.0)
    )
    return both.withColumn("pct_capped", clip("pct_change", 0.0, cap)).withColumn("label", change_label("pct_change", is_new))


def confidence_report(confidence: DataFrame) -> DataFrame:
    """Per column of a long confidence table: imputed cells, mean, shares of high and low confidence."""
    c = F.col("confidence")
    return (
        confidence.groupBy("column")
        .agg(
            F.count("*").alias("imputed"),
            F.avg(c).alias("mean_confidence"),
            (F.count_if(c >= 0.8) * 100.0 / F.count("*")).alias("high_pct"),
            (F.count_if(c < 0.5) * 100.0 / F.count("*")).alias("low_pct"),
        )
        .orderBy(F.desc("imputed"), "column")
    )


def distribution_comparison(
    before: DataFrame, after: DataFrame, text_columns: Sequence[str], number_columns: Sequence[str], bins: int = 30, top: int = 10
) -> DataFrame:
    """(frame, column, bucket, n): histograms on shared edges for numbers, most frequent values for text."""
    tagged = {"before": before, "after": after}
    columns = list(number_columns)
    long = None
    for tag, df in tagged.items():
        part = long_values(df, columns).withColumn("frame", F.lit(tag))
        long = part if long is None else long.unionByName(part)
    edges = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    numbers = (
        long.join(F.broadcast(edges), "column")  # one row per column
        .groupBy("frame", "column", bin_of(F.col("value"), F.col("lo"), F.col("hi"), bins).cast("string").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )
    out = numbers
    for tag, df in tagged.items():
        for c in text_columns:
            out = out.unionByName(
                top_values(df, c, top).select(F.lit(tag).alias("frame"), F.lit(c).alias("column"), F.col("value").cast("string").alias("bucket"), "n")
            )
    return out
