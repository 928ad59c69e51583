"""Profiles that grow by version: small mergeable states per column are stored, and earlier rows are never read again.

Counts are exact. Distinct values come from a HyperLogLog sketch (2^14 registers, a standard error below 1 %), quantiles of number
columns from a KLL sketch (k = 800, a rank error below 1 %), the commonest value from a frequent-items sketch of 4,096 entries,
exact while a column has fewer than three quarters as many distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gapweave.functions.scalars import quoted
from gapweave.sources import tables

REGISTERS, RANKS, ITEMS = 14, 800, 4096
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def column_states(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its counts and sketches; one scan, and one sketch per task and column in the shuffle.

    NaN is no number here: it counts as a value, and is left out of the quantiles. An empty frame gives no rows."""
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)

    def cell(c: str):
        value = F.col(quoted(c))
        number = F.nanvl(value.cast("double"), F.lit(None).cast("double")) if kinds[c] in _NUMBERS or kinds[c].startswith("decimal") else F.lit(None).cast("double")
        return F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), value.cast("string").alias("value"), number.alias("number"))

    cells = df.select(F.explode(F.array(*[cell(c) for c in columns])).alias("x")).select("x.*")
    return cells.groupBy("column", "dtype").agg(
        F.count("*").alias("total"),
        F.count("value").alias("non_null"),
        F.min("number").alias("low"),
        F.max("number").alias("high"),
        F.hll_sketch_agg("value", F.lit(REGISTERS)).alias("distinct"),
        F.kll_sketch_agg_double("number", F.lit(RANKS)).alias("ranks"),
        F.expr(f"approx_top_k_accumulate(value, {ITEMS})").alias("top"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """The states of all rows that went into the given states; a column whose type changed keeps one row per type."""
    return states.groupBy("column", "dtype").agg(
        F.sum("total").alias("total"),
        F.sum("non_null").alias("non_null"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("ranks", F.lit(RANKS)).alias("ranks"),
        F.expr(f"approx_top_k_combine(top, {ITEMS})").alias("top"),
    )


def profile_of_states(states: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, dtype, counts, fill, distinct, range, quantiles, commonest value) of merged states; ties go to the lesser value."""
    numbers = F.col("low").isNotNull()
    common = F.filter(F.expr("approx_top_k_estimate(top, 64)"), lambda x: x["item"].isNotNull())
    best = F.array_min(F.transform(common, lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("value"))))
    quantiles = F.array(*[F.when(numbers, F.kll_sketch_get_quantile_double("ranks", F.lit(p))) for p in probabilities])
    return states.select(
        "column", "dtype", "non_null", (F.col("total") - F.col("non_null")).alias("nulls"),
        (F.col("non_null") * 100.0 / F.col("total")).alias("fill_pct"), F.hll_sketch_estimate("distinct").alias("distinct"), "low", "high",
        F.when(numbers, quantiles).alias("quantiles"), best["value"].alias("most_common"), (-best["n"]).alias("most_common_count"),
    )


def add_version(df: DataFrame, root: str, version: str, columns: Sequence[str] | None = None) -> None:
    """Stores the states of the new rows; a version that is there already raises."""
    tables.save_version(column_states(df, columns), root, version)


def stored_profile(spark: SparkSession, root: str) -> DataFrame:
    """Profile of all stored versions together; reads a row per version and column, never the data."""
    return profile_of_states(merge_states(spark.read.parquet(root)))
