"""Group-mean fills, duplicate flags, diffs and small ordered reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gapweave.functions.scalars import quoted
from gapweave.operators.joins import lookup_join


def fill_by_group_mean(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Null cells take the mean of their group. Means are aggregated first, so a hot group is combined
    before the shuffle instead of being collected into one window partition."""
    g = F.col(quoted(group)).alias("__g")
    means = df.groupBy(g).agg(*[F.avg(quoted(c)).alias(f"__m{i}") for i, c in enumerate(columns)])
    joined = lookup_join(df.withColumn("__g", F.col(quoted(group))), means.where(F.col("__g").isNotNull()), ["__g"])
    fills = {c: F.coalesce(F.col(quoted(c)), F.col(f"__m{i}")) for i, c in enumerate(columns)}
    return joined.select(*[fills[c].alias(c) if c in fills else F.col(quoted(c)) for c in df.columns])


def flag_duplicates(df: DataFrame, column: str, key: str) -> DataFrame:
    """``is_duplicate`` for all but the lowest-key row of each non-null value."""
    v = F.col(quoted(column)).alias("__v")
    first = df.where(F.col(quoted(column)).isNotNull()).groupBy(v).agg(F.min(quoted(key)).alias("__first"))
    joined = lookup_join(df.withColumn("__v", F.col(quoted(column))), first, ["__v"])
    return joined.withColumn(
        "is_duplicate", F.coalesce(F.col(quoted(key)) != F.col("__first"), F.lit(False))
    ).drop("__v", "__first")


def frame_digest(df: DataFrame) -> tuple[int, int]:
    """Order-free digest: row count and the sum of row hashes."""
    hashed = F.xxhash64(*[F.col(quoted(c)) for c in df.columns]).cast("decimal(20,0)")
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(hashed), F.lit(0)).cast("string").alias("h")).first()
    return row["n"], int(row["h"])


def version_diff(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Distinct rows tagged ``Added`` or ``Removed``. Without an old version every row is added."""
    if old is None:
        return new.distinct().withColumn("change", F.lit("Added"))
    # One shuffle: rows of both versions meet on their content and remember which side they came from.
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    sides = both.groupBy(*[F.col(quoted(c)) for c in new.columns]).agg(F.min("__new").alias("__a"), F.max("__new").alias("__b"))
    return (
        sides.where(F.col("__a") == F.col("__b"))
        .withColumn("change", F.when(F.col("__a") == 1, "Added").otherwise("Removed"))
        .drop("__a", "__b")
    )


def top_by_magnitude(df: DataFrame, value: str, n: int, floor: float | None = None) -> DataFrame:
    """The n rows with the greatest absolute value, above a floor if given."""
    size = F.abs(F.col(quoted(value)))
    rows = df.where(size > floor) if floor is not None else df
    return rows.orderBy(size.desc(), *[F.col(quoted(c)) for c in df.columns if c != value]).limit(n)


def union_tagged(frames: dict[str, DataFrame], tag: str = "frame") -> DataFrame:
    out = None
    for name, df in frames.items():
        part = df.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
