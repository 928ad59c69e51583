"""Projections, filters, splits and repeatable samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gapweave.functions.scalars import quoted
from gapweave.operators.quantiles import quantile_map


class ColumnSelector(Transformer):
    """Keeps the named columns; usable as a stage of ``pyspark.ml.Pipeline``."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*[F.col(quoted(c)) for c in self.columns])


def columns_of_kind(df: DataFrame, kind: str, exclude: Sequence[str] = ()) -> list[str]:
    """Names of ``number`` or ``text`` columns without the excluded ones."""
    wanted = T.NumericType if kind == "number" else T.StringType
    return [f.name for f in df.schema if isinstance(f.dataType, wanted) and f.name not in exclude]


def fill_percentages(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float]:
    """Share of non-null cells per column in percent: one aggregation for all columns."""
    columns = list(columns or df.columns)
    row = df.agg(F.count("*").alias("__n"), *[F.count(quoted(c)).alias(f"__{i}") for i, c in enumerate(columns)]).first()
    n = row["__n"]
    return {c: (100.0 * row[f"__{i}"] / n if n else 0.0) for i, c in enumerate(columns)}


def keep_filled_columns(df: DataFrame, low: float = 40.0, high: float = 100.0) -> DataFrame:
    fills = fill_percentages(df)
    return df.select(*[F.col(quoted(c)) for c in df.columns if low <= fills[c] <= high])


def columns_by_missing(df: DataFrame, limit: float, above: bool = False) -> list[str]:
    """Columns whose missing share lies above, or not above, the limit (0..1)."""
    fills = fill_percentages(df)
    return [c for c in df.columns if ((1 - fills[c] / 100 > limit) == above)]


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    condition = F.lit(True)
    for c in subset:
        condition = condition & F.col(quoted(c)).isNotNull()
    return df.where(condition)


def keep_valid(df: DataFrame, column: str, valid: Sequence) -> DataFrame:
    return df.where(F.col(quoted(column)).isin(*valid))


def reshape_columns(df: DataFrame, rename: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed(dict(rename or {})).drop(*drop)


def present_count(columns: Sequence[str]) -> Column:
    """Number of non-null features of a row."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(quoted(c)).isNotNull().cast("int")
    return total


def completeness_threshold(df: DataFrame, features: Sequence[str], percentile: float) -> float:
    """Percentile of the per-row feature count. Counts are first grouped, so only as many rows as
    there are features are ordered."""
    counts = df.groupBy(present_count(features).alias("k")).count()
    return threshold_of({r["k"]: r["count"] for r in counts.collect()}, percentile)


def threshold_of(counts: Mapping[int, int], percentile: float) -> float:
    """Percentile of numbers that come so many times each."""
    rows = sorted(counts.items())
    n = sum(c for _, c in rows)
    if not n:
        return 0.0
    position = percentile / 100.0 * (n - 1)

    def at(index: int) -> int:
        seen = 0
        for k, c in rows:
            seen += c
            if index < seen:
                return k
        return rows[-1][0]

    lower = int(position)
    upper = min(lower + 1, n - 1)
    return at(lower) + (at(upper) - at(lower)) * (position - lower)


def most_complete_rows(df: DataFrame, features: Sequence[str], percentile: float) -> DataFrame:
    return df.where(present_count(features) >= completeness_threshold(df, features, percentile))


def hash_order(key: Sequence[str], seed: int = 42) -> Column:
    return F.xxhash64(*[F.col(quoted(k)) for k in key], F.lit(seed))


def exact_sample(df: DataFrame, n: int, key: Sequence[str], order: Column | None = None, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones for any partitioning."""
    order = order if order is not None else hash_order(key, seed)
    return df.orderBy(order, *[F.col(quoted(k)) for k in key]).limit(n)


def split(df: DataFrame, key: Sequence[str], train_percent: int = 80, bucket: Column | None = None, seed: int = 42):
    """(train, test) by a stable bucket 0..99 of the key."""
    bucket = bucket if bucket is not None else F.pmod(hash_order(key, seed), F.lit(100))
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def outlier_samples(
    df: DataFrame, columns: Sequence[str], key: str, multiplier: float = 1.5, n: int = 100, order: Column | None = None, seed: int = 42
) -> DataFrame:
    """At most ``n`` outlier values per column (key, column, value), chosen by hash order."""
    q = quantile_map(df, columns, [0.25, 0.75])
    cells = []
    for c in columns:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None:
            continue
        v = F.col(quoted(c)).cast("double")
        outside = (v < q1 - multiplier * (q3 - q1)) | (v > q3 + multiplier * (q3 - q1))
        cells.append(F.when(outside, F.struct(F.lit(c).alias("column"), v.alias("value"))))
    order = order if order is not None else hash_order([key], seed)
    long = df.select(F.col(quoted(key)), order.alias("__o"), F.explode(F.array_compact(F.array(*cells))).alias("cell"))
    w = Window.partitionBy("column").orderBy("__o", F.col(quoted(key)))
    return (
        long.select(quoted(key), "__o", "cell.column", "cell.value")
        .withColumn("__r", F.row_number().over(w))
        .where(F.col("__r") <= n)
        .select(quoted(key), "column", "value")
    )
