"""Join and running-total helpers that stay safe under skew and check what they broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gapweave.functions.scalars import quoted
from gapweave.session import cut, partitions

# A side is broadcast only when it is seen to have at most this many rows and bytes.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
# Candidates and counters of the hot-key sketch.
_HOT_KEYS = 1_000
_TRACKED = 10_000


def _width(field: T.StructField) -> Column:
    c = F.col(quoted(field.name))
    return F.octet_length(c if isinstance(field.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(c)))


def settle(df: DataFrame, rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """(frame, is_small): a local relation if the frame has at most ``rows`` rows and ``BROADCAST_BYTES`` bytes.

    Columns of varying width are measured before anything comes to the driver. A larger frame comes back with what was computed so far kept on the executors' disks, so that the
    size check never costs a second pass over the source."""
    known = df.storageLevel.useDisk or df.storageLevel.useMemory
    kept = df if known else df.persist(StorageLevel.DISK_ONLY)
    wide = [f for f in df.schema if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    if wide:
        width = sum((F.coalesce(_width(f), F.lit(0)) for f in wide), F.lit(8 * len(df.columns)))
        size = kept.agg(F.count("*").alias("n"), F.sum(width).alias("bytes")).first()
        if size["n"] > rows or (size["bytes"] or 0) > BROADCAST_BYTES:
            return kept, False
    table = kept.limit(rows + 1).toArrow()
    if table.num_rows > rows:
        return kept, False
    if not known:
        kept.unpersist()
    return df.sparkSession.createDataFrame(table, schema=df.schema), True


def _hot_keys(left: DataFrame, on: Sequence[str], tasks: int) -> list[int]:
    """Hashes of the keys that hold more than one task's share of the rows, from one mergeable sketch.
    There can be at most ``tasks`` of them."""
    key = F.xxhash64(*[F.col(quoted(c)) for c in on])
    row = left.agg(F.count("*").alias("n"), F.call_function("approx_top_k", key, F.lit(_HOT_KEYS), F.lit(_TRACKED)).alias("top")).first()
    return [t["item"] for t in row["top"] or [] if t["count"] * tasks > row["n"]]


def lookup_join(
    left: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Equi-join with a table of unique keys.

    A lookup of checked size is broadcast. For a larger one the rows of hot keys, and rows with a null
    key, are spread over all tasks by a salt, and only the lookup rows of hot keys are repeated per salt.
    The salt hashes the row with its input partition, so that equal rows part ways and a repeated task
    gives the same salts."""
    on = list(on)
    table, small = settle(lookup, rows)
    if small:
        return left.join(F.broadcast(table), on, how)
    tasks = partitions(left.sparkSession)
    key = F.xxhash64(*[F.col(quoted(c)) for c in on])
    hot = key.isin(_hot_keys(left, on, tasks))
    null_key = F.lit(False)
    for c in on:
        null_key = null_key | F.col(quoted(c)).isNull()
    spread = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in left.columns], F.spark_partition_id()), F.lit(tasks)).cast("int")
    salted = left.withColumn("__salt", F.when(null_key | hot, spread).otherwise(0))
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(table.withColumn("__salt", F.explode(salts)), on + ["__salt"], how).drop("__salt")


def map_values(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Value lookup: ``column`` through the (key, value) table; keys without an entry give null."""
    out = out or column
    table = mapping.select(F.col(quoted(key)).alias("__k"), F.col(quoted(value)).alias("__v"))
    joined = lookup_join(df.withColumn("__k", F.col(quoted(column))), table, ["__k"])
    names = [c for c in df.columns if c != out]
    position = df.columns.index(out) if out in df.columns else len(names)
    select = [F.col(quoted(c)) for c in names]
    select.insert(position, F.col("__v").alias(out))
    return joined.select(*select)


def write_back(df: DataFrame, updates: DataFrame, key: Sequence[str], columns: Sequence[str], overwrite: bool = False) -> DataFrame:
    """Bring updated cells back by key; observed cells win unless ``overwrite``. Of several updates for a key, each column
    takes its least known value, so no row is multiplied; null keys match nothing and are not shuffled to one task."""
    key = list(key)
    known = [F.col(quoted(k)).isNotNull() for k in key]
    renamed = updates.where(reduce(and_, known)).groupBy(*[F.col(quoted(k)).alias(k) for k in key]).agg(*[F.min(quoted(c)).alias(f"__new_{c}") for c in columns])
    # A null key gets a key of its own on this side only: rows spread by their content.
    spread = df.withColumn("__spread", F.when(reduce(and_, known), F.lit(0)).otherwise(F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in df.columns]), F.lit(4096)).cast("int") + 1))
    joined = spread.join(renamed.withColumn("__spread", F.lit(0)), [*key, "__spread"], "left")
    out = []
    for c in df.columns:
        if c in columns:
            old, new = F.col(quoted(c)), F.col(quoted(f"__new_{c}"))
            out.append((F.coalesce(new, old) if overwrite else F.coalesce(old, new)).alias(c))
        else:
            out.append(F.col(quoted(c)))
    return joined.select(*out)


def outer_counts(before: DataFrame, after: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Null-safe full outer join of two group tables; missing counts become 0."""
    a = before.select(*[F.col(quoted(k)).alias(f"__a{i}") for i, k in enumerate(keys)], F.col(values[0]))
    b = after.select(*[F.col(quoted(k)).alias(f"__b{i}") for i, k in enumerate(keys)], F.col(values[1]))
    condition = F.lit(True)
    for i in range(len(keys)):
        condition = condition & F.col(f"__a{i}").eqNullSafe(F.col(f"__b{i}"))
    return a.join(b, condition, "full_outer").select(
        *[F.coalesce(F.col(f"__a{i}"), F.col(f"__b{i}")).alias(k) for i, k in enumerate(keys)],
        *[F.coalesce(F.col(v), F.lit(0).cast("long")).alias(v) for v in values],
    )


def keep_members(df: DataFrame, column: str, members: DataFrame, member_column: str, negate: bool = False) -> DataFrame:
    """Rows whose value is (or is not) among the values of another frame."""
    values = members.select(F.col(quoted(member_column)).alias(column)).where(F.col(quoted(column)).isNotNull()).distinct()
    return lookup_join(df, values, [column], "left_anti" if negate else "left_semi")


def running_total(
    df: DataFrame, order: Sequence[Column], value: str, out: str, rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Inclusive running sum of ``value`` in the given total order.

    Small tables use one window. Larger ones are range-partitioned by the order, summed inside each
    range, and shifted by the sum of the ranges before it, so no task ever sees the whole table.
    """
    table, small = settle(df, rows)
    if small:
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return table.withColumn(out, F.sum(value).over(w))
    ranged = cut(
        table.repartitionByRange(partitions(df.sparkSession), *order).withColumn("__part", F.spark_partition_id())
    )
    sums = ranged.groupBy("__part").agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__shift"))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("__run", F.sum(value).over(inside))
        .join(F.broadcast(shifts), "__part")
        .withColumn(out, F.col("__run") + F.col("__shift"))
        .drop("__part", "__run", "__shift")
    )
