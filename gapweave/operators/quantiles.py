"""Exact quantiles (linear interpolation) by radix selection: no column is ever ordered or held in one task.

The bits of a double, with the sign put first, order like the number. They are read in digits of 16, 18, 18 and 12 bits. A pass counts the rows per
digit, for all columns, groups and probabilities together: tasks count their batches, one grouped sum adds them up, and the least and greatest
value of every digit come along. The digit that holds a wanted rank is found on its key's short list of counts. A rank is settled once its digit
holds a single value; the next pass looks at the rows of unsettled digits alone. Four passes read every bit; two are the rule. The
way is the same at every size, and what travels is counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gapweave.functions.scalars import quoted
from gapweave.operators.joins import settle

#: Bits of each digit.
_BITS = (16, 18, 18, 12)


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row (by..., column, value) per non-null numeric cell, in a single scan."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("double").alias("value")) for c in columns]
    )
    return (
        df.select(*[F.col(quoted(b)).alias(b) for b in by], F.explode(cells).alias("cell"))
        .select(*by, "cell.column", "cell.value")
        .where(F.col("value").isNotNull())
    )


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Whole numbers that order like the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.uint64)
    top = np.uint64(1 << 63)
    return np.where(bits & top, ~bits, bits | top)


def _counting(keys: list[str], level: int, cells: pd.DataFrame | None):
    """A task's counts per key, prefix and digit, from wide rows (groups, one column a number) or, with their open prefix beside,
    from long ones; ``cells`` are the open prefixes where they are few enough to travel."""
    used, bits = sum(_BITS[:level]), _BITS[level]
    groups = keys[:-1]
    wanted = {c: set(p) for c, p in cells.groupby("c")["prefix"]} if cells is not None else None

    def pieces(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        if "value" in pdf:
            key = ordered_bits(pdf["value"].to_numpy(dtype=float))
            same = pdf["prefix"].to_numpy() == (key >> np.uint64(64 - used)).astype(np.int64)
            yield pdf[same], key[same]
            return
        for c in range(pdf.shape[1] - len(groups)):
            if wanted is not None and c not in wanted:
                continue
            value = pdf[f"v{c}"].to_numpy(dtype=float)
            key = ordered_bits(value)
            prefix = (key >> np.uint64(64 - used)).astype(np.int64) if level else np.zeros(len(key), np.int64)
            known = ~np.isnan(value)
            if wanted is not None:
                known &= np.isin(prefix, list(wanted[c]))
            yield pd.DataFrame({**{g: pdf[g].to_numpy()[known] for g in groups}, "c": c, "value": value[known], "prefix": prefix[known]}), key[known]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for part, key in pieces(pdf):
                digit = (key >> np.uint64(64 - used - bits)) & np.uint64((1 << bits) - 1)
                part = part.assign(d=digit.astype(np.int32))
                if cells is not None and groups:
                    part = part.merge(cells, on=[*keys, "prefix"])
                if len(part):
                    yield part.groupby([*keys, "prefix", "d"], sort=False)["value"].agg(n="count", low="min", high="max").reset_index()

    return run


def _found(bins: Column, rank: Column) -> Column:
    """(digit, rank inside the digit, least, greatest) of the digit that holds a rank, from the ordered list of a key's counts."""
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("struct<d:int,rank:bigint,low:double,high:double>").alias("hit"))

    def step(state: Column, b: Column) -> Column:
        here = state["hit"].isNull() & (state["before"] + b["n"] > rank)
        hit = F.struct(b["d"].alias("d"), (rank - state["before"]).alias("rank"), b["low"].alias("low"), b["high"].alias("high"))
        return F.struct((state["before"] + b["n"]).alias("before"), F.when(here, hit).otherwise(state["hit"]).alias("hit"))

    return F.aggregate(bins, start, step, lambda state: state["hit"])


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Long table (by..., column, prob, value) of exact quantiles of the known values; a column without any gives nulls where it is not grouped.

    NaN counts as null. Rows with a null group are left out."""
    by, probs, columns = list(by), [float(p) for p in probs], list(columns)
    groups = [f"g{i}" for i in range(len(by))]
    keys = [*groups, "c"]
    for b in by:
        df = df.where(F.col(quoted(b)).isNotNull())
    named = [F.col(quoted(b)).alias(g) for b, g in zip(by, groups, strict=True)]
    wide = df.select(*named, *[F.col(quoted(c)).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in wide.schema[: len(by)]) + "c int, prefix long, d int, n long, low double, high double"
    # For the case that more prefixes are open than may travel with the tasks.
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"v{i}").alias("value")) for i in range(len(columns))])).alias("x")
    long = wide.select(*groups, cells).select(*groups, "x.c", "x.value").where(F.col("value").isNotNull() & ~F.isnan("value"))

    def counted(rows: DataFrame, level: int, known: pd.DataFrame | None = None) -> DataFrame:
        """Ordered counts of the digits of one level, one row per key and prefix."""
        parts = rows.mapInPandas(_counting(keys, level, known), schema)
        sums = parts.groupBy(*keys, "prefix", "d").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        return sums.groupBy(*keys, "prefix").agg(F.sort_array(F.collect_list(F.struct("d", "n", "low", "high"))).alias("bins"))

    def ranked(rows: DataFrame, level: int) -> DataFrame:
        """Ranks moved on into their digits, and the values these lie between."""
        hit = rows.withColumn("hit", _found(F.col("bins"), F.col("rank")))
        prefix = F.shiftleft("prefix", _BITS[level]).bitwiseOR(F.col("hit.d").cast("long"))
        return hit.select(*keys, "n", "place", "hit.rank", prefix.alias("prefix"), "hit.low", "hit.high")

    total = F.aggregate("bins", F.lit(0).cast("long"), lambda a, b: a + b["n"])
    # Each probability needs the values at the ranks below and above its position.
    place = lambda i, side: F.struct(F.lit(2 * i + side).alias("place"), (F.floor if side == 0 else F.ceil)(F.lit(probs[i]) * (F.col("n") - 1)).cast("long").alias("rank"))
    wanted = counted(wide, 0).withColumn("n", total).withColumn("want", F.explode(F.array(*[place(i, side) for i in range(len(probs)) for side in (0, 1)])))
    settled, small = settle(ranked(wanted.select(*keys, "prefix", "bins", "n", "want.place", "want.rank"), 0))
    done = []
    for level in range(1, len(_BITS) + 1):
        done.append(settled.where("low = high").select(*keys, "n", "place", F.col("low").alias("value")))
        open_ = settled.where("low <> high")
        known = open_.select(*keys, "prefix").toPandas().drop_duplicates() if small else None
        if level == len(_BITS) or (open_.isEmpty() if known is None else known.empty):
            break
        lists = counted(long.join(open_.select(*keys, "prefix").distinct(), keys), level) if known is None else counted(wide, level, known)
        joined = open_.select(*keys, "prefix", "n", "place", "rank").join(lists, [*keys, "prefix"])
        settled, small = settle(ranked(joined, level))
    union = done[0]
    for part in done[1:]:
        union = union.unionByName(part)
    sides = union.withColumn("i", F.floor(F.col("place") / 2).cast("int")).groupBy(*keys, "n", "i").agg(
        F.max(F.when(F.col("place") % 2 == 0, F.col("value"))).alias("a"), F.max(F.when(F.col("place") % 2 == 1, F.col("value"))).alias("b")
    )
    prob = F.get(F.array(*[F.lit(p) for p in probs]), F.col("i"))
    position = prob * (F.col("n") - 1)
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * (position - F.floor(position)))
    back = [F.col(g).alias(b) for b, g in zip(by, groups, strict=True)]
    name = F.get(F.array(*[F.lit(c) for c in columns]), F.col("c")).alias("column")
    out = sides.select(*back, name, prob.alias("prob"), value.alias("value"))
    if by:
        return out
    # Columns without a value, and no rows at all, still have their lines.
    lines = df.sparkSession.createDataFrame([(c, p) for c in columns for p in probs], "column string, prob double")
    return lines.join(out, ["column", "prob"], "left").select("column", "prob", "value")


def quantile_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float]:
    """Global quantiles on the driver: one number per column and probability."""
    return {(r["column"], r["prob"]): r["value"] for r in quantiles(df, columns, probs).collect()}


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    return {c: v for (c, _), v in quantile_map(df, columns, [0.5]).items()}
