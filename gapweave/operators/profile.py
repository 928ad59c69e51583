"""Column profiles: fill, distinct values, most common value, observed types, categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gapweave.functions.scalars import is_bad_null, quoted, same_prefix


def _schema_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [(i, c, kinds[c]) for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as text) for every cell, nulls included; one scan for all columns."""
    items = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.explode(items).alias("cell")).select("cell.column", "cell.value")


def _share(part: Column, whole: Column, digits: int | None = None) -> Column:
    value = F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))
    return F.round(value, digits) if digits is not None else value


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) with nulls as a value; hot values are combined before the shuffle."""
    return _cells(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def column_profile(df: DataFrame, name: str, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Profile per column: counts, fill and unique rates, most common value.

    ``exact=False`` replaces the value shuffle by sketches in a single aggregation and leaves the
    most common value out.
    """
    columns = list(columns or df.columns)
    if exact:
        known = F.col("value").isNotNull()
        stats = (
            value_counts(df, columns)
            .groupBy("column")
            .agg(
                F.sum("n").alias("total"),
                F.sum(F.when(known, F.col("n")).otherwise(0)).alias("non_null"),
                F.count_if(known).alias("distinct"),
                F.min(F.when(known, F.struct((-F.col("n")).alias("n"), "value"))).alias("top"),
            )
        )
        top_value, top_count = F.col("top.value"), F.coalesce(-F.col("top.n"), F.lit(0).cast("long"))
    else:
        wide = df.agg(
            F.count("*").alias("total"),
            *[F.struct(F.count(quoted(c)).alias("n"), F.approx_count_distinct(quoted(c)).alias("d")).alias(f"c{i}") for i, c in enumerate(columns)],
        )
        items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}.n").alias("non_null"), F.col(f"c{i}.d").alias("distinct")) for i, c in enumerate(columns)])
        stats = wide.select("total", F.explode(items).alias("x")).select("total", "x.*")
        top_value, top_count = F.lit(None).cast("string"), F.lit(None).cast("long")
    joined = F.broadcast(_schema_table(df, columns)).join(stats, "column", "left")
    zero = F.lit(0).cast("long")
    total, non_null, distinct = (F.coalesce(F.col(c), zero) for c in ("total", "non_null", "distinct"))
    return joined.select(
        F.lit(name).alias("frame"),
        "column",
        "dtype",
        non_null.alias("non_null"),
        (total - non_null).alias("nulls"),
        _share(non_null, total, 2).alias("fill_pct"),
        distinct.alias("distinct"),
        _share(distinct, non_null, 2).alias("unique_pct"),
        top_value.alias("most_common"),
        top_count.alias("most_common_count"),
    )


# Type names by observed kind of a text cell.
_KINDS = ("int", "float", "bool", "str")


def _kind_of(value: Column, dtype: Column) -> Column:
    """Kind of a cell: from the declared type, or for text from how it parses."""
    text_kind = (
        F.when(value.rlike(r"^[+-]?\d+$"), "int")
        .when(value.try_cast("double").isNotNull(), "float")
        .when(F.lower(value).isin("true", "false"), "bool")
        .otherwise("str")
    )
    return (
        F.when(dtype == "string", text_kind)
        .when(dtype.isin("tinyint", "smallint", "int", "bigint"), "int")
        .when(dtype.isin("float", "double") | dtype.startswith("decimal"), "float")
        .when(dtype == "boolean", "bool")
        .otherwise(dtype)
    )


def type_profile(df: DataFrame, columns: Sequence[str] | None = None, parse_text: bool = True) -> DataFrame:
    """Observed type with its greatest text length, or the mix of types; fill, missing, bad-null and
    duplicate percentages. ``parse_text=False`` reports text cells as ``str`` without parsing them."""
    columns = list(columns or df.columns)
    schema = _schema_table(df, columns)
    counts = value_counts(df, columns).join(F.broadcast(schema), "column")
    known = F.col("value").isNotNull()
    kind = _kind_of(F.col("value"), F.col("dtype")) if parse_text else F.when(F.col("dtype") == "string", "str").otherwise(_kind_of(F.col("value"), F.col("dtype")))
    per_kind = (
        counts.withColumn("kind", F.when(known, kind))
        .groupBy("column", "dtype", "kind")
        .agg(
            F.sum("n").alias("n"),
            F.count("*").alias("values"),
            F.max(F.length("value")).alias("width"),
            F.sum(F.when(is_bad_null("value"), F.col("n")).otherwise(0)).alias("bad"),
        )
    )
    is_known = F.col("kind").isNotNull()
    zero = F.lit(0).cast("long")
    stats = per_kind.groupBy("column", "dtype").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(is_known, F.col("n"))), zero).alias("non_null"),
        F.coalesce(F.sum(F.when(is_known, F.col("values"))), zero).alias("distinct"),
        F.sum("bad").alias("bad"),
        F.max(F.when(is_known, F.col("width"))).alias("width"),
        # At most one entry per kind, so the list is bounded.
        F.array_sort(F.collect_list(F.when(is_known, F.struct((-F.col("n")).alias("n"), "kind")))).alias("kinds"),
    )
    mix = F.concat(
        F.lit("errorType("),
        F.array_join(
            F.transform("kinds", lambda k: F.concat(k["kind"], F.lit(": "), F.format_string("%.2f%%", -k["n"] * 100.0 / F.col("non_null")))),
            ", ",
        ),
        F.lit(")"),
    )
    observed = (
        F.when(F.col("non_null") == 0, "NaN")
        .when(F.size("kinds") == 1, F.concat(F.get("kinds", F.lit(0))["kind"], F.lit("("), F.col("width").cast("string"), F.lit(")")))
        .otherwise(mix)
    )
    filled = F.col("non_null") > 0
    return stats.select(
        "column",
        "dtype",
        observed.alias("observed_type"),
        _share(F.col("non_null"), F.col("total")).alias("fill_pct"),
        _share(F.col("total") - F.col("non_null"), F.col("total")).alias("missing_pct"),
        F.when(filled, _share(F.col("bad"), F.col("total"))).otherwise(F.lit(0.0)).alias("bad_null_pct"),
        F.when(filled, _share(F.col("non_null") - F.col("distinct"), F.col("non_null"))).otherwise(F.lit(0.0)).alias("duplicate_pct"),
    )


def match_dictionary(profile: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Profile with the declared type of each column and whether the first three letters agree."""
    declared = dictionary.select(F.col("field").alias("column"), F.col("type").alias("declared"))
    return (
        profile.join(F.broadcast(declared), "column", "left")
        .withColumn("declared_type", F.coalesce("declared", F.lit("Unknown")))
        .drop("declared")
        .withColumn("types_match", same_prefix("observed_type", "declared_type"))
    )


def column_categories(profile: DataFrame, fill_threshold: float = 25.0) -> DataFrame:
    """Category flags of a profile; a column can carry several."""
    high = F.col("fill_pct") >= fill_threshold
    is_text = F.col("dtype") == "string"
    id_like = high & (F.col("unique_pct") > 90) & (F.col("distinct") > 1000)
    categorical = high & (F.col("unique_pct") <= 90) & (F.col("unique_pct") > 5) & is_text
    binary = high & F.col("distinct").between(2, 5)
    return profile.select(
        "column",
        id_like.alias("id_like"),
        categorical.alias("categorical"),
        binary.alias("binary"),
        (high & ~id_like & ~categorical & ~binary & ~is_text).alias("numeric"),
        (~high).alias("low_fill"),
    )


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with nulls: count, percentage and type, most gappy first. One aggregation."""
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    wide = df.agg(F.count("*").alias("rows"), *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    items = F.array(
        *[
            F.struct(F.lit(c).alias("column"), (F.col("rows") - F.col(f"c{i}")).alias("missing"), F.lit(kinds[c]).alias("dtype"))
            for i, c in enumerate(columns)
        ]
    )
    return (
        wide.select("rows", F.explode(items).alias("x"))
        .where(F.col("x.missing") > 0)
        .select("x.column", "x.missing", (F.col("x.missing") * 100.0 / F.col("rows")).alias("missing_pct"), "x.dtype")
        .orderBy(F.desc("missing"), "column")
    )


def frame_summary(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, missing cells and their share, and the number of columns per type."""
    tally: dict[str, int] = {}
    for f in df.schema:
        tally[f.dataType.simpleString()] = tally.get(f.dataType.simpleString(), 0) + 1
    width = len(df.columns)
    filled = F.lit(0).cast("long")
    for c in df.columns:
        filled = filled + F.count(quoted(c))
    types = ", ".join(f"{k}={v}" for k, v in sorted(tally.items()))
    cells = F.col("rows") * F.lit(width)
    return (
        df.agg(F.count("*").alias("rows"), filled.alias("filled"))
        .select(
            F.lit(name).alias("frame"),
            "rows",
            F.lit(width).cast("long").alias("columns"),
            (cells - F.col("filled")).alias("missing"),
            F.when(cells > 0, (cells - F.col("filled")) * 100.0 / cells).otherwise(0.0).alias("missing_pct"),
            F.lit(types).alias("column_types"),
        )
    )
