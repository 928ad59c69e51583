"""Field dictionaries: the declared type of every column, and text frames cast by it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from gapweave.functions.scalars import iso_to_timestamp, quoted, tags, to_number
from gapweave.plans.rule_tables import SUFFIX_TYPES

# Logical type -> Spark type.
_SPARK_TYPES = {"unix_timestamp": "bigint", "iso8601_datetime": "timestamp_ntz", "float": "double", "string": "string"}


def _by_suffix(field: Column, rules: Sequence[tuple], place: int, default: str | None) -> Column:
    """Type or sub-type by suffix; a later rule wins over an earlier one."""
    value = F.lit(default)
    for rule in rules:
        if rule[place] is not None:
            value = F.when(field.endswith(rule[0]), rule[place]).otherwise(value)
    return value


def infer_types(fields: DataFrame, column: str = "field", rules: Sequence[tuple] = SUFFIX_TYPES) -> DataFrame:
    """Adds ``type`` and ``sub_type`` from the suffix rules."""
    c = F.col(quoted(column))
    return fields.withColumn("type", _by_suffix(c, rules, 1, "string")).withColumn("sub_type", _by_suffix(c, rules, 2, None))


def read_dictionary(spark: SparkSession, path: str, start: str = "list of fields:", rules: Sequence[tuple] = SUFFIX_TYPES) -> DataFrame:
    """(section, position, field, type, sub_type, description) of a ``name : description`` list.

    A colon that touches the name is not part of it."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("position", "line"))
    text = F.trim("line")
    # A dictionary is one short file, so its window is small.
    upto = Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.regexp_replace(F.lower(F.regexp_replace(text, r"^#\s*", "")), r"[\s:]", "")
    marked = (
        lines.withColumn("open", F.max(F.lower(text).startswith(start)).over(upto))
        .withColumn("section", F.last(F.when(F.col("open") & text.startswith("#"), heading), ignorenulls=True).over(upto))
        .where(F.col("open") & (text != "") & ~text.startswith("#") & ~F.lower(text).startswith(start) & F.col("section").isNotNull())
    )
    fields = marked.select(
        "section",
        "position",
        F.regexp_extract(text, r"^([^\s:]+)", 1).alias("field"),
        F.nullif(F.trim(F.regexp_extract(text, r"^[^\s:]+\s*:\s*(.+)$", 1)), F.lit("")).alias("description"),
    )
    return infer_types(fields, "field", rules).select("section", "position", "field", "type", "sub_type", "description")


def schema_of(dictionary: DataFrame) -> T.StructType:
    """Schema with the dictionary's types, and section and description as field metadata."""
    fields = []
    for r in dictionary.orderBy("position").collect():
        kind = T.ArrayType(T.StringType()) if r["sub_type"] == "tags" else T.StructType.fromDDL(f"x {_SPARK_TYPES[r['type']]}")["x"].dataType
        meta = {k: r[k] for k in ("section", "description", "type") if r[k]}
        fields.append(T.StructField(r["field"], kind, True, meta))
    return T.StructType(fields)


def _cast(c: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        return tags(c)
    if isinstance(kind, T.DoubleType):
        return to_number(c)
    if isinstance(kind, T.TimestampNTZType):
        return iso_to_timestamp(c)
    return F.col(quoted(c)).try_cast(kind)


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One projection that casts text columns to the declared types; what does not parse becomes null.
    Columns the schema does not know stay as they are."""
    known = {f.name: f for f in schema}
    return df.select(
        *[
            _cast(c, known[c].dataType).alias(c, metadata=known[c].metadata) if c in known else F.col(quoted(c))
            for c in df.columns
        ]
    )


def apply_suffix_types(df: DataFrame, rules: Sequence[tuple] = SUFFIX_TYPES) -> DataFrame:
    """``apply_schema`` with types taken from the column names alone."""
    names = df.sparkSession.createDataFrame([(i, c, None, None) for i, c in enumerate(df.columns)], "position int, field string, section string, description string")
    return apply_schema(df, schema_of(infer_types(names, "field", rules)))
