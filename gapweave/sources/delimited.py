"""Delimited text: scans of file lists, separator choice, and tolerant reading of malformed lines."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from typing import NamedTuple
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gapweave.functions.scalars import quoted


def list_files(spark: SparkSession, directory: str, pattern: str = "*.csv") -> list[str]:
    """Files of a directory by name pattern; only names are read, no content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory).select("path")
    return sorted(r["path"] for r in files.collect())


def header_of(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path).limit(1).first()
    return row["value"] if row else ""


def headers_of(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """First line of every file, in one job; an empty file has an empty one.

    A task leaves a block that does not begin its file, and any block of full size, after its first rows, so a large file is
    not read for its header."""
    if not paths:
        return {}
    alone = _bytes_of(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    place = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start", "file_block_length")]

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            files = batch.column(1).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist()]
            fresh = [i for i in starts if batch.column(2)[i].as_py() == 0 and files[i] not in seen]
            seen.update(files[i] for i in fresh)
            yield pa.RecordBatch.from_arrays([pa.array([files[i] for i in fresh], pa.string()), pa.array([batch.column(0)[i].as_py() for i in fresh], pa.string())], names=["path", "header"])
            if batch.column(3)[0].as_py() >= alone:
                return

    lines = spark.read.text(list(paths)).select("value", *place).mapInArrow(first_lines, "path string, header string")
    found = {_plain(r["path"]): r["header"] for r in lines.collect()}
    return {p: found.get(_plain(p), "") for p in paths}


def _bytes_of(size: str) -> int:
    """Bytes of a Spark size such as ``128MB`` or ``134217728b``."""
    text = size.strip().lower().rstrip("b")
    scale = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(text[:-1] if scale else text) << scale


def _plain(path: str) -> str:
    """A path without the ways in which its scheme may be written."""
    text = unquote(path)
    return text[5:].lstrip("/") if text.startswith("file:") else text.lstrip("/")


def separator_of(header: str, separator: str = "\t", fallback: str = ",") -> str:
    return separator if separator in header or fallback not in header else fallback


def choose_separator(spark: SparkSession, path: str, separator: str = "\t", fallback: str = ",") -> str:
    """The given separator if it splits the header line, else the fallback if that one does."""
    return separator_of(header_of(spark, path), separator, fallback)


def _string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def column_names(header: str, separator: str) -> list[str]:
    return [h.strip().strip('"') for h in header.lstrip("﻿").split(separator)]


def scan(spark: SparkSession, paths: str | Sequence[str], separator: str = "\t", schema: T.StructType | None = None) -> DataFrame:
    """One scan over all paths. Without a schema every column is text, named by the first header; a file
    whose header differs is an error, since its cells would land in other columns."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    checked = schema is None and len(paths) > 1
    if schema is None:
        schema = _string_schema(column_names(header_of(spark, paths[0]), separator))
    return spark.read.csv(paths, sep=separator, header=True, schema=schema, enforceSchema=not checked, escape='"')


def load_frames(
    spark: SparkSession, directory: str, files: Sequence[str] | None = None, separator: str = "\t", schema: T.StructType | None = None
) -> dict[str, DataFrame]:
    """Frame per ``.csv`` file (name without extension), each with the separator its header calls for."""
    chosen = [p for p in list_files(spark, directory) if files is None or os.path.basename(p) in files]
    frames = {}
    for path, header in headers_of(spark, chosen).items():
        mark = separator_of(header, separator)
        frames[os.path.splitext(os.path.basename(path))[0]] = scan(spark, path, mark, schema or _string_schema(column_names(header, mark)))
    return frames


class Layout(NamedTuple):
    """What files must share to be read by one scan."""

    separator: str
    columns: tuple[str, ...]


def scan_groups(spark: SparkSession, paths: Sequence[str], separator: str = "\t", fallback: str = ",") -> dict[Layout, DataFrame]:
    """One scan per separator and header over many files, all columns as text. Headers are found in one job; empty files are left out."""
    groups: dict[Layout, list[str]] = {}
    for path, header in headers_of(spark, paths).items():
        if header:
            mark = separator_of(header, separator, fallback)
            groups.setdefault(Layout(mark, tuple(column_names(header, mark))), []).append(path)
    return {layout: scan(spark, found, layout.separator, _string_schema(layout.columns)) for layout, found in groups.items()}


def scan_tolerant(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str], separator: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine). Lines with too many fields are set aside as text; short lines are padded with nulls."""
    names = list(names)
    extra = ["__x1", "__x2"]
    schema = _string_schema([*names, *extra, "__line"])
    raw = (
        spark.read.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "__line")
        .option("columnPruning", "false")  # fields are counted, so all of them must be parsed
        .csv(path, sep=separator, header=header, schema=schema, enforceSchema=True, escape='"')
    )
    # The raw line is kept for every row whose field count is not that of the padded schema, which no
    # good row has; an unquoted empty field at the end counts as a field.
    unquoted = F.regexp_replace("__line", r'"(?:[^"]|"")*"', "q")
    fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(separator))) + 1
    too_long = F.col("__line").isNull() | (fields > len(names))
    cells = [F.when(F.col(quoted(n)) != "", F.col(quoted(n))).alias(n) for n in names]
    line = F.coalesce(F.col("__line"), F.concat_ws(separator, *[F.col(quoted(n)) for n in [*names, *extra]]))
    return raw.where(~too_long).select(*cells), raw.where(too_long).select(line.alias("line"))


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Frame without the columns that hold no value at all; one aggregation."""
    row = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[F.col(quoted(c)) for i, c in enumerate(df.columns) if row[f"c{i}"] > 0])
