"""Sinks, cached loads, versioned snapshots and nested JSON."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gapweave.operators.windows import frame_digest, version_diff


def write_table(df: DataFrame, path: str, kind: str = "parquet", separator: str = ",") -> str:
    """Write to a new path as csv (with header), json lines or parquet."""
    writer = df.write
    if kind == "csv":
        # Quotes are doubled, as the readers here and elsewhere expect.
        writer.csv(path, sep=separator, header=True, escape='"')
    elif kind == "json":
        writer.json(path)
    else:
        writer.parquet(path)
    return path


def fingerprint(spark: SparkSession, path: str, by_content: bool = False) -> str:
    """Identity of the source files: names, sizes and times, or an order-free digest of their lines."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    if by_content:
        lines = spark.read.option("recursiveFileLookup", "true").text(path)
        n, digest = frame_digest(lines)
        return f"{n}-{digest & (2**128 - 1):032x}"
    entry = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    row = files.agg(F.count("*").alias("n"), F.sum(entry).cast("string").alias("h")).first()
    return f"{row['n']}-{int(row['h'] or 0) & (2**128 - 1):032x}"


def cached_load(
    spark: SparkSession, path: str, cache_dir: str, load: Callable[[SparkSession, str], DataFrame], by_content: bool = False, force: bool = False
) -> DataFrame:
    """The parsed frame as Parquet, written once per state of the source. A changed source, or ``force``, gets a new snapshot; nothing is
    overwritten, so readers of an older snapshot go on undisturbed. A snapshot is written aside and counts once a pointer names it; of
    several pointers the last one counts. What a failed write left behind is never named."""
    root = f"{cache_dir.rstrip('/')}/{fingerprint(spark, path, by_content)}"
    published = _published(spark, root)
    if published is None or force:
        snapshot = f"snapshot-{uuid.uuid4().hex}"
        load(spark, path).write.parquet(f"{root}/{snapshot}")
        published = _publish(spark, root, snapshot)
    return spark.read.parquet(f"{root}/{published}")


def _files(spark: SparkSession, path: str):
    """(file system, path) of a place that Spark can reach."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _pointers(spark: SparkSession, root: str) -> list[str]:
    files, place = _files(spark, f"{root}/pointers")
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def _published(spark: SparkSession, root: str) -> str | None:
    """Name of the published snapshot. A pointer's name says it all: a serial number, then the snapshot."""
    found = [p for p in _pointers(spark, root) if p[:12].isdigit()]
    return found[-1][13:] if found else None


def _publish(spark: SparkSession, root: str, snapshot: str) -> str:
    """Adds a pointer behind all others. Pointers are empty files, so there is no half-written one; of two writers with one
    serial number the later name counts, for all readers alike."""
    found = [int(p[:12]) for p in _pointers(spark, root) if p[:12].isdigit()]
    files, place = _files(spark, f"{root}/pointers/{max(found, default=0) + 1:012d}-{snapshot}")
    files.create(place, False).close()
    return snapshot


def save_version(df: DataFrame, root: str, version: str) -> None:
    """Stores a version once: written aside under a hidden name, then moved to its place in one step. A version that is there already raises."""
    spark, name = df.sparkSession, f"{root.rstrip('/')}/version={version}"
    files, target = _files(spark, name)
    if files.exists(target):
        raise FileExistsError(name)
    aside = f"{root.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    if files.exists(target) or not files.rename(_files(spark, aside)[1], target):
        raise FileExistsError(name)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Stored versions in ascending order; only the partition column is read."""
    try:
        found = spark.read.parquet(root).select(F.col("version").cast("string")).distinct().collect()
    except AnalysisException:
        return []
    return sorted(r[0] for r in found)


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/version={version}")


def save_and_compare(df: DataFrame, root: str, version: str) -> DataFrame:
    """Store a version and return its difference from the one before (all rows if there is none,
    no rows if the digests agree)."""
    spark = df.sparkSession
    earlier = [v for v in versions(spark, root) if v < version]
    save_version(df, root, version)
    new = read_version(spark, root, version)
    if not earlier:
        return version_diff(None, new)
    old = read_version(spark, root, earlier[-1])
    if frame_digest(old) == frame_digest(new):
        return version_diff(old, new).limit(0)
    return version_diff(old, new)


_GROUP_JSON = (
    "map<string, struct<combinations: array<struct<combination: array<string>, combination_percentage: double, "
    "frequency: string, fuzzy_score: int>>, total_percentage: double, total_frequency: string>>"
)


def read_group_json(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """Members of a nested group file, one row each. The group names are keys of one JSON object; a bare
    NaN inside a combination is a null."""
    text = spark.read.text(path, wholetext=True)
    groups = text.select(F.explode(F.from_json("value", _GROUP_JSON)).alias("group", "g"))
    rows = groups.select("group", F.explode("g.combinations").alias("m"), "g.total_percentage", "g.total_frequency")

    def item(i: int):
        value = F.get("m.combination", F.lit(i))
        return F.when(~value.isin('"NaN"', "NaN"), value)

    return rows.select(
        "group",
        *[item(i).alias(f) for i, f in enumerate(fields)],
        F.col("m.frequency").try_cast("bigint").alias("frequency"),
        F.col("m.combination_percentage").alias("percentage"),
        F.col("m.fuzzy_score").alias("score"),
        F.col("total_frequency").try_cast("bigint").alias("total_frequency"),
        "total_percentage",
    )
