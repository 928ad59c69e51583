"""Row-wise operators and batch-fitted models on streaming frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gapweave.session import scratch_path


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def clean_stream(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Apply a row-wise operator, or the ``transform`` of a fitted model, and append the result as Parquet.

    Progress lives in ``checkpoint``, so a restarted query continues where it stopped."""
    writer = transform(source).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def drain(spark: SparkSession, path: str, schema: StructType, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run everything available through the stream into a table of the shared folder and read it."""
    out = scratch_path(spark, "stream")
    query = clean_stream(read_parquet_stream(spark, path, schema), transform, f"{out}/rows", f"{out}/progress")
    query.awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def drain_counted(
    spark: SparkSession, path: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], name: str, files_per_trigger: int = 1000
) -> tuple[DataFrame, dict[str, int]]:
    """``drain`` with the counters that ``transform`` observes under ``name``, added up over the batches of this run.

    Progress is read while the query runs, since only the latest batches are kept; a run without a batch gives no counters."""
    out = scratch_path(spark, "stream")
    query = clean_stream(read_parquet_stream(spark, path, schema, files_per_trigger), transform, f"{out}/rows", f"{out}/progress")
    batches: dict[int, dict[str, int]] = {}
    running = True
    while running:
        running = not query.awaitTermination(0.2)
        for progress in query.recentProgress:
            if name in progress.observedMetrics:
                batches[progress.batchId] = progress.observedMetrics[name].asDict()
    totals: dict[str, int] = {}
    for counts in batches.values():
        for k, v in counts.items():
            totals[k] = totals.get(k, 0) + (v or 0)
    written = transform(spark.createDataFrame([], schema)).schema
    return spark.read.schema(written).parquet(f"{out}/rows"), totals
