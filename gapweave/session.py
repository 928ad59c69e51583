"""Session settings and the shared folder that iterative operators write to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

#: A task that holds more rows than this, and twice its share, makes ``spread`` deal the frame anew.
SPREAD_ROWS = 100_000
#: Independent fits whose jobs the driver hands out at the same time.
AT_ONCE = 4
#: Rows up to which fits that keep a copy of their rows run beside each other.
ROWS_AT_ONCE = 5_000_000


def build_session(app: str = "gapweave", cores: str = "*", memory: str = "8g", shared: str | None = None) -> SparkSession:
    """Local session for tests and the benchmark, with its shared folder; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        # The JVM compiles no method above 8,000 bytes: larger generated code is better split up.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Checkpoints of finished rounds are removed once nothing refers to them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in local mode a temporary one if it is unset."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base is None and sc.getCheckpointDir() is not None:
        base = os.path.dirname(sc.getCheckpointDir())
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="gapweave-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: ends the lineage and fixes the rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    """Partition count for shuffles that must not be coalesced."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """The frame over all tasks, for long work on its rows. A file of one row group is read by one task however large it is; frames that are small or
    evenly dealt stay as they are."""
    tasks = partitions(df.sparkSession)
    row = df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count").alias("most"), F.sum("count").alias("n")).first()
    most, n = row["most"] or 0, row["n"] or 0
    return df.repartition(tasks) if most > max(SPREAD_ROWS if least is None else least, 2 * n // tasks) else df


def side_by_side(spark: SparkSession, works: Sequence[Callable], at_once: int = AT_ONCE) -> list:
    """Results, in order, of independent works whose jobs run beside each other: the many short jobs of one leave cores idle. At most ``at_once`` run at a time."""
    if len(works) < 2 or at_once < 2:
        return [work() for work in works]
    # Wrapped here: the threads take over this thread's job group, pool and tags.
    works = [inheritable_thread_target(spark)(work) for work in works]
    pool = ThreadPool(min(at_once, len(works)))
    try:
        return pool.map(lambda work: work(), works, chunksize=1)
    finally:
        # Works that have begun end by themselves, also when one failed.
        pool.close()
        pool.join()
