"""Helpers of the corpus operators: batches of text inside tasks, hashing, linked components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gapweave.functions.scalars import quoted
from gapweave.session import scratch_path

#: Characters handled at once by vectorised code; one longer text makes a slice of its own.
SLICE_CHARS = 1 << 19
#: Bytes of a batch that a function is given; a longer row makes one of its own.
BATCH_BYTES = 4 << 20
#: Tables of powers grow by so many entries.
_TABLE_STEP = 1 << 16
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the workers of the session's context, as ``--py-files`` does; once a context. Rows
    here are whole texts, so batches of Spark's usual size would hold a large share of an executor: it is lowered unless the session has its own."""
    if spark.conf.get(_BATCH_SETTING, "64m") in ("64m", "67108864b"):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_gapweave_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp()  # on the driver alone, until it ends; Spark serves the file from there
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "gapweave-package"), "zip", os.path.dirname(root), os.path.basename(root)))
    sc._gapweave_shipped = True


def col(name: str):
    return F.col(quoted(name))


def free_name(wanted: str, names: list[str]) -> str:
    """The name itself or, where a column has it, the first numbered one that is free."""
    taken = {n.lower() for n in names}
    return next(n for n in (wanted, *(f"{wanted}_{i}" for i in range(1, len(names) + 2))) if n not in taken)


def plain_names(df: DataFrame) -> DataFrame:
    """The frame with names that ``mapInArrow`` can resolve: those with dots or backquotes are numbered."""
    return df.toDF(*[f"__named_{i}" if "." in n or "`" in n else n for i, n in enumerate(df.columns)])


def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task cut down to ``BATCH_BYTES``. When they end, memory that the worker no longer uses goes back to the
    system: workers outlive their tasks, and what one stage took is no use to the next."""
    try:
        for batch in batches:
            left = [batch] if batch.num_rows else []
            while left:
                part = left.pop()
                if part.num_rows > 1 and part.nbytes > BATCH_BYTES:
                    half = part.num_rows // 2
                    left += [part.slice(half), part.slice(0, half)]
                else:
                    yield part
    finally:
        release()


def release() -> None:
    SpanHash.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the C library that has it
        pass


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with one call per bounded batch."""

    def run(batches):
        for batch in bounded(batches):
            yield from work(batch)

    return plain_names(df).mapInArrow(run, schema)


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts as Python strings, null as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(base: int, prime: int, size: int) -> np.ndarray:
    """Powers of ``base`` modulo a prime under 2**31, in 32 bits, put together by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < size:
        out = np.concatenate([out, out[: size - len(out)] * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out.astype(np.uint32)


class SpanHash:
    """64-bit hashes of any spans of a code array, by prefix sums of two polynomials: one modulo 2**64, which long regular
    spans can fool whatever its base, and one modulo a prime, which they cannot."""

    _base = 0xD6E8FEB86659FD93
    _prime, _second = (1 << 31) - 1, 1_220_703_127
    _table = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))
    _powers: tuple[np.ndarray, ...] = ()

    @classmethod
    def _tables(cls, n: int) -> tuple[np.ndarray, ...]:
        """Powers and inverse powers of both bases; those of one slice are kept until the task ends."""
        if cls._powers and len(cls._powers[0]) >= n:
            return cls._powers
        size = -(-n // _TABLE_STEP) * _TABLE_STEP
        own = []
        for b in (cls._base, pow(cls._base, -1, 1 << 64)):
            table = np.full(size, np.uint64(b))
            table[0] = 1
            own.append(np.cumprod(table, dtype=np.uint64, out=table))
        own += [_power_table(b, cls._prime, size) for b in (cls._second, pow(cls._second, -1, cls._prime))]
        if size <= 2 * SLICE_CHARS:
            cls._powers = tuple(own)
        return tuple(own)

    @classmethod
    def forget(cls) -> None:
        """Drops the tables; the next slice makes them again."""
        cls._powers = ()

    def __init__(self, codes: np.ndarray):
        n = len(codes) + 1
        up, self._down, second, self._second_down = self._tables(n)
        small = codes.dtype == np.uint8 or not n - 1 or int(codes.max()) < len(SpanHash._table)
        values = self._table[codes] if small else mix(codes.astype(np.uint64) + np.uint64(1))
        prime = np.uint64(self._prime)
        self._sums, self._seconds = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        np.cumsum(values * up[: n - 1], out=self._sums[1:])
        # Terms are under 2**31, so their sums stay exact.
        np.cumsum((values >> np.uint64(33)) * second[: n - 1] % prime, out=self._seconds[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal spans have equal hashes; the length takes part."""
        raw = (self._sums[end] - self._sums[start]) * self._down[start]
        other = (self._seconds[end] - self._seconds[start]) % np.uint64(self._prime) * self._second_down[start] % np.uint64(self._prime)
        return self._closed(raw, other, (end - start).astype(np.uint64))

    def without(self, at: np.ndarray) -> np.ndarray:
        """Hash of all codes but the one at each place, as ``of`` gives it for such an array."""
        n, prime = len(self._sums) - 1, np.uint64(self._prime)
        raw = self._sums[at] + (self._sums[n] - self._sums[at + 1]) * self._down[1]
        later = (self._seconds[n] - self._seconds[at + 1]) % prime * self._second_down[1]
        return self._closed(raw, (self._seconds[at] + later) % prime, np.full(len(at), n - 1, np.uint64))

    @staticmethod
    def _closed(raw: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
        return mix(raw + size * _ODD + mix(other + np.uint64(1)))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a written table of the shared folder: computed once, safe against lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def linked(edges: DataFrame, spark: SparkSession, label: str = "links") -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root the smallest node. Large-star and
    small-star steps; every step writes its edges to the shared folder, none comes to the driver."""
    forest = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), label
    )
    while True:
        # Done once every node has one edge up, to a node that has none.
        ends = forest.select("u", F.lit(1).alias("up"), F.lit(0).alias("top")).union(forest.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("top").alias("top")).where("up > 1 or up > 0 and top > 0").isEmpty():
            break
        both = forest.union(forest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        forest = stored(small.where("u <> v").distinct(), label)
    roots = forest.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
