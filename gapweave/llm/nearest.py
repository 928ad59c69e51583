"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing with exact reranking.

Vectors get one more component that brings all of them to the largest length (queries: 0), so the largest inner product is
the least distance. Each table projects on Gaussian directions and cuts the projections into cells of a fixed width; the
cells of all directions make a bucket. A query visits, in each table, its own bucket and the perturbed buckets whose moves
(one cell up or down in some directions) have the least sum of squared distances to the crossed borders, which is the order of estimated success.

Equal vectors are one entry that keeps its lowest k + 1 ids. The entries and the probes of a bucket are dealt into cells
of bounded size that meet in a co-grouped block product. The tables' winners are merged, and scores are recomputed in double
precision on the original vectors. Queries that found fewer than k are compared with every entry, in blocks.

Cases: vectors that are null, zero or hold null or non-finite components take no part, nor those whose length is not the commonest one; ties go to the smaller id; repeated ids
count once for each different vector; with fewer than k candidates all of them are given; an empty table gives no rows; extra columns do not matter."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gapweave.llm.common import col, map_batches, mix, stored

#: Tables, directions of a table, probes of a query in a table, and cell width as a share of the vectors' mean square length.
TABLES, DIRECTIONS, PROBES, WIDTH = 8, 6, 32, 2.0
#: Entries and probes of one block product.
CELL = 2048


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (id, v) that take part; components as they are stored."""
    v = col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~odd)
    return rows.where(F.exists("v", lambda x: x != 0)).dropDuplicates()


def _hash_plan(width: int, size: float, tables: int, directions: int) -> tuple[np.ndarray, np.ndarray, float]:
    r = np.random.default_rng(7)
    step = WIDTH * size
    return r.standard_normal((tables, width + 1, directions)), r.uniform(0, step, (tables, directions)), step


def _bucket(table: int, cells: np.ndarray) -> np.ndarray:
    h = np.full(len(cells), np.uint64(table + 1))
    for i in range(cells.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + cells[:, i].astype(np.int64).view(np.uint64))
    return h.view(np.int64)


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()].astype(np.float64).reshape(len(lists), -1)


def neighbours(
    df: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", tables: int = TABLES, directions: int = DIRECTIONS, probes: int = PROBES
) -> DataFrame:
    """Rows (query_id, rank from 1, vec_id, score): the k found for every query, nearest first; a query is no candidate of its own."""
    spark = df.sparkSession
    rows, asked = usable(df, key, vector), usable(queries, key, vector)
    # Vectors of other lengths than the commonest (of equally common ones: the longest) take no part.
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    n = lengths["n"] if lengths else 0
    rows, asked = rows.where(F.size("v") == n), asked.where(F.size("v") == n)
    shape = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("top"), F.avg(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("mean"), F.count("*").alias("rows")).first()
    out = "query_id long, rank int, vec_id long, score double"
    if not shape["rows"]:
        return spark.createDataFrame([], out)
    top, size = shape["top"], float(np.sqrt(shape["mean"]))
    kind = rows.schema["v"].dataType.simpleString()
    # Equal vectors in two steps, so that no group meets in one task.
    part = Window.partitionBy("v", "part").orderBy("id")
    some = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("r", F.row_number().over(part)).where(F.col("r") <= k + 1)
    few = some.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    entries = stored(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("e", F.xxhash64("v")), "vectors")
    plan = _hash_plan(n, size, tables, directions)
    moves = np.array(list(itertools.product((0, -1, 1), repeat=directions)), np.int64)

    def place(batch: pa.RecordBatch):
        a, b, step = plan
        v = _matrix(batch.column(0))
        long = np.sqrt(np.maximum(top - (v * v).sum(1), 0))
        v = np.column_stack([v, long])
        keys = np.stack([_bucket(t, np.floor((v @ a[t] + b[t]) / step)) for t in range(tables)], 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(list(keys), pa.list_(pa.int64()))], ["v", "ids", "e", "keys"])

    def probe(batch: pa.RecordBatch):
        a, b, step = plan
        for at in range(0, batch.num_rows, 512):
            own = batch.slice(at, 512)
            v = np.column_stack([_matrix(own.column(1)), np.zeros(own.num_rows)])
            keys = []
            for t in range(tables):
                place = (v @ a[t] + b[t]) / step
                cell = np.floor(place)
                down, up = (place - cell) ** 2, (1 - place + cell) ** 2
                cost = down @ (moves == -1).T + up @ (moves == 1).T
                order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
                visited = cell[:, None, :] + moves[order]
                keys.append(_bucket(t, visited.reshape(-1, directions)).reshape(len(v), -1))
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(list(np.concatenate(keys, 1)), pa.list_(pa.int64()))], ["q", "qv", "keys"])

    index = map_batches(entries.select("v", "ids", "e"), place, f"v {kind}, ids array<long>, e long, keys array<long>").withColumn("key", F.explode("keys")).drop("keys")
    wanted = asked.select(F.col("id").alias("q"), F.col("v").alias("qv"))
    visits = map_batches(wanted, probe, f"q long, qv {kind}, keys array<long>").withColumn("key", F.explode(F.array_distinct("keys"))).drop("keys")
    found = stored(_best(_met(index, visits, k), k), "neighbours")
    # Queries with fewer than k: every entry, dealt into blocks.
    total = int(entries.agg(F.count("*")).first()[0])
    blocks = max(1, total // CELL)
    short = wanted.join(found.groupBy(F.col("query_id").alias("q")).count().where(F.col("count") >= k), "q", "left_anti")
    if not short.isEmpty() and shape["rows"] > 1:
        dealt = entries.withColumn("key", F.pmod("e", F.lit(blocks)).cast("long")).select("v", "ids", "e", "key")
        all_blocks = short.withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        rest = _best(_met(dealt, all_blocks, k), k)
        found = found.join(short.select(F.col("q").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(rest)
    return found.select("query_id", "rank", "vec_id", "score")


def _met(index: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Candidates (q, id, score) of every block product: per query the k best ids of the block."""
    a = index.groupBy("key").agg(F.ceil(F.count("*") / CELL).cast("int").alias("na"))
    b = visits.groupBy("key").agg(F.ceil(F.count("*") / CELL).cast("int").alias("nb"))
    sizes = a.join(b, "key")
    left = index.join(sizes, "key").withColumn("i", F.pmod("e", "na").cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    right = visits.join(sizes, "key").withColumn("j", F.pmod(F.xxhash64("q"), F.col("nb")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("na") - 1)))

    def work(entries: pa.Table, asked: pa.Table) -> pa.Table:
        columns = [[], [], []]
        if entries.num_rows and asked.num_rows:
            v, ids = _matrix(entries["v"].combine_chunks()), entries["ids"].to_pylist()
            qs, qv = asked["q"].to_pylist(), _matrix(asked["qv"].combine_chunks())
            score = qv @ v.T
            few = min(k + 1, len(v))
            for r, q in enumerate(qs):
                row = score[r]
                # One entry may be the query alone; equal scores at the edge all stay.
                edge = np.partition(row, len(row) - few)[len(row) - few] if len(row) > few else -np.inf
                near = np.flatnonzero(row >= edge - 1e-9 * max(1.0, abs(edge)) if np.isfinite(edge) else np.ones(len(row), bool))
                exact = (v[near] * qv[r]).sum(1)
                best = sorted((-s, i) for s, e in zip(exact.tolist(), near.tolist(), strict=True) for i in ids[e] if i != q)[:k]
                columns[0] += [q] * len(best)
                columns[1] += [i for _, i in best]
                columns[2] += [-s for s, _ in best]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["q", "id", "score"])

    left, right = left.select("key", "i", "j", "v", "ids"), right.select("key", "i", "j", "q", "qv")
    return left.groupBy("key", "i", "j").cogroup(right.groupBy("key", "i", "j")).applyInArrow(work, "q long, id long, score double")


def _best(met: DataFrame, k: int) -> DataFrame:
    """The k best of all blocks and tables."""
    order = [F.desc("score"), F.asc("id")]
    near = met.withColumn("d", F.dense_rank().over(Window.partitionBy("q").orderBy(*order))).where(F.col("d") <= k).dropDuplicates(["q", "id", "score"])
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
