"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Piece lengths fall into reciprocal-capacity classes: class m holds pieces of at most capacity / m tokens, and a sequence of
the class holds exactly m of them. Which sequence a piece joins depends on nothing but its number within its class, so every
worker fills its sequences alone.

Documents may be cut. So a document gives full sequences first, then, while much would be left empty, a piece that fills
its class to the last token, and goes on with the rest. Classes are spaced so that their sequences divide the capacity well, and few
stay open in a worker. The pieces of the open ones (less than a sequence for each class and partition) are numbered once more,
over all workers together: a count for each class and partition gives each its first number.

A sequence's padding is what its pieces leave of the capacity, or nothing where their total is a power of two.

Cases: null text counts as empty, and an empty document is one piece that holds the end token alone; repeated rows are packed
each on its own; a null key is kept; an empty table gives no rows; extra columns do not matter."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gapweave.llm.common import bounded, col, slices, stored, texts_of
from gapweave.llm.words import Words

CAPACITY, END = 4096, 2
#: Share of a piece's room that may stay empty before the document is cut again; a rest of at most LEAST tokens is never cut.
SLACK, LEAST = 0.02, 32
#: Room of the smallest class: shorter pieces take that much.
SMALLEST = 16


def classes(capacity: int = CAPACITY) -> list[int]:
    """Pieces in a sequence of each class: powers of two, and one and a half times these, down to the smallest room."""
    out, m = [], 1
    while m == 1 or capacity // m >= SMALLEST:
        out.append(m)
        if m > 1 and capacity // (3 * m // 2) >= SMALLEST:
            out.append(3 * m // 2)
        m *= 2
    return out


def cut(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """(piece length, class) of a document, in turn."""
    out = [(capacity, 1)] * (length // capacity)
    left = length % capacity
    ladder = classes(capacity)
    while left:
        # The smallest room that holds the rest, and the largest that the rest fills.
        holds = next(m for m in reversed(ladder) if capacity // m >= left)
        if left <= LEAST or capacity // holds - left <= slack * (capacity // holds):
            out.append((left, holds))
            break
        fills = next(m for m in ladder if capacity // m <= left)
        out.append((capacity // fills, fills))
        left -= capacity // fills
    return out


def pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False, slack: float = SLACK) -> DataFrame:
    """One row per piece, not yet placed across workers: key, start, length, crc of its ids, the document's tokens, class,
    number in the class within the task, and on request the ids."""
    ladder = classes(capacity)
    wanted = docs.select(col(key).alias("key"), col(text).alias("text"))
    schema = f"key {wanted.schema['key'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, class int, part int, number long" + (", ids array<int>" if with_ids else "")

    def work(batches: Iterator[pa.RecordBatch]):
        words, task = Words.of(path), TaskContext.get().partitionId()
        placed = dict.fromkeys(ladder, 0)
        plans: dict[int, list[tuple[int, int]]] = {}
        for batch in bounded(batches):
            texts, keys = texts_of(batch), batch.column(0)
            for low, high in slices(texts):
                every, sizes = words.encode(texts[low:high])
                ends = np.cumsum(sizes)
                rows, cols, kept = [], [[] for _ in range(7)], []
                for i in range(high - low):
                    ids = np.append(every[ends[i] - sizes[i] : ends[i]], end).astype("<u4")
                    size = len(ids)
                    if size not in plans:
                        plans[size] = cut(size, capacity, slack)
                        if len(plans) > 20_000:
                            plans = {size: plans[size]}
                    at = 0
                    for length, m in plans[size]:
                        piece = ids[at : at + length]
                        for c, v in zip(cols, (at, length, zlib.crc32(piece.tobytes()), size, m, task, placed[m]), strict=True):
                            c.append(v)
                        rows.append(low + i)
                        if with_ids:
                            kept.append(piece.astype(np.int32))
                        placed[m] += 1
                        at += length
                arrays = [keys.take(pa.array(rows, pa.int64()))]
                arrays += [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()], strict=True)]
                if with_ids:
                    arrays.append(pa.array(kept, pa.list_(pa.int32())))
                names = ["key", "start", "length", "ids_crc32", "doc_tokens", "class", "part", "number", "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return wanted.mapInArrow(work, schema)


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False, slack: float = SLACK) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; sequences are gapless from 0."""
    cut_up = stored(pieces(docs, path, key, text, capacity, end, with_ids, slack), "pieces")
    ladder = classes(capacity)
    # Sequences that a task filled by itself: class, task and number make the id.
    counts = cut_up.groupBy("class", "part").agg(F.count("*").alias("n"))
    full = F.col("n") - F.col("n") % F.col("class")
    # What is left over is numbered on from the other tasks' left-overs of the class: one row per class and task.
    rest = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    table = counts.select("class", "part", full.alias("full"), F.coalesce(F.sum(F.col("n") - full).over(rest), F.lit(0)).alias("before"))
    placed = cut_up.join(table, ["class", "part"])
    alone = F.col("number") < F.col("full")
    within = F.when(alone, F.col("number")).otherwise(F.col("before") + F.col("number") - F.col("full"))
    rank = F.create_map(*[F.lit(x) for i, m in enumerate(ladder) for x in (m, i)])[F.col("class")].cast("long")
    # 5 bits of class, 22 of task (0 where tasks share), 36 of number.
    task = F.when(alone, F.col("part") + 1).otherwise(0).cast("long")
    number = F.floor(within / F.col("class")).cast("long")
    sequence = F.shiftleft(rank, 58).bitwiseOR(F.shiftleft(task, 36)).bitwiseOR(number)
    located = placed.withColumn("sequence_id", sequence).withColumn("slot", within % F.col("class"))
    # Offsets sum the lengths before a piece in its sequence, which has at most ``capacity`` pieces.
    turn = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(turn), F.lit(0)).cast("long")
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset.alias("offset"), "class"]
    return located.select(*names, *(["ids"] if with_ids else []))


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens, and tokens of padding (none at a power of two)."""
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("size"))
    short = F.when(F.bit_count("size") == 1, 0).otherwise(capacity - F.col("size"))
    return sums.agg(F.count("*").alias("sequences"), F.sum("size").alias("tokens"), F.sum(short).alias("padding"))
