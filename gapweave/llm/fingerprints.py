"""Document fingerprints from closed syncmers.

A k-mer of code points is kept if the least of its inner s-mers (by hash) stands at either end. That depends on the k-mer
alone, so equal passages give equal anchors whatever is around them. A document's anchors are (position, hash). Two texts are
matched by position: the n-th place of an anchor in one text with its n-th place in the other, and of these pairs the most that
stand in the same order in both texts. Their likeness is the share of such pairs in all anchors of both. The written
fingerprint is a short digest for look-ups, the 64 lowest distinct hashes; the likeness uses all anchors.

Cases: null text counts as empty; a text shorter than k has one anchor, the whole text; an empty text has the empty fingerprint,
and two empty ones have likeness 1; repeated rows each get a row; null keys come last in descending order; an empty table gives no
rows; extra columns do not matter."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gapweave.llm.common import SLICE_CHARS, SpanHash, bounded, col, map_batches, slices, texts_of
from gapweave.session import partitions

K, S, KEPT = 16, 6, 64


def anchors(texts: list[str], k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, 32-bit hash) of the closed syncmers of all texts. Long texts go in parts that overlap by k - 1."""
    found, parts = [], []
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - k + 1, 1), SLICE_CHARS):
            parts.append((i, at, text[at : at + SLICE_CHARS + k - 1]))
    for low, high in slices([p[2] for p in parts]):
        some = parts[low:high]
        sizes = np.array([len(p[2]) for p in some])
        codes = np.frombuffer("".join(p[2] for p in some).encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        spans = SpanHash(codes)
        starts = np.zeros(0, np.int64)
        if len(codes) >= k:
            inner = np.arange(len(codes) - s + 1)
            value = spans.of(inner, inner + s)
            width = k - s + 1
            # Least of each window of ``width`` values, by doubling.
            least, reach = value, 1
            while reach < width:
                step = min(reach, width - reach)
                least = np.minimum(least[: len(least) - step], least[step:])
                reach += step
            n = len(codes) - k + 1
            least = least[:n]
            starts = np.flatnonzero((value[:n] == least) | (value[width - 1 : width - 1 + n] == least))
            # Not across two texts.
            starts = starts[begin[np.searchsorted(begin, starts, side="right")] - starts >= k]
        part = np.searchsorted(begin, starts, side="right") - 1
        hashes = spans.of(starts, starts + k)
        short = np.flatnonzero((sizes > 0) & (sizes < k))
        part = np.concatenate([part, short])
        place = np.concatenate([starts, begin[short]])
        hashes = np.concatenate([hashes, spans.of(begin[short], begin[short] + sizes[short])])
        owner, offset = np.array([p[0] for p in some], np.int64), np.array([p[1] for p in some], np.int64)
        found.append((owner[part], offset[part] + place - begin[part], (hashes >> np.uint64(32)).astype(np.uint32)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    joined = [np.concatenate(x) for x in zip(*found, strict=True)]
    order = np.lexsort((joined[1], joined[0]))
    return tuple(x[order] for x in joined)


def anchor_lists(texts: list[str], k: int = K, s: int = S) -> list[np.ndarray]:
    """The anchor hashes of each text in the order of their positions."""
    owner, _, hashes = anchors(texts, k, s)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [hashes[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def written(hashes: np.ndarray, kept: int = KEPT) -> str:
    """The lowest distinct hashes, ascending, as text."""
    return np.unique(hashes)[:kept].astype(">u4").tobytes().hex()


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """Each hash with the number of its equals before it."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.searchsorted(ordered, ordered, side="left")
    earlier = np.empty(len(hashes), np.uint64)
    earlier[order] = np.arange(len(hashes)) - first
    return (hashes.astype(np.uint64) << np.uint64(32)) | earlier


def longest_rise(values: np.ndarray) -> int:
    """Length of the longest strictly rising subsequence."""
    if (values[1:] > values[:-1]).all():
        return len(values)
    ends: list[int] = []
    for v in values.tolist():
        at = bisect_left(ends, v)
        ends[at : at + 1] = [v]
    return len(ends)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the anchors of two texts, given in order, that are matched in order; 1 for equal texts, 0 without a common anchor."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    if np.array_equal(a, b):
        return 1.0
    _, here, there = np.intersect1d(_numbered(a), _numbered(b), assume_unique=True, return_indices=True)
    matched = longest_rise(there[np.argsort(here)])
    return matched / (len(a) + len(b) - matched)


def document_anchors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, position, anchor): the syncmers of every document for positional matching."""

    def work(batch: pa.RecordBatch):
        texts, keys = texts_of(batch), batch.column(0)
        for low, high in slices(texts):
            owner, place, hashes = anchors(texts[low:high])
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner + low)), pa.array(place), pa.array(hashes.astype(np.int64))], ["key", "position", "anchor"])

    rows = docs.select(col(key).alias("key"), col(text).alias("text"))
    return map_batches(rows, work, f"key {rows.schema['key'].dataType.simpleString()}, position long, anchor long")


def compared_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its text with the last third replaced by the start of the next document's
    (descending key, the first after the last; equal keys by text hash), and how like its own both are.

    Documents are dealt into ranges of the key. The first one of a range, which the range before needs as well, is
    dealt to both; only range borders (one row a range) come to the driver."""
    spark = docs.sparkSession
    rows = docs.select(col(key).alias("key"), col(text).alias("text")).withColumn("h", F.xxhash64("text"))
    n = partitions(spark)
    borders = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else None
    borders = sorted(set(borders or []))
    ranged = F.lit(len(borders)) - sum((F.when(F.col("key") >= b, 1).otherwise(0) for b in borders), F.lit(0))
    rows = rows.withColumn("range", F.when(F.col("key").isNull(), len(borders)).otherwise(ranged).cast("int"))
    order = F.struct(F.col("key").isNotNull().alias("known"), "key", "h")
    heads = sorted(rows.groupBy("range").agg(F.max(order).alias("head")).collect(), key=lambda r: r["range"])
    kind = rows.schema["key"].dataType.simpleString()
    table = [(r["range"], r["head"]["key"], r["head"]["h"], heads[i - 1]["range"]) for i, r in enumerate(heads)]
    table = F.broadcast(spark.createDataFrame(table, f"range int, head_key {kind}, head_h long, before int"))
    with_heads = rows.join(table, "range")
    is_head = F.col("key").eqNullSafe(F.col("head_key")) & (F.col("h") == F.col("head_h"))
    here = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    there = F.struct(F.col("before").alias("range"), F.lit(True).alias("guest"))
    dealt = with_heads.withColumn("at", F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here)))).select("at.range", "at.guest", "key", "h", "text")
    dealt = dealt.repartitionById(len(borders) + 1, "range").sortWithinPartitions("range", "guest", F.desc_nulls_last("key"), F.desc("h")).select("range", "guest", "key", "text")

    def work(batches: Iterator[pa.RecordBatch]):
        waiting = None  # (range, key, text, anchors) that lacks its next document
        for batch in bounded(batches):
            texts = texts_of(batch, "text")
            ranges, guests, keys = (batch.column(i).to_pylist() for i in range(3))
            for low, high in slices(texts):
                done = []
                for i, own in zip(range(low, high), anchor_lists(texts[low:high]), strict=True):
                    if waiting is not None and waiting[0] == ranges[i]:
                        done.append((*waiting[1:], texts[i], own))
                        waiting = None
                    if not guests[i]:
                        waiting = (ranges[i], keys[i], texts[i], own)
                if done:
                    yield finished(done, batch.schema.field(2).type)

    def finished(done: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        edited = [mine[: len(mine) - len(mine) // 3] + after[: len(mine) // 3] for _, mine, _, after, _ in done]
        prints = [p for low, high in slices(edited) for p in anchor_lists(edited[low:high])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d[0] for d in done], key_type), pa.array([len(d[1]) for d in done], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array([written(d[2]) for d in done]), pa.array([written(p) for p in prints]),
                pa.array([likeness(d[2], p) for d, p in zip(done, prints, strict=True)]), pa.array([likeness(d[2], d[4]) for d in done]),
            ],
            ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return dealt.mapInArrow(work, f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
