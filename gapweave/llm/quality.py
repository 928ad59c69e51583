"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of terms: hashed trigrams of characters (letters by group, capitals, digits, marks) and a few
relations between neighbouring words (repeated word, equal ending, capitals). Damped counts, weighted by rarity, are
reduced by a truncated singular value decomposition of a bounded sample of labelled rows. The sample's vectors are
broadcast; every text is compared with all of them in exact blocked cosine products, and its nearest neighbours vote
with their similarity as weight.

Cases: null text counts as empty; an empty text has the zero vector, whose neighbours all have similarity 0 and vote
equally, so it gets the share of label 1 in the sample; repeated rows are scored alike; ties of similarity go to the lower position in the
sample (ordered by hash); an empty table gives no rows; without labels every score is 0.5."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from gapweave.llm.common import col, free_name, map_batches, release, texts_of

#: Bounded sample of labelled rows the classifier is fitted on, half of each class at most: those with the lowest hash of their key.
MAX_SAMPLE = 4000
#: Latent dimensions and voting neighbours.
DIMENSIONS, NEIGHBOURS = 48, 15
#: Rows of one product block.
BLOCK = 512
#: Bytes of a text counted at once.
_PART = 1 << 20
_CLASSES = 24
_TRIGRAMS = _CLASSES**3
_RELATIONS = 8
TERMS = _TRIGRAMS + _RELATIONS


def _class_table() -> np.ndarray:
    """Group of each byte: letters in seven groups, capitals, digits, white space, usual and unusual marks, bytes beyond ASCII."""
    table = np.full(256, 23, np.uint8)
    table[128:192], table[192:] = 21, 22
    for i, c in enumerate(b"abcdefghijklmnopqrstuvwxyz"):
        table[c] = i % 7
    table[ord("A") : ord("Z") + 1] = 7
    table[ord("0") : ord("9") + 1] = 8
    for i, group in enumerate((b" ", b"\n\r", b"\t", b".", b",", b"!?", b"'\"", b"-_", b"()[]{}<>", b"/\\|:", b";@", b"*#%&$^~+=")):
        for c in group:
            table[c] = 9 + i
    return table


_TABLE = _class_table()


@dataclass(frozen=True)
class QualityModel:
    rarity: np.ndarray  # weight of each term
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # sample x dimensions, of unit length
    labels: np.ndarray


def term_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(terms, counts) of one text; long texts are counted part by part."""
    total = np.zeros(TERMS)
    for at in range(0, len(data), _PART):
        raw = np.frombuffer(data[at : at + _PART], np.uint8)
        kind = _TABLE[raw].astype(np.int32)
        if len(kind) > 2:
            total[:_TRIGRAMS] += np.bincount((kind[:-2] * _CLASSES + kind[1:-1]) * _CLASSES + kind[2:], minlength=_TRIGRAMS)
        words = data[at : at + _PART].split()
        if words:
            before = words[:-1]
            relations = (
                len(words),
                sum(a == b for a, b in zip(before, words[1:], strict=True)),
                len(words) - len(set(words)),
                sum(a[-2:] == b[-2:] for a, b in zip(before, words[1:], strict=True)),
                sum(w.isupper() for w in words),
                sum(w.isdigit() for w in words),
                sum(not w[-1:].isalnum() and w[-1] < 128 for w in words),
                sum(len(w) > 24 for w in words),
            )
            total[_TRIGRAMS:] += relations
    terms = np.flatnonzero(total)
    return terms, total[terms]


def _features(texts: list[str], rarity: np.ndarray | None, axes: np.ndarray) -> np.ndarray:
    """Unit vectors of texts; zero for texts without terms. Rates per word, damped, so length matters little."""
    out = np.zeros((len(texts), axes.shape[1]), np.float32)
    for i, text in enumerate(texts):
        terms, counts = term_counts(text.encode())
        if len(terms):
            weight = np.sqrt(counts / counts[terms < _TRIGRAMS].sum()) if (terms < _TRIGRAMS).any() else np.sqrt(counts / counts.sum())
            out[i] = (weight * (rarity[terms] if rarity is not None else 1.0)).astype(np.float32) @ axes[terms]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def fit(labels: DataFrame, docs: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id") -> QualityModel:
    """Model from labels (one row per key; label 0 or 1, others are left out) and the texts they belong to."""
    rows = labels.where(col(label).isin(0, 1)).select(col(key).cast("string").alias("k"), col(label).cast("int").alias("y")).withColumn("h", F.xxhash64("k"))
    chosen = None
    for c in (0, 1):
        some = rows.where(F.col("y") == c).orderBy("h", "k").limit(MAX_SAMPLE // 2)
        chosen = some if chosen is None else chosen.union(some)
    sample = docs.select(col(key).cast("string").alias("k"), col(text).alias("text")).join(F.broadcast(chosen), "k")
    # One text a key: repeated rows of the sample stay where they are.
    sample = sample.groupBy("k", "y", "h").agg(F.min("text").alias("text")).select("y", "h", "text")

    def count(batch: pa.RecordBatch):
        pairs = [term_counts(t.encode()) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([p[0].astype(np.int32) for p in pairs], pa.list_(pa.int32())), pa.array([p[1].astype(np.float32) for p in pairs], pa.list_(pa.float32()))],
            ["y", "h", "terms", "counts"],
        )

    # Term counts, not texts, come to the driver: at most MAX_SAMPLE rows of at most TERMS entries, as arrays and not as objects.
    found = map_batches(sample, count, "y int, h long, terms array<int>, counts array<float>").toArrow()
    model = _fitted(found)
    del found
    release()
    return model


def _fitted(found: pa.Table) -> QualityModel:
    """Model of rows (y, h, terms, counts), in the order of h."""
    if not found.num_rows:
        return QualityModel(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    found = found.take(pa.array(np.argsort(found["h"].to_numpy(), kind="stable")))
    each = pc.list_value_length(found["terms"]).to_numpy().astype(np.int64)
    terms, values = pc.list_flatten(found["terms"]).to_numpy(), np.array(pc.list_flatten(found["counts"]).to_numpy())
    for end, n in zip(np.cumsum(each).tolist(), each.tolist(), strict=True):
        if n:
            counts = values[end - n : end]
            whole = counts[terms[end - n : end] < _TRIGRAMS].sum() or counts.sum()
            values[end - n : end] = np.sqrt(counts / whole)
    present = np.bincount(terms, minlength=TERMS)
    rarity = np.log((1 + found.num_rows) / (1 + present)).astype(np.float32) + 1
    values *= rarity[terms]
    matrix = _Sparse(np.repeat(np.arange(found.num_rows, dtype=np.int32), each), terms, values, (found.num_rows, TERMS))
    axes = _axes(matrix, min(DIMENSIONS, found.num_rows))
    vectors = matrix.times(axes)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return QualityModel(rarity, axes, (vectors / np.where(norm > 0, norm, 1)).astype(np.float32), found["y"].to_numpy().astype(float))


class _Sparse:
    """A matrix most of which is zero. Products are taken over dense blocks of its rows or columns, so it never stands in memory as a whole;
    every sum runs over all of its terms in one block."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, values: np.ndarray, shape: tuple[int, int]):
        order = np.argsort(terms, kind="stable")
        self.shape = shape
        self._by_row, self._by_term = (rows, terms, values), (terms[order], rows[order], values[order])

    @staticmethod
    def _product(entries: tuple[np.ndarray, ...], size: int, x: np.ndarray) -> np.ndarray:
        line, at, value = entries
        out = np.empty((size, x.shape[1]), np.float32)
        for low in range(0, size, BLOCK):
            first, last = np.searchsorted(line, [low, low + BLOCK])
            block = np.zeros((min(BLOCK, size - low), len(x)), np.float32)
            block[line[first:last] - low, at[first:last]] = value[first:last]
            out[low : low + BLOCK] = block @ x
        return out

    def times(self, x: np.ndarray) -> np.ndarray:
        return self._product(self._by_row, self.shape[0], x)

    def turned_times(self, x: np.ndarray) -> np.ndarray:
        return self._product(self._by_term, self.shape[1], x)


def _axes(matrix: _Sparse, k: int) -> np.ndarray:
    """Leading right singular vectors by randomised subspace iteration with a fixed seed."""
    q = np.linalg.qr(matrix.times(np.random.default_rng(0).standard_normal((matrix.shape[1], k + 8)).astype(np.float32)))[0]
    for _ in range(4):
        q = np.linalg.qr(matrix.times(np.linalg.qr(matrix.turned_times(q))[0]))[0]
    _, _, v = np.linalg.svd(matrix.turned_times(q).T, full_matrices=False)
    return np.ascontiguousarray(v[:k].T, dtype=np.float32)


def vote(vectors: np.ndarray, model: QualityModel, base: float) -> np.ndarray:
    """Exact cosine products block by block; weighted share of label 1 among the nearest, drawn a little to ``base``."""
    k = min(NEIGHBOURS, len(model.labels))
    if not k:
        return np.full(len(vectors), 0.5)
    out = np.empty(len(vectors))
    for at in range(0, len(vectors), BLOCK):
        near = vectors[at : at + BLOCK] @ model.vectors.T
        # Single-precision products differ by more than all of these steps, which only settle ties by position.
        ranked = np.arange(near.shape[1]) * 1e-12 - near
        order = np.argpartition(ranked, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.tile(np.arange(k), (len(near), 1))
        weight = np.maximum(np.take_along_axis(near, order, 1), 0).astype(float) ** 8
        out[at : at + BLOCK] = ((weight * model.labels[order]).sum(1) + 1e-3 * base) / (weight.sum(1) + 1e-3)
    return np.clip(out, 0, 1)


def score_rows(df: DataFrame, model: QualityModel, *kept: str, text: str = "text") -> DataFrame:
    """Rows (kept columns, score) of every row of ``df``; a name that a kept column has is numbered. The broadcast model has TERMS x DIMENSIONS and MAX_SAMPLE x DIMENSIONS numbers at most."""
    names = list(kept)
    own, value = (free_name(n, names) for n in ("__text", "score"))
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    shared = df.sparkSession.sparkContext.broadcast(model)
    base = float(model.labels.mean()) if len(model.labels) else 0.5

    def work(batch: pa.RecordBatch):
        known = shared.value
        score = vote(_features(texts_of(batch, own), known.rarity, known.axes), known, base)
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(score)], [*names, value])

    wanted = df.select(*[col(n) for n in names], col(text).alias(own))
    return map_batches(wanted, work, "".join(f"`{n}` {types[n]}, " for n in names) + f"{value} double")


def reject_poor(docs: DataFrame, model: QualityModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all columns kept."""
    names = docs.columns
    return score_rows(docs, model, *names, text=text).where(F.col(free_name("score", names)) >= threshold).select(*[col(n) for n in names])
