"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text, one on toxic passages. A window of text is
compressed with the ordinary dictionary, and with the toxic one in front of it; the bytes that the toxic
dictionary saves are the window's evidence. A calibrated logistic threshold over a document's evidence
gives its score.

Labels mark whole documents, most of whose text is ordinary. So toxic passages are found first: words
that follow many different words in toxic documents and few in ordinary ones. Distinct neighbours, not
occurrences, are counted, so a group of copies counts once.

Cases: null text counts as empty; empty text has no evidence and gets the score of zero evidence; repeated rows are scored
alike; an empty table gives no rows; without labels of both classes every score is the share of toxic labels (0 if there are none)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from gapweave.llm.common import bounded, col, free_name, map_batches, plain_names, texts_of

#: Bounded sample of labelled rows that the classifier is fitted on: documents of each class, those with the lowest hash of their key.
MAX_TOXIC, MAX_ORDINARY = 3000, 6000
#: Bounds of the training text for the dictionaries: passages, and bytes of each dictionary.
MAX_PASSAGES, ORDINARY_BYTES, TOXIC_BYTES = 40_000, 65_536, 16_384
#: Bytes of a window and between two windows.
WINDOW, STEP = 64, 48
_MARKERS = 4096
_FEATURES = 4


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """The tables must index every position of the dictionary, else its front is forgotten. Matches of under five bytes save
    nothing and hide longer ones."""
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=17, hash_log=17, search_log=4, min_match=5, target_length=32, strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=words, compression_params=parameters)


def _windows(size: int) -> np.ndarray:
    """(start, length) of the windows of a text of so many bytes."""
    start = np.arange(0, max(size - WINDOW + STEP, 1), STEP, dtype=np.uint64)
    return np.stack([start, np.minimum(np.uint64(WINDOW), np.uint64(size) - start)], axis=1)


def evidence(texts: list[str], ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor, pad: bytes = b"") -> np.ndarray:
    """Per text: largest and second largest saving of a window, all savings above 2 bytes, and these per window (log scale)."""
    out = np.zeros((len(texts), _FEATURES))
    for i, text in enumerate(texts):
        data = text.encode()
        if not data:
            continue
        if len(data) < WINDOW:  # else a short block that hardly shrinks is stored as it is by both
            data += pad
        gain = np.zeros(0, np.int64)
        # A long text is cut into runs of windows, so memory stays bounded.
        for at in range(0, len(data), STEP * 20_000):
            part = data[at : at + STEP * 20_000 + WINDOW - STEP]
            if at and len(part) <= WINDOW - STEP:
                break
            cuts = _windows(len(part)).tobytes()
            sizes = [
                np.fromiter((len(x) for x in c.multi_compress_to_buffer(zstandard.BufferWithSegments(part, cuts))), np.int64)
                for c in (ordinary, toxic)
            ]
            gain = np.append(gain, sizes[0] - sizes[1])
        top = np.sort(gain)[-2:][::-1]
        rest = np.maximum(gain - 2, 0).sum()
        out[i] = (top[0], top[1] if len(top) > 1 else 0, np.log1p(rest), np.log1p(100 * rest / len(gain)))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps for a weighted ridge logistic regression; the first column is the constant."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty @ w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        w = w + np.linalg.solve(hessian, gradient)
    return w


def _markers(words: DataFrame) -> list[str]:
    """Words with many distinct left neighbours in toxic documents, and far fewer in ordinary ones."""
    pairs = words.select("toxic", F.explode(F.expr("zip_with(slice(w, 1, size(w) - 1), slice(w, 2, size(w)), (a, b) -> struct(a, b))")).alias("p"))
    counts = (
        pairs.select("toxic", "p.a", "p.b").distinct().groupBy("b")
        .agg(F.sum(F.col("toxic").cast("double")).alias("t"), F.sum(1.0 - F.col("toxic")).alias("o"))
    )
    sure = F.col("t") - 3 * F.sqrt("t") - 3 * MAX_TOXIC / MAX_ORDINARY * (F.col("o") + 1)
    return [r[0] for r in counts.where(sure > 0).orderBy(F.desc(sure), "b").limit(_MARKERS).select("b").collect()]


def fit(labels: DataFrame, docs: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> ToxicityModel:
    """Model from labels (one row per key; label 0 or 1, others are left out) and the texts they belong to: two thirds of the
    bounded sample give the dictionaries, the rest the calibration, weighted back to the class shares of all labels."""
    rows = labels.where(col(label).isin(0, 1)).select(col(key).cast("string").alias("k"), col(label).cast("int").alias("toxic"))
    rows = rows.withColumn("h", F.xxhash64("k"))
    counts = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = counts.get(1, 0) / max(total, 1)
        bias = 30.0 if share == 1 else -30.0
        return ToxicityModel(b"ordinary", b"toxic", (bias, *[0.0] * _FEATURES), (0.0,) * _FEATURES, (1.0,) * _FEATURES)
    picked = [rows.where(F.col("toxic") == c).orderBy("h", "k").limit(n) for c, n in ((1, MAX_TOXIC), (0, MAX_ORDINARY))]
    chosen = picked[0].union(picked[1])
    texts = docs.select(col(key).cast("string").alias("k"), col(text).alias("text"))
    # One text a key: repeated rows of the sample stay where they are.
    sample = texts.join(F.broadcast(chosen), "k").groupBy("k", "toxic", "h").agg(F.min("text").alias("text")).withColumn("part", F.pmod(F.col("h"), F.lit(3)))
    own = sample.where("part < 2")
    words = own.select("toxic", F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+").alias("w")).where("size(w) > 1")
    markers = frozenset(_markers(words))

    def passages(batch: pa.RecordBatch):
        import regex
        import xxhash

        word = regex.compile(r"[\p{L}\p{N}]+")
        kinds, found, marks = [], [], []
        for string, toxic in zip(texts_of(batch), batch.column("toxic").to_pylist(), strict=True):
            if toxic:
                hits = [m.span() for m in word.finditer(string) if m.group().lower() in markers]
                parts = [string[max(0, a - 1) : b + 1] for a, b in hits]
            else:
                data = string.encode()
                parts = [data[a : a + n].decode(errors="ignore") for a, n in _windows(len(data)).astype(int)[::5]]
            found += parts
            kinds += [toxic] * len(parts)
            marks += [xxhash.xxh3_64_intdigest(x) >> 1 for x in parts]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(found, pa.string()), pa.array(marks, pa.int64())], ["toxic", "part", "mark"])

    parts = map_batches(own.select("text", "toxic"), passages, "toxic int, part string, mark long")
    text_of = {c: [r[0].encode() for r in parts.where(F.col("toxic") == c).orderBy("mark", "part").limit(MAX_PASSAGES).select("part").collect()] for c in (0, 1)}
    ordinary = _trained(ORDINARY_BYTES, text_of[0], 1)
    toxic = _trained(TOXIC_BYTES, text_of[1], 4)
    held = score_rows(sample.where("part = 2").select("text", "toxic"), ToxicityModel(ordinary, toxic, (), (), ()), "toxic").collect()
    x = np.array([r["evidence"] for r in held], float).reshape(-1, _FEATURES)
    y = np.array([r["toxic"] for r in held], float)
    if len(set(y)) < 2:
        share = counts[1] / total
        return ToxicityModel(ordinary, toxic, (float(np.log(share / (1 - share))), *[0.0] * _FEATURES), (0.0,) * _FEATURES, (1.0,) * _FEATURES)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum()) * len(y) / total
    w = _logistic(np.column_stack([np.ones(len(x)), (x - mean) / scale]), y, weight)
    return ToxicityModel(ordinary, toxic, tuple(w), tuple(mean), tuple(scale))


def _trained(size: int, parts: list[bytes], joined: int) -> bytes:
    """A trained dictionary; where there is too little text to train on, the text itself. The trainer picks from
    stretches of its samples in turn, so equal passages must not stand together."""
    parts = [parts[i] for i in np.random.default_rng(0).permutation(len(parts))]
    samples = [b"".join(parts[i : i + joined]) for i in range(0, len(parts), joined)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:].ljust(8, b" ")


def score_rows(df: DataFrame, model: ToxicityModel, *kept: str, text: str = "text") -> DataFrame:
    """Rows (kept columns, evidence array, score) of every row of ``df``; a name that a kept column has is numbered."""
    names = list(kept)
    own, proof, value = (free_name(n, names) for n in ("__text", "evidence", "score"))
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = "".join(f"`{n}` {types[n]}, " for n in names) + f"{proof} array<double>, {value} double"
    wanted = df.select(*[col(n) for n in names], col(text).alias(own))

    def work(batches):
        ordinary, toxic = _compressor(model.ordinary), _compressor(model.toxic + model.ordinary)
        w, mean, scale = (np.array(v) for v in (model.weights, model.mean, model.scale))
        for batch in bounded(batches):
            x = evidence(texts_of(batch, own), ordinary, toxic, model.ordinary[-WINDOW:])
            logit = w[0] + ((x - mean) / scale) @ w[1:] if len(w) else np.zeros(len(x))
            arrays = [batch.column(i) for i in range(len(names))]
            score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(x), pa.list_(pa.float64())), pa.array(score)], [*names, proof, value])

    return plain_names(wanted).mapInArrow(work, schema)


def reject_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, all columns kept."""
    names = docs.columns
    return score_rows(docs, model, *names, text=text).where(F.col(free_name("score", names)) < threshold).select(*[col(n) for n in names])
