"""Cases that went wrong before."""

import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gapweave.llm import common, language, line_dedup, nearest, pieces, quality, toxicity
from gapweave.llm.words import Words
from tests.llm.test_corpus import odd_rows

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def doubled(n):
    """Two words that every polynomial hash modulo 2**64 confuses from 2**10 letters on."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_regular_words_are_told_apart():
    words, library = Words.of(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    texts = [*doubled(10), *doubled(11), " ".join(doubled(10))]
    ids, sizes = words.encode(texts)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


def test_hash_without_one_code():
    codes = np.frombuffer("a line of text é中".encode("utf-32-le"), np.uint32)
    spans = common.SpanHash(codes)
    left = spans.without(np.arange(len(codes)))
    for i in range(len(codes)):
        whole = common.SpanHash(np.delete(codes, i))
        assert left[i] == whole.of(np.array([0]), np.array([len(codes) - 1]))[0]


def test_crowded_very_long_lines(spark):
    line = "".join(chr(97 + i * i % 23) for i in range(30_000))
    rows = [(i, line[: 100 * i] + "#" + line[100 * i + 1 :]) for i in range(line_dedup.PAIRED + 6)]
    kept = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("text <> ''").collect()
    # Each differs from another one in two places, so only equality or one edit would join them.
    assert len(kept) == len(rows)
    rows.append((1000, line))
    kept = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("text <> ''").collect()
    assert [r["doc_id"] for r in kept] == [0]


def test_unclosed_elements_take_linear_time():
    start = time.perf_counter()
    assert "word" in language.visible_text("<nav " * 200_000 + "> word")
    language.visible_text("<!-- " * 200_000 + "</nav>" * 100_000)
    assert time.perf_counter() - start < 20
    assert language.visible_text("a<!-- <nav> -->b<nav x>c</NAV >d<script>e").split() == ["a", "b", "d", "e"]


def test_vectors_of_another_length_take_no_part(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)] + [(100, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = nearest.neighbours(df, df.where("vec_id % 20 = 0"), k=5).collect()
    assert len(found) == 15 and all(100 not in (r["query_id"], r["vec_id"]) for r in found)


def test_other_kinds_of_piece_models_are_refused(monkeypatch):
    from sentencepiece import SentencePieceProcessor

    monkeypatch.setattr(SentencePieceProcessor, "get_score", lambda self, i: -0.37 * i)
    with pytest.raises(ValueError):
        pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_sample_takes_a_repeated_key_once(spark):
    docs = spark.createDataFrame([(i, f"good words stand here {i} and there") for i in range(40)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    many = docs.union(docs).union(docs)
    assert len(quality.fit(labels, many).labels) == 40
    assert toxicity.fit(labels, many) == toxicity.fit(labels, docs)


def test_batches_are_bounded():
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["x" * (common.BATCH_BYTES // 2)] * 9)], ["a", "b"])
    parts = list(common.bounded(iter([batch, batch.slice(0, 0)])))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(9))
    assert all(p.nbytes <= common.BATCH_BYTES or p.num_rows == 1 for p in parts)


def test_documents_without_lines_go(spark):
    line = "this is a long line that many documents share with each other"
    rows = [(0, line, 1, 9), (1, f"{line}\n\t\n{line}", 1, 9), (2, f"{line}\n \n{line}", 1, 9), (3, "", 1, 9), (4, None, 1, 9), (5, f"{line}\nown", 1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, removed_lines int, `a.b` int")
    kept = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(0, line), (3, ""), (4, None), (5, "own")]


def test_stages_of_odd_rows(spark):
    odd = odd_rows(spark)
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, odd, "/root/testdata/sf0.001")
        assert kept.columns == odd.columns, name
        assert kept.count() <= odd.count()


def test_quality_fit_holds_no_whole_matrix():
    """The sample's terms stay sparse on the driver, and blocks give the products of the whole matrix."""
    rng = np.random.default_rng(1)
    terms = [np.sort(rng.choice(quality.TERMS, 200, replace=False)).astype(np.int32) for _ in range(3000)]
    terms[7] = terms[7][:0]
    counts = [rng.integers(1, 9, len(t)).astype(np.float32) for t in terms]
    found = pa.table({"y": pa.array(rng.integers(0, 2, 3000), pa.int32()), "h": rng.permutation(3000), "terms": pa.array(terms, pa.list_(pa.int32())), "counts": pa.array(counts, pa.list_(pa.float32()))})
    tracemalloc.start()
    model = quality._fitted(found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3000 * quality.TERMS * 4 * 0.8, peak
    order = np.argsort(found["h"].to_numpy())
    dense = np.zeros((3000, quality.TERMS), np.float32)
    for i, j in enumerate(order):
        if len(terms[j]):
            dense[i, terms[j]] = np.sqrt(counts[j] / counts[j][terms[j] < quality._TRIGRAMS].sum()) * model.rarity[terms[j]]
    plain = dense @ model.axes
    norm = np.linalg.norm(plain, axis=1, keepdims=True)
    np.testing.assert_allclose(model.vectors, plain / np.where(norm > 0, norm, 1), atol=1e-5)
    assert not model.vectors[np.flatnonzero(order == 7)].any()
    np.testing.assert_allclose(model.axes.T @ model.axes, np.eye(quality.DIMENSIONS), atol=1e-4)
    assert model.labels.tolist() == found["y"].to_numpy()[order].tolist()


def test_tables_of_one_slice_are_small_and_end_with_the_task():
    codes = np.tile(np.frombuffer(b"some words of a long slice ", np.uint8), common.SLICE_CHARS // 27 + 5)
    common.SpanHash.forget()
    spans = common.SpanHash(codes)
    assert sum(len(t) * t.itemsize for t in common.SpanHash._powers) < 24 << 20
    far = len(codes) // 27 * 27 - 27
    assert spans.of(np.array([0]), np.array([10]))[0] == spans.of(np.array([far]), np.array([far + 10]))[0]
    assert spans.of(np.array([0]), np.array([far + 27]))[0] == common.SpanHash(codes[: far + 27]).of(np.array([0]), np.array([far + 27]))[0]
    assert list(common.bounded(iter([]))) == [] and not common.SpanHash._powers
