"""The pipeline's rows, rebuilt stage by stage in plain Python from the same fitted models."""

import collections

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from gapweave.llm import line_dedup, near_dedup, quality, queries, toxicity
from tests.llm.test_corpus import check_packed, roots_of

SF = "/root/testdata/sf0.001"


def without_toxic(spark, rows):
    model = queries.toxicity_model(spark, SF)
    compressors = toxicity._compressor(model.ordinary), toxicity._compressor(model.toxic + model.ordinary)
    x = toxicity.evidence([t for _, t in rows], *compressors, model.ordinary[-toxicity.WINDOW :])
    logit = model.weights[0] + ((x - model.mean) / model.scale) @ np.array(model.weights[1:])
    return [r for r, z in zip(rows, logit, strict=True) if z < 0]


def without_poor(spark, rows):
    model = queries.quality_model(spark, SF)
    vectors = quality._features([t for _, t in rows], model.rarity, model.axes)
    return [r for r, s in zip(rows, quality.vote(vectors, model, float(model.labels.mean())), strict=True) if s >= 0.5]


def without_repeated_lines(rows):
    places = collections.defaultdict(list)
    for doc, text in rows:
        for n, line in enumerate(text.split("\n")):
            line = line_dedup.normalised(line)
            if len(line) >= line_dedup.MIN_CHARS:
                places[line].append((doc, n))
    long = sorted((x for x in places if len(x) >= line_dedup.NEAR_CHARS), key=len)
    pairs = []
    for i, x in enumerate(long):
        for y in long[i + 1 :]:
            if len(y) > len(x) + 1:
                break
            pairs.append((x, y))
    near = line_dedup.within([a for a, _ in pairs], [b for _, b in pairs], 1)
    root = roots_of([p for p, n in zip(pairs, near, strict=True) if n])
    classes = collections.defaultdict(list)
    for line, found in places.items():
        classes[root.get(line, line)] += found
    gone = {p for c in classes.values() for p in sorted(c)[1:]}
    out = []
    for doc, text in rows:
        lines = text.split("\n")
        kept = [x for n, x in enumerate(lines) if (doc, n) not in gone]
        if len(kept) == len(lines) or "\n".join(kept).strip(" "):
            out.append((doc, "\n".join(kept)))
    return out


def without_near_duplicates(rows):
    owner, shingles, weights = near_dedup.bags([t for _, t in rows])
    cut = np.searchsorted(owner, np.arange(len(rows) + 1))
    bags = [(shingles[a:b], weights[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if near_dedup.likeness(*bags[i], *bags[j]) >= 0.8]
    root = roots_of(links)
    return [r for r in rows if root.get(r[0], r[0]) == r[0]]


def test_rows_of_the_pipeline(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "lines", "near-duplicates", "packing"]
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    left = without_near_duplicates(without_repeated_lines(without_poor(spark, without_toxic(spark, rows))))
    packed = corpus_pipeline.run(spark, SF).withColumnRenamed("doc_id", "key").collect()
    assert {r["key"] for r in packed} == {d for d, _ in left}
    assert 0 < len(left) < len(rows)
    check_packed(packed, dict(left))


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, docs, SF)
        assert kept.dtypes == docs.dtypes, name
        path = str(tmp_path / name)
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs.limit(0), SF).count() == 0
