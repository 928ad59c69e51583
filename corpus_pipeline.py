"""A training-data pipeline over ``documents``: toxicity, quality, line dedup, near-duplicates, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gapweave.llm import line_dedup, near_dedup, packing, quality, queries, toxicity
from gapweave.llm.common import col, free_name, ship
from gapweave.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject. Null and empty texts have no evidence and stay, repeated rows are judged
    alike, all columns are kept; no rows give none."""
    return toxicity.reject_toxic(docs, queries.toxicity_model(spark, sf_dir))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches one half. Null and empty texts score the share of good labels in the sample, repeated
    rows are judged alike, all columns are kept; no rows give none."""
    return quality.reject_poor(docs, queries.quality_model(spark, sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without lines that an earlier one holds; one that is left with nothing but white space after losing lines goes.

    Null and empty texts lose nothing and stay; of equal lines the first by (doc_id, text hash, line) stays; ``n_chars`` is counted
    anew where there is such a column; other columns are kept whatever their names."""
    ship(spark)
    kept = line_dedup.dedup_lines(docs)
    left = kept.where(col(free_name("removed_lines", docs.columns)).isNull() | F.col("text").rlike(r"[^\s\p{Z}]"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*[col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates, by doc_id and then text hash. Null and empty texts are copies of each other, of
    rows equal in doc_id and text one stays, all columns are kept; no rows give none."""
    ship(spark)
    return near_dedup.drop_near_duplicates(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens. Null and empty texts have their end token alone; no rows give none."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("key", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("lines", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Compression, neighbours and packing have no SQL form: the tests rebuild the rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each stage's rows are written and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
