"""The corpus operators over the given tables, one query each, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gapweave.llm import fingerprints, hard_negatives, language, line_dedup, near_dedup, nearest, packing, pieces, quality, spellings, suffixes, token_counts, toxicity
from gapweave.llm.common import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(parts: int):
    return F.crc32(F.col("doc_id").cast("string")) % parts


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    """Fitted on the rows of ``labels`` outside the fold that is held out."""
    labels = _table(spark, sf_dir, "labels").where(_remainder(5) != 0).select("doc_id", "toxic").dropDuplicates(["doc_id"])
    return toxicity.fit(labels, _table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_rows(_table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir), "doc_id")
    return scored.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def quality_model(spark: SparkSession, sf_dir: str) -> quality.QualityModel:
    """Fitted on the rows of ``labels`` outside the fold that is held out."""
    labels = _table(spark, sf_dir, "labels").where(_remainder(3) != 1).select("doc_id", "quality").dropDuplicates(["doc_id"])
    return quality.fit(labels, _table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_rows(_table(spark, sf_dir, "documents"), quality_model(spark, sf_dir), "doc_id")
    return scored.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document: the lowest doc_id of its near-duplicates, and their number."""
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), F.col("class_key").alias("class_id"), "class_size", (F.col("row") == F.col("class_row")).alias("kept"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its duplicate lines."""
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "removed_lines", F.sha2("text", 256).alias("kept_sha256"), F.length("text").cast("long").alias("kept_chars"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumnRenamed("key", "doc_id")


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and whether they decode to its text."""
    rows = pieces.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(F.col("key").alias("doc_id"), F.size("pieces").cast("long").alias("n_pieces"), "pieces", F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.fit(_table(spark, sf_dir, "documents"))
    return language.identify(_table(spark, sf_dir, "pages"), model).withColumnRenamed("key", "page_id")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared_with_next(_table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.select(F.col("key").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest.neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, with some labels moved on by one."""
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("id") % 50 == 0)


def op12_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of passages that also start earlier."""
    kept = suffixes.drop_repeats(_table(spark, sf_dir, "documents"))
    return kept.select(F.col("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_pieces": op1_pieces,
    "op2_quality": op2_quality,
    "op3_near_dedup": op3_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_language": op6_language,
    "op7_packing": op7_packing,
    "op8_fingerprints": op8_fingerprints,
    "op9_token_counts": op9_token_counts,
    "op10_nearest": op10_nearest,
    "op11_negatives": op11_negatives,
    "op12_spellings": op12_spellings,
    "op13_repeats": op13_repeats,
}

#: Only operators that SQL can express on whole tables.
ORACLES: dict[str, str] = {}
