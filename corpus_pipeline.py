"""A corpus pipeline: each stage gets the documents that the stage before it kept, as Parquet.

``run`` applies all stages to the documents of a directory of tables. All stages but the last return the columns of
documents; the last one returns the piece ids that training reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import decontamination, pieces, quality, simhash, substrings
from changeflow.llm.common import fresh_name, load, stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is at least one half; the classifier learns from the labels of the documents given."""
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    return docs.where(quality.score(F.col("text"), model) >= 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of 4-word shingles at most 4 bits apart."""
    return simhash.deduplicate(docs, shingle=4, max_bits=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the words of 13-word windows that an earlier document has. A text that loses
    words has its other words joined by a space; other texts stay as they are."""
    spans, cut = fresh_name(docs, "spans", "cut")
    found = substrings.with_spans(docs, "doc_id", "text", spans)
    found = found.withColumn(cut, substrings.cut(F.col("text"), F.col(spans)))
    found = found.withColumn("text", F.coalesce(F.col(f"{cut}.kept"), F.col("text")))
    changed = F.when(F.col(f"{cut}.n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that is like a benchmark item."""
    return decontamination.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of a sampled segmentation of each text, and whether they decode to it."""
    # Workers that have run the stages before hold memory of theirs.
    options = {"keep": ["doc_id", "lang", "source"], "check": "lossless", "chunk_chars": 1_200_000}
    encoded = pieces.encode(docs, pieces.model_path(), **options)
    return encoded.withColumn("n_pieces", F.size("ids").cast("bigint"))


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("sentencepiece encoding", encode_pieces),
]
# Scores, fingerprints and sampled segmentations can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir))
    return docs
