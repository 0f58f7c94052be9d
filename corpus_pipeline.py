"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Every stage works on all rows its predecessor kept; all but the last return the
columns of ``documents`` (n_chars follows the text). Nulls, empty and repeated
rows are handled as the operators state it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberflow.llm import common, line_dedup, ngram_join, packing, quality, suffix_dedup
from emberflow.session import ensure_checkpoint_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SEQUENCE = 1024
#: Words of a passage that may not stand in the corpus twice.
PASSAGE_WORDS = 51


def _kept(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs`` with all their columns, whatever further ones are called; n_chars follows the text."""
    def shaped(given: DataFrame) -> DataFrame:
        out = work(given)
        if "n_chars" in given.columns:
            out = out.withColumn("n_chars", F.length("text").cast(given.schema["n_chars"].dataType))
        return out.select(given.columns)
    return common.shielded(docs, ("doc_id", "text", "n_chars"), (), shaped)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 or more)."""
    common.ship_package(spark)
    model = quality.train(docs, common.table(spark, sf_dir, "labels"))
    return common.shielded(docs, ("doc_id", "text"), (), lambda d: quality.score(d, model).where("__predicted = 1").select(d.columns))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines similar to an earlier one; those left without a word go."""
    common.ship_package(spark)
    return _kept(docs, lambda d: line_dedup.remove_lines(d).where(r"__n_removed = 0 or text rlike '[^ \\t-\\r]'"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by five-word shingles at 0.8."""
    common.ship_package(spark)
    return ngram_join.drop_near_duplicates(docs, shingle=5, percent=80)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages of over 50 words, or of 400 bytes; those left without a word go."""
    common.ship_package(spark)

    def cut(given: DataFrame) -> DataFrame:
        out = suffix_dedup.remove_repeats(given, length=400, words=PASSAGE_WORDS)
        out = out.withColumn("text", F.when(F.col("__n_removed") > 0, F.col("__kept_text")).otherwise(F.col("text")))
        return out.where(r"__n_removed = 0 or text rlike '[^ \\t-\\r]'")

    return _kept(docs, cut)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, each with its sequence and place there."""
    common.ship_package(spark)
    pieces = packing.token_pieces(docs, TOKENIZER, length=SEQUENCE)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), length=SEQUENCE)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express the classifier; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what lies between them is in the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
    return docs
