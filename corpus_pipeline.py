"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, packing.

Every stage takes all its predecessor kept (``documents`` first) and returns the columns of
documents, but for the last, which returns the packed pieces.

Cases: documents with a null, empty or too short text fail the quality rules; rows with a null
doc_id pass line dedup, near duplicates and decontamination as they are; null language and
source are groups of their own; empty tables give empty tables; further columns are kept up
to the packing."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import jaccard, lines, packing, rules, templates
from faultline.llm.common import read_table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their language's and source's thresholds reject go."""
    return rules.keep_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of two or more lines go; documents of which nothing stays go as well."""
    cut = lines.dedup_chunks(docs).drop("__n_removed")
    return cut.withColumn("n_chars", F.length("text").cast("long")).where("text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the smallest doc_id stays. Rows without a doc_id
    can't be named by a link and stay; rows of one doc_id stay or go together."""
    found = jaccard.near_duplicates(docs)
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("__gone_id"))
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone_id"), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return templates.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 ids."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing_stage)]

#: tokens, shingle links and quantile thresholds have no SQL; the stages are tested by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
