"""The registered queries of this subpackage: thin digests over its operators."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import align, html_text, jaccard, lines, merkle, novelty, packing, preference, ring, rules, substrings, templates, wavelet
from faultline.llm.common import read_table


def op1_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    shards = wavelet.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return wavelet.read_documents(shards).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "seq")


def op2_template_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_chunks(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", F.col("__n_removed").alias("n_removed"), "text")


def op4_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.format_conversations(read_table(spark, sf_dir, "conversations"))


def op6_count_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.assign(read_table(spark, sf_dir, "documents"))


def op8_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op9_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(read_table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op10_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read_table(spark, sf_dir, "documents"), ["doc_id"])


def op11_arrow_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return align.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_zstd_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return novelty.scan(read_table(spark, sf_dir, "documents"))


def op13_butterfly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(merkle.document_leaves(read_table(spark, sf_dir, "documents"))).withColumnRenamed("key", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_wavelet_shards, op2_template_matches, op3_line_chunks, op4_residual_packing, op5_preference_pairs, op6_count_vector_join,
    op7_bounded_ring, op8_text_density, op9_suffix_tree_dedup, op10_adaptive_rules,
    op11_arrow_alignment, op12_zstd_novelty, op13_butterfly_manifest)}

ORACLES: dict[str, str] = {
    "op3_line_chunks": lines.RUNS_SQL.format(docs="documents") + """
SELECT d.doc_id, coalesce(k.n_removed, 0) AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE k.body END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op5_preference_pairs": preference.SQL,
}
