"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.llm import bpe, debruijn, exact_dedup, fingerprints, license_scan, mixing, ngram_join, perspectives, prefix_trie, style_tree, token_files, toxicity, vector_codes
from almoner.llm.common import table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op4_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extracted(table(spark, sf_dir, "pages"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents")).drop("detections")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.transcoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op10_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.perspectives(table(spark, sf_dir, "conversations"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op13_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = debruijn.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_toxicity": op2_toxicity,
    "op3_source_mix": op3_source_mix,
    "op4_style_tree": op4_style_tree,
    "op5_ngram_join": op5_ngram_join,
    "op6_license_scan": op6_license_scan,
    "op7_fingerprints": op7_fingerprints,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_perspectives": op10_perspectives,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_debruijn": op13_debruijn,
}

ORACLE = {
    "op10_perspectives": perspectives.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_vector_codes": vector_codes.sql(),
    "op13_debruijn": debruijn.SQL,
    "op9_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
               sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t
    """,
}
