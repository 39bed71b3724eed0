"""Registered queries of the training-data operators, and their SQL.

Every query applies its operator to the whole table with production parameters
and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, conversations, exact_dedup, fingerprints, jaccard_join, language, licenses, line_dedup, merkle, mixing, oracle,
               quality, substrings, suffix_dedup)
from .common import read

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer file; the package is on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = F.sha2(exact_dedup.normalised(F.col("text")), 256).alias("text_sha256")
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"), [F.col("doc_id"), sha]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(read(spark, sf_dir, "documents")).drop("row", "pieces")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read(spark, sf_dir, "documents"), tokenizer_path())


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = language.held_out(F.col("doc_id"), 3, 1)
    network = quality.fit(docs, read(spark, sf_dir, "labels"), ~held)
    return quality.score(docs.select("doc_id", "text"), network, ["doc_id"]).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = language.held_out(F.col("doc_id"), 4, 2)
    return language.predict(docs, language.fit(docs, ~held), held.alias("held_out"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(read(spark, sf_dir, "documents"), min_words=1).withColumn(
        "removed_lines", F.array_join("removed_lines", ","))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edited(read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(read(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(substrings.repeated_spans(read(spark, sf_dir, "documents")))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(read(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_license_scan, op2_exact_dedup, op3_mixing, op4_suffix_dedup, op5_bpe, op6_ngram_jaccard, op7_quality,
    op8_language_id, op9_line_dedup, op10_fingerprints, op11_merkle_manifest,
    op12_substring_dedup, op13_conversation_repair, pipeline)}

#: DuckDB SQL where it can express the result; the others are tested against
#: brute force, an exact round trip or held-out accuracy in tests/llm.
ORACLE = {
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t""",
    "op11_merkle_manifest": oracle.MERKLE,
    "op12_substring_dedup": oracle.SUBSTRINGS,
}
