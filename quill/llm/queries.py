"""Thin queries over the given tables, one for each operator, and the pipeline.

Each query applies its operator to its whole table and derives the columns the
contract names. ``oracles.SQL`` has DuckDB SQL for those that SQL can express;
the others (tokenisers, models, wrappers) are compared in tests/llm with a brute-force
version, a round trip or held-out accuracy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quill.llm import bpe_codec, embedding_dedup, fertility, html_wrapper, merkle, ngram_join, oracles, packing, ppm, quality_cnn, token_alignment, toxicity, warc_zip, wu_manber
from quill.llm.tables import crc32_mod, named


def op1_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = named(spark, sf_dir, "documents")
    model = toxicity.fit(docs, named(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (crc32_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(named(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(named(spark, sf_dir, "embeddings"))


def op4_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(named(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_held_out(named(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encoding_digests(named(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(named(spark, sf_dir, "documents"))


def op8_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = named(spark, sf_dir, "documents")
    weights = quality_cnn.fit(docs, named(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, weights).select(
        "doc_id", (crc32_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.archive(named(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judged(named(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "byte_share", "token_entropy")


def op11_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wu_manber.report(named(spark, sf_dir, "documents"), named(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(named(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(named(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_toxic_segments, op2_ngram_jaccard_join, op3_embedding_dedup, op4_html_wrapper, op5_ppm, op6_bpe_codec, op7_best_fit_packing, op8_quality_cnn, op9_warc_zip, op10_tokeniser_fertility,
                                  op11_wu_manber, op12_token_alignment, op13_merkle_manifest)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE: dict[str, str] = dict(oracles.SQL)
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
