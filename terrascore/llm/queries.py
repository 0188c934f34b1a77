"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from terrascore.llm import decontaminate, html_extract, langid, line_dedup, lm_scoring, merkle, minhash_join, mixing, oracles, quality_lines, secret_scan, toxicity, url_filter, whitening
from terrascore.llm.common import read_table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = lm_scoring.held_out()
    out = lm_scoring.score(docs, lm_scoring.train(docs.where(~held), order=lm_scoring.ORDER))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                      "score", "perplexity")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = langid.held_out()
    out = langid.identify(docs, langid.train(docs, ~held))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("source")


def op10_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lines.judge(read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return merkle.prove(merkle.manifest(docs, merkle.tampered()))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(read_table(spark, sf_dir, "embeddings"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_lm_scoring, op2_html_extraction, op3_minhash_near_dedup, op4_language_id, op5_url_filters, op6_decontamination, op7_toxicity, op8_line_dedup, op9_mixing, op10_quality_lines,
        op11_merkle_manifest, op12_secret_scan, op13_embedding_whitening)}


def llm_sql() -> dict[str, str]:
    return dict(oracles.SQL) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
