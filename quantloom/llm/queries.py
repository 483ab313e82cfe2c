"""Registered queries of the text operators, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm import (
    divergence,
    imatch,
    mixing,
    odd_sketch,
    oracles,
    packing,
    periodic,
    refine,
    snapshots,
    spelling,
    token_counts,
    token_store,
    url_rules,
    winnow,
)
from quantloom.llm.common import read
from quantloom.sources.stage import stage_folder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

URL_RULES = [
    url_rules.ListRule("allow", "org/"),
    url_rules.ListRule("block", "example.org/es/"),
    url_rules.ListRule("block", "example.org/en/1"),
    url_rules.ListRule("allow", "com/fr/"),
    url_rules.ListRule("block", "com/de/"),
]


def op1_mixture_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read(spark, sf, "documents"), VOCABULARY)


def op2_token_store(spark: SparkSession, sf: str) -> DataFrame:
    out = f"{stage_folder(spark)}/token-store-{uuid.uuid4().hex}"
    token_store.write_store(read(spark, sf, "documents"), VOCABULARY, out)
    return token_store.read_documents(spark, out)


def op3_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    return url_rules.judge_urls(read(spark, sf, "pages"), URL_RULES)


def op4_divergence(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text", "lang")
    rows = divergence.judged(docs, divergence.fit_references(docs))
    return rows.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_js", 4).alias("char_js"), F.round("word_js", 4).alias("word_js"),
    )


def op5_entropy_mix(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.mixture_report(docs, mixing.fit_mixture(docs))


def op6_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.collapse_and_render(read(spark, sf, "conversations"))


def op7_winnow_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return winnow.dedup_lines(docs, report=True).select("doc_id", "lines_removed", F.col("text").alias("clean_text"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf, "documents"), VOCABULARY)


def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return refine.exact_duplicates(docs, carry=["text_sha256"])


def op10_odd_sketch(spark: SparkSession, sf: str) -> DataFrame:
    return odd_sketch.near_duplicates(read(spark, sf, "documents"))


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(read(spark, sf, "documents"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.periodic_runs(read(spark, sf, "documents"))


def op13_imatch(spark: SparkSession, sf: str) -> DataFrame:
    return imatch.fingerprint_report(read(spark, sf, "documents"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixture_packing, op2_token_store, op3_url_rules, op4_divergence, op5_entropy_mix, op6_snapshots, op7_winnow_lines,
        op8_token_counts, op9_exact_dedup, op10_odd_sketch, op11_spelling_variants, op12_periodic_runs, op13_imatch, pipeline,
    )
}
ORACLES: dict[str, str] = oracles.ORACLES
