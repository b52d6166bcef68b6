"""The queries of this subpackage: one thin ``opN_<name>`` for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm import pii as personal
from chunkloom.llm import secrets as secret
from chunkloom.llm.decontaminate import leaks
from chunkloom.llm.line_dedup import line_dedup
from chunkloom.llm.mixing import mix
from chunkloom.llm.quality import quality
from chunkloom.llm.simhash_dedup import simhash_classes
from chunkloom.llm.substring_dedup import substring_dedup
from chunkloom.llm.suffix_model import suffix_scores
from chunkloom.llm.toxicity import fold, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret.secrets(_documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, secret.KINDS), "base_sha256", secret.span_text(F.col("base"), F.col("random")).alias("spans"), F.size("random").alias("n_random"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = personal.pii(_documents(spark, sf_dir))
    base = ("email", "ip", "card", "phone")
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(personal.span_text(*map(F.col, base)), 256).alias("base_sha256")
    best = F.array_max(F.transform(F.concat(*personal.KINDS), lambda s: s["score"])).alias("best_score")
    return out.select("doc_id", *counts, digest, personal.span_text(*map(F.col, personal.KINDS)).alias("spans"), F.size("iban").cast("long").alias("n_iban"), best)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = toxicity(docs.select("doc_id", "text"), labels.filter(fold(F.col("doc_id")) != 0))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", F.size("offending").alias("n_offending"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return leaks(_documents(spark, sf_dir), items).select("doc_id", "item_id", "item_shingles", "shared", "containment")


def op6_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_scores(_documents(spark, sf_dir), fold(F.col("doc_id")) != 1)
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("spans").alias("n_spans"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_classes(_documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = quality(_documents(spark, sf_dir), names)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", *names, failed.alias("base_failed"), "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op2_secret_scan": op2_secret_scan,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_suffix_tree_scores": op6_suffix_tree_scores,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_cube_mixing": op9_cube_mixing,
}
