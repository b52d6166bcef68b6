"""The corpus pipeline: ``STAGES`` applied to ``documents`` one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns
of ``documents``.  A stage's result is written as Parquet in the shared folder and read as the next
one's ``docs``.

Defined cases, for every stage: a null text is an empty one (and stays null where the stage keeps the row); null ids are
kept as documents of their own and tested by their texts; rows equal in id and text get equal verdicts; texts of any
length are read whole; other columns, whatever their names, are passed on; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm._store import materialize, packed, unpacked
from chunkloom.llm.decontaminate import leaks
from chunkloom.llm.line_dedup import line_dedup
from chunkloom.llm.mixing import mix
from chunkloom.llm.simhash_dedup import simhash_classes
from chunkloom.llm.toxicity import fold, toxicity

#: SQL cannot express learning or sampling; the stages are tested against plain versions.
ORACLE_SQL = None


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents whose (doc_id, text) is not among ``gone(doc_id, th)``; rows equal in both go or stay together."""
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    hashed = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    on = docs["doc_id"].cast("long").eqNullSafe(gone["_id"]) & (hashed == gone["_th"])
    return docs.join(gone, on, "left_anti")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents scored 0.5 or more; learns from the labels outside the held-out fold (without any, nothing is rejected)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold(F.col("doc_id")) != 0)
    return unpacked(toxicity(packed(docs), labels).filter("score < 0.5"), docs)


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later near-duplicate lines; every document stays, if without words.  ``n_chars`` follows the text, 0 for null."""
    out = line_dedup(packed(docs))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return unpacked(out, docs, text=text, n_chars=F.coalesce(F.length(text).cast("long"), F.lit(0).cast("long")))


def simhash_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class: that of least id, of equal ids that of least text hash.

    The classes are op8's: shingles of 4 words, at most 4 bits apart.  Near copies below a similarity of about
    0.95 are often further apart and stay (see the README).
    """
    classes = simhash_classes(docs)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    keep = classes.groupBy("root").agg(F.min(rank).alias("r")).select("r.none", "r.doc_id", "r.th")
    keep = keep.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("none").alias("_none"), F.col("th").alias("_th"))
    rows = packed(docs)
    rows = rows.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_none": F.col("doc_id").isNull(), "_th": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    keys = ["_id", "_none", "_th"]
    return unpacked(rows.join(keep, keys, "left_semi").dropDuplicates(keys), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return _without(docs, leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: which documents it takes, how many times, and their words."""
    out = mix(docs).filter("copies > 0")
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_filter),
    ("simhash_near_dedup", simhash_filter),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
