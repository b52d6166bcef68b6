"""Readers of documents and job messages, and the markdown writer."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.sources.sinks import KeyedTable

JOB = "job_id string, user_id string, object_key string"


def text_folder(spark: SparkSession, path: str, user_id: str = "local") -> DataFrame:
    """``user_id, doc_id, source, markdown`` of the text files below a folder; the file name is the id."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    name = F.col("_metadata.file_name")
    return rows.select(F.lit(user_id).alias("user_id"), name.alias("doc_id"), name.alias("source"), F.col("value").alias("markdown"))


def first_files(spark: SparkSession, path: str) -> DataFrame:
    """The first file in name order of each folder, names that end in md apart."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter(~F.col("path").endswith("md"))
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return rows.groupBy(folder.alias("folder")).agg(F.min_by(F.struct("path", "content"), "path").alias("f")).select("folder", "f.path", "f.content")


def jobs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOB).json(path)


def write_markdown(md: DataFrame, path: str, version: int = 0) -> None:
    """Saves markdown texts, one row for each ``user_id, doc_id``; other documents stay, a saved one is replaced.

    The name of a saved document is its own with the ending ``md``.
    """
    name = F.concat(F.regexp_replace("doc_id", r"\.[^./]*$", ""), F.lit(".md"))
    KeyedTable(md.sparkSession, path, ["user_id", "doc_id"]).upsert(md.select("user_id", "doc_id", name.alias("file"), "markdown"), version)


def saved_markdown(spark: SparkSession, path: str) -> DataFrame:
    return KeyedTable(spark, path, ["user_id", "doc_id"]).current()


def input_error(md: DataFrame) -> Column:
    """The first thing that keeps a row from being ingested, or null."""
    return (
        F.when(F.coalesce("user_id", F.lit("")) == "", "user_id required").when(F.coalesce("doc_id", F.lit("")) == "", "doc_id required").when(~F.coalesce("markdown", F.lit("")).rlike(r"\S"), "empty document")
    )


_RULES = [
    (r"(?is)<(script|style|head)\b.*?</\1>", ""),
    (r"(?i)<h1[^>]*>\s*", "\n\n# "),
    (r"(?i)<h2[^>]*>\s*", "\n\n## "),
    (r"(?i)<h3[^>]*>\s*", "\n\n### "),
    (r"(?i)<li[^>]*>\s*", "\n- "),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</?(p|div|ul|ol|h[1-6]|section|article|body|html|nav|footer|header)[^>]*>", "\n\n"),
    (r"<[^>]+>", ""),
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&laquo;", "«"),
    ("&raquo;", "»"),
    ("&amp;", "&"),
    (r"[ \t]+\n", "\n"),
    (r"\n{3,}", "\n\n"),
]


def html_to_markdown(html: Column) -> Column:
    """Headings, items and paragraphs of a page as markdown; other marks go."""
    for pattern, put in _RULES:
        html = F.regexp_replace(html, pattern, put)
    return F.regexp_replace(html, r"^\s+|\s+$", "")


def duck_html_to_markdown(html: str) -> str:
    """The same in DuckDB SQL."""
    for pattern, put in _RULES:
        if "\\1" in pattern:  # no back-references there: one rule for each tag
            for tag in re.search(r"\((\w+\|.*?)\)", pattern)[1].split("|"):
                html = f"regexp_replace({html}, '(?is)<{tag}\\b.*?</{tag}>', '', 'g')"
            continue
        quoted = put.replace("'", "''").replace("\n", "'||chr(10)||'")
        html = f"regexp_replace({html}, '{pattern.replace(chr(39), chr(39) * 2)}', '{quoted}', 'g')"
    return f"regexp_replace({html}, '^\\s+|\\s+$', '', 'g')"
