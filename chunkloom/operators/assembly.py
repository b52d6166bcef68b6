"""Chunks of a document's windows as one linked sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions import text as T
from chunkloom.functions.tokens import TokenCounter, chars4
from chunkloom.operators import links
from chunkloom.operators.splitter import rule_split
from chunkloom.sources.shared import stored


def oversized_chunks(window_rows: DataFrame) -> DataFrame:
    """One chunk for each oversized window, titled by its last open heading."""
    title = F.coalesce(F.element_at(F.when(F.size("leading_heading_path") > 0, F.col("leading_heading_path")), -1), F.lit("Oversized block"))
    return window_rows.filter("oversized").select(
        "doc_id", "source", "window_index", F.lit(0).alias("chunk_index"), title.alias("title"), F.lit("").alias("summary"), F.lit(None).cast("int").alias("level"),
        T.chunk_type(F.col("text")).alias("chunk_type"), F.col("text").alias("content"), F.lit("agent").alias("producer"),
    )


def fallback_chunks(window_rows: DataFrame, least: int = 300, budget: int = 1200, count: TokenCounter = chars4) -> DataFrame:
    """Windows split by rule, without links."""
    key = F.concat_ws(":", "doc_id", F.col("window_index").cast("string"))
    keyed = window_rows.withColumn("k", key)
    rows = rule_split(keyed.select(F.col("k").alias("doc_id"), "source", F.col("text").alias("markdown")), least, budget, count, True)
    rows = rows.select(F.col("doc_id").alias("k"), F.col("ord").alias("chunk_index"), "title", F.lit("").alias("summary"), "level", "chunk_type", "content", F.lit("fallback").alias("producer"))
    return keyed.select("k", "doc_id", "source", "window_index").join(rows, "k").drop("k")


def numbered(chunks: DataFrame) -> DataFrame:
    """``chunks`` with their place ``ord`` in the document, ``bare`` title and ``chunk_id``."""
    order = F.row_number().over(W.partitionBy("doc_id").orderBy("window_index", "chunk_index")) - 1
    rows = chunks.withColumn("ord", order.cast("int")).withColumn("bare", T.clean_title(F.col("title")))
    group = F.when(F.col("window_index") == 0, "").otherwise(F.col("window_index").cast("string"))
    return links.with_ids(rows, group)


def assemble(chunks: DataFrame, window_rows: DataFrame, count: TokenCounter = chars4) -> DataFrame:
    """Linked chunks of ``chunks(doc_id, source, window_index, chunk_index, title, summary, level, chunk_type, content, producer)``.

    Headings open at a window's start count as levels 1, 2, .. of it.  Titles point to the last chunk of the
    same title and level anywhere in the document.
    """
    return linked(stored(numbered(chunks)), window_rows, count)


def linked(whole: DataFrame, window_rows: DataFrame, count: TokenCounter = chars4) -> DataFrame:
    """Links of rows of :func:`numbered`, which are read twice.  They are made without the texts, which meet them at the end."""
    rows = whole.select("doc_id", "ord", "window_index", "chunk_id", "bare", "level", "chunk_type")
    seeds = window_rows.select("doc_id", "window_index", "leading_heading_path").join(links.last_ids(rows, "bare"), "doc_id", "left")
    titled = lambda t: F.filter("last", lambda m: m["title"] == t)
    exact = lambda t, i: F.filter("last", lambda m: (m["title"] == t) & (m["level"] == i + 1))
    found = F.transform(
        "leading_heading_path",
        lambda t, i: F.struct((i + 1).cast("int").alias("level"), T.clean_title(t).alias("title"), F.coalesce(F.get(exact(T.clean_title(t), i), F.lit(0))["id"], F.get(titled(T.clean_title(t)), F.lit(0))["id"]).alias("id")),
    )
    seeds = seeds.select("doc_id", "window_index", F.filter(found, lambda s: s["id"].isNotNull()).alias("seed"))
    rows = links.with_paths(rows, ("doc_id", "window_index"), "bare", seeds)
    rows = links.with_parents(rows, orphan_parent=True)
    rows = links.with_titles(rows, "bare")
    chain = F.transform("parent_titles", lambda t: t["title"])
    rows = links.with_neighbours(rows).withColumn("chain", chain)
    rows = links.with_siblings(rows, "chain", "bare", "level", "chunk_type")
    rows = rows.select(F.col("doc_id").alias("_doc"), F.col("ord").alias("_ord"), "parent_chunk_id", "parent_titles", "prev_chunk_id", "next_chunk_id", "sibling_chunk_ids", "chain")
    rows = whole.join(rows, whole["doc_id"].eqNullSafe(rows["_doc"]) & (whole["ord"] == rows["_ord"]))
    titles = F.array_join("chain", " > ")
    name = T.file_name(F.col("source"))
    anchor = F.concat_ws(" > ", F.when(name != "", name), F.when(titles != "", titles))
    summary = T.strip(F.coalesce("summary", F.lit("")))
    rows = rows.withColumn("embedding_text", F.concat_ws("\n", F.when(anchor != "", anchor), F.when(summary != "", summary), F.coalesce("content", F.lit(""))))
    rows = rows.withColumn("token_count", count(F.col("embedding_text"))).withColumn("split_group_id", F.col("window_index"))
    columns = ["doc_id", "source", "ord", "window_index", "chunk_index", "chunk_id", "title", "summary", "level", "chunk_type", "content", "producer", "split_group_id"]
    return rows.select(*columns, "parent_chunk_id", "parent_titles", "prev_chunk_id", "next_chunk_id", "sibling_chunk_ids", "embedding_text", "token_count")
