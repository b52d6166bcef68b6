"""Blocks and token-budgeted windows of a text, and the headings open where a window starts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions import text as T
from chunkloom.functions.tokens import TokenCounter, chars4
from chunkloom.operators.links import open_headings
from chunkloom.operators.structure import documents, headings, lines
from chunkloom.sources.shared import stored

_WINDOW = "array<struct<start:int,end:int,tokens:int,oversized:boolean>>"


def blocks(md: DataFrame, count: TokenCounter = chars4, unique: bool = False) -> DataFrame:
    """``doc_id, block_no, start, end, type, text, tokens``: paragraphs and pipe tables that cover the text.

    Blank lines belong to the block before them, leading ones to the first block; fences are plain text.
    """
    w = W.partitionBy("doc_id").orderBy("line_no")
    s = T.strip(F.col("line"))
    kind = F.when(s == "", "blank").when(T.is_table_line(s), "table").otherwise("text")
    rows = lines(md, unique).withColumn("kind", kind)
    opens = (F.col("kind") != "blank") & (F.col("kind") != F.coalesce(F.lag("kind").over(w), F.lit("blank")))
    number = F.greatest(F.sum(opens.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(1)).cast("int")
    full = F.max((F.col("kind") != "blank").cast("int"))
    # the text is put together from the lines: a substring of the whole text would be searched for from its start
    held = F.array_sort(F.collect_list(F.struct("line_no", F.concat("line", "mark").alias("t"))))
    out = rows.withColumn("block_no", number - 1).groupBy("doc_id", "block_no").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max(F.when(F.col("kind") != "blank", F.col("kind"))).alias("type"), full.alias("full"),
        F.array_join(F.transform(held, lambda r: r["t"]), "").alias("text"),
    )
    out = out.filter("full = 1")
    return out.select("doc_id", "block_no", "start", "end", "type", "text", count(F.col("text")).alias("tokens"))


def pack_windows(block_rows: DataFrame, budget: int) -> DataFrame:
    """``doc_id, window_index, start, end, token_count, oversized`` by greedy packing; a table over budget stands alone."""
    grouped = block_rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("block_no", "start", "end", "type", "tokens"))).alias("b"))

    def add(a, x):
        alone = (x["tokens"] > budget) & (x["type"] == "table")
        close = (a["n"] > 0) & ((a["tokens"] + x["tokens"] > budget) | alone)
        entry = lambda start, end, tokens, over: F.struct(start.alias("start"), end.alias("end"), tokens.alias("tokens"), over.alias("oversized"))
        done = F.when(close, F.array_append(a["done"], entry(a["start"], x["start"], a["tokens"], F.lit(False)))).otherwise(a["done"])
        done = F.when(alone, F.array_append(done, entry(x["start"], x["end"], x["tokens"], F.lit(True)))).otherwise(done)
        return F.struct(
            done.alias("done"),
            F.when(alone, x["end"]).when(close, x["start"]).otherwise(a["start"]).alias("start"),
            F.when(alone, 0).when(close, x["tokens"]).otherwise(a["tokens"] + x["tokens"]).cast("int").alias("tokens"),
            F.when(alone, 0).when(close, 1).otherwise(a["n"] + 1).alias("n"),
            x["end"].alias("last"),
        )

    start = F.struct(F.array().cast(_WINDOW).alias("done"), F.lit(0).alias("start"), F.lit(0).alias("tokens"), F.lit(0).alias("n"), F.lit(0).alias("last"))
    rest = lambda a: F.struct(a["start"].alias("start"), a["last"].alias("end"), a["tokens"].alias("tokens"), F.lit(False).alias("oversized"))
    packed = F.aggregate("b", start, add, lambda a: F.when(a["n"] > 0, F.array_append(a["done"], rest(a))).otherwise(a["done"]))
    rows = grouped.select("doc_id", F.posexplode(packed).alias("window_index", "w"))
    return rows.select("doc_id", "window_index", "w.start", "w.end", F.col("w.tokens").alias("token_count"), "w.oversized")


def windows(md: DataFrame, budget: int = 8000, threshold: int = 6000, count: TokenCounter = chars4) -> DataFrame:
    """Windows with their text and ``leading_heading_path``; texts of up to ``threshold`` tokens are one window."""
    md = documents(md)
    total = count(F.col("markdown"))
    small = md.filter(total <= threshold).select("doc_id", F.lit(0).alias("window_index"), F.lit(0).alias("start"), F.length("markdown").alias("end"), total.alias("token_count"), F.lit(False).alias("oversized"))
    packed = pack_windows(blocks(md.filter(total > threshold), count, True), budget)
    rows = small.unionByName(packed).join(md.select("doc_id", "source", "markdown"), "doc_id")
    rows = rows.withColumn("text", F.substring("markdown", F.col("start") + 1, F.col("end") - F.col("start"))).drop("markdown")
    found = headings(lines(md, True)).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "level", "title"))).alias("h"))
    heads = F.transform("h", lambda h: F.struct(h["level"].cast("int").alias("level"), h["title"].alias("title"), F.lit(None).cast("string").alias("id")))
    found = stored(found.withColumn("paths", open_headings(heads)))
    rows = rows.join(found, "doc_id", "left")
    before = F.size(F.filter("h", lambda h: h["start"] < F.col("start")))
    path = F.transform(F.get("paths", before), lambda p: T.strip(F.regexp_replace(p["title"], "^#+", "")))
    return rows.withColumn("leading_heading_path", F.coalesce(path, F.array().cast("array<string>"))).drop("h", "paths")
