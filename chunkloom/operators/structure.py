"""Lines, headings, sections and typed blocks of markdown texts, by running window functions.

All windows are partitioned by ``doc_id``, so one shuffle serves the whole chain.

Defined cases, for these operators and those that start from them: of rows with one ``doc_id`` one is taken (the least
hash of its text, so the same in each run); rows without ``doc_id`` are left out, as nothing could be linked to them; a
null text is empty and has no lines; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions import text as T


def _ordered(*by: str):
    return W.partitionBy("doc_id").orderBy(*by).rowsBetween(W.unboundedPreceding, 0)


def documents(md: DataFrame) -> DataFrame:
    """One row for each ``doc_id`` of ``md(doc_id, markdown[, user_id, source])``."""
    own = [c for c in ("user_id", "source", "markdown") if c in md.columns]
    row = F.min_by(F.struct(*own), F.xxhash64(*own)).alias("r")
    return md.filter("doc_id is not null").groupBy("doc_id").agg(row).select("doc_id", "r.*")


def lines(md: DataFrame, unique: bool = False) -> DataFrame:
    """``doc_id, line_no, line, mark, start, end``: the lines of each text and their terminators; end includes the terminator."""
    md = md if unique else documents(md)
    rows = md.select("doc_id", F.posexplode(T.split_lines(F.col("markdown"))).alias("line_no", "l"))
    size = F.length("l.line") + F.length("l.mark")
    end = F.sum(size).over(_ordered("line_no")).cast("int")
    return rows.select("doc_id", "line_no", F.col("l.line").alias("line"), F.col("l.mark").alias("mark"), (end - size).cast("int").alias("start"), end.alias("end"))


def headings(line_rows: DataFrame) -> DataFrame:
    """``doc_id, line_no, start, title, level`` of heading lines."""
    s = T.strip(F.col("line"))
    return line_rows.filter(T.is_heading(s)).select("doc_id", "line_no", "start", s.alias("title"), T.heading_level(s).alias("level"))


def section_lines(line_rows: DataFrame) -> DataFrame:
    """Body lines with the number, title and level of their section; headings open sections."""
    s = T.strip(F.col("line"))
    rows = line_rows.withColumn("stripped", s).withColumn("head", T.is_heading(F.col("stripped")))
    rows = rows.withColumn("section", F.sum(F.col("head").cast("int")).over(_ordered("line_no")).cast("int"))
    title = F.last(F.when(F.col("head"), F.col("stripped")), ignorenulls=True).over(_ordered("line_no"))
    rows = rows.withColumn("title", title).withColumn("level", T.heading_level(F.col("title")))
    return rows.filter(~F.col("head")).drop("head")


def _content(order: str = "line_no"):
    """Lines of a group in order, each with a line feed."""
    held = F.array_sort(F.collect_list(F.struct(order, "line")))
    return F.array_join(F.transform(held, lambda r: F.concat(r["line"], F.lit("\n"))), "")


def sections(line_rows: DataFrame) -> DataFrame:
    """``doc_id, section, title, level, content`` of sections that are not blank."""
    rows = section_lines(line_rows).groupBy("doc_id", "section").agg(F.first("title").alias("title"), F.first("level").alias("level"), _content().alias("content"))
    return rows.filter(~T.is_blank(F.col("content")))


def typed_blocks(line_rows: DataFrame) -> DataFrame:
    """``doc_id, ord, section, title, level, chunk_type, content``: text, code and table runs of each section.

    A fence toggles code; an unclosed one runs to the end of its section.  Pipe lines outside code are
    tables.  A blank text run is carried to the section's next text run, and dropped where none follows.
    """
    per_section = W.partitionBy("doc_id", "section").orderBy("line_no")
    so_far = per_section.rowsBetween(W.unboundedPreceding, 0)
    rows = section_lines(line_rows).withColumn("fence", T.is_fence(F.col("stripped")))
    rows = rows.withColumn("fences", F.sum(F.col("fence").cast("int")).over(so_far))
    opening = F.col("fence") & (F.col("fences") % 2 == 1)
    code = F.col("fence") | (F.col("fences") % 2 == 1)
    rows = rows.withColumn("chunk_type", F.when(code, "code").when(T.is_table_line(F.col("stripped")), "table").otherwise("text"))
    turn = opening | (F.col("chunk_type") != F.coalesce(F.lag("chunk_type").over(per_section), F.lit("")))
    rows = rows.withColumn("run", F.sum(turn.cast("int")).over(so_far))
    whole_run = W.partitionBy("doc_id", "section", "run")
    rows = rows.withColumn("full", F.max((F.col("stripped") != "").cast("int")).over(whole_run) == 1)
    ahead = per_section.rowsBetween(0, W.unboundedFollowing)
    next_text = F.min(F.when((F.col("chunk_type") == "text") & F.col("full"), F.col("run"))).over(ahead)
    rows = rows.withColumn("run", F.when((F.col("chunk_type") == "text") & ~F.col("full"), next_text).otherwise(F.col("run"))).filter("run is not null")
    out = rows.groupBy("doc_id", "section", "run").agg(
        F.first("title").alias("title"), F.first("level").alias("level"), F.first("chunk_type").alias("chunk_type"), F.max("line_no").alias("at"), _content().alias("content")
    )
    order = F.row_number().over(W.partitionBy("doc_id").orderBy("section", "run")) - 1
    return out.filter(~T.is_blank(F.col("content"))).select("doc_id", order.alias("ord"), "section", "title", "level", "chunk_type", "content")
