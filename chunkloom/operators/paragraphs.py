"""Labelled paragraphs of a window, for proposals by paragraph number.

Lines are rows: flags and running counts give the paragraphs, and the two greedy steps (pieces of long
paragraphs, short neighbours merged) are folds over sizes of lines and of pieces, which gather places of
cuts only.  Texts are put together from their lines, once.

Defined cases: a null or blank text has no paragraphs; windows are told apart by ``doc_id`` and
``window_index``, null ids included; a window that is given twice with the same key is taken as one text of the
lines of both, so keys must be unique; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions import text as T
from chunkloom.sources.shared import stored

_KEY = ["doc_id", "window_index"]
_SPANS = "array<struct<start:int,end:int,atomic:boolean>>"


def _span(start: Column, end: Column, atomic: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), atomic.alias("atomic"))


def paragraph_lines(window_rows: DataFrame) -> DataFrame:
    """Lines of ``windows(doc_id, window_index, text)`` in paragraphs: ``.., line_no, body, start, end, pipe, fence, paragraph``.

    Blank lines part paragraphs; an opening fence keeps them until it closes, and a fence inside prose starts a
    new paragraph.
    """
    rows = window_rows.select(*_KEY, F.posexplode(T.split_lines(F.col("text"))).alias("line_no", "l"))
    body, stripped = F.concat("l.line", "l.mark"), T.strip(F.col("l.line"))
    rows = rows.select(*_KEY, "line_no", body.alias("body"), stripped.alias("s"))
    w = W.partitionBy(*_KEY).orderBy("line_no")
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    size = F.length("body")
    rows = rows.withColumn("end", F.sum(size).over(so_far).cast("int")).withColumn("start", (F.col("end") - size).cast("int"))
    rows = rows.withColumn("fence", T.is_fence(F.col("s"))).withColumn("fences", F.sum(F.col("fence").cast("int")).over(so_far))
    inside = F.col("fences") % 2 == 1  # the opening fence and what follows it; the closing one ends the paragraph
    own = inside | F.col("fence") | (F.col("s") != "")
    opens = F.col("fence") & inside
    rows = rows.select(*_KEY, "line_no", "body", "start", "end", "fence", T.is_table_line(F.col("s")).alias("pipe"), own.alias("own"), opens.alias("opens"), (F.col("fence") & ~inside).alias("closes"))
    before = F.coalesce(F.lag("own").over(w) & ~F.lag("closes").over(w), F.lit(False))
    rows = rows.withColumn("starts", F.col("own") & (F.col("opens") | ~before))
    return rows.withColumn("paragraph", F.sum(F.col("starts").cast("int")).over(so_far)).filter("own").drop("own", "opens", "closes", "starts")


def pieces(lines: DataFrame, most: int) -> DataFrame:
    """Spans ``(.., start, end, atomic)``: paragraphs, prose over ``most`` characters in pieces of whole lines, one line at least.

    Fenced code and text of mostly pipe lines is atomic and stays whole.
    """
    item = F.struct("line_no", (F.col("end") - F.col("start")).alias("size"), F.col("pipe").cast("int").alias("pipe"))
    fenced = F.min_by("fence", "line_no")
    rows = lines.groupBy(*_KEY, "paragraph").agg(F.min("start").alias("start"), F.max("end").alias("end"), fenced.alias("fenced"), F.array_sort(F.collect_list(item)).alias("lines"), F.sum(F.col("pipe").cast("int")).alias("pipes"))
    tabular = lambda pipes, n: (pipes * 2 >= n) & (n > 0)

    def step(a: Column, r: Column) -> Column:
        full = (a["at"] > a["from"]) & (a["at"] - a["from"] + r["size"] > most)
        done = F.when(full, F.array_append(a["done"], _span(a["from"], a["at"], tabular(a["pipes"], a["n"])))).otherwise(a["done"])
        fresh = lambda x, y: F.when(full, x).otherwise(y).cast("int")
        return F.struct(done.alias("done"), fresh(a["at"], a["from"]).alias("from"), (a["at"] + r["size"]).cast("int").alias("at"), fresh(r["pipe"], a["pipes"] + r["pipe"]).alias("pipes"), fresh(F.lit(1), a["n"] + 1).alias("n"))

    start = F.struct(F.array().cast(_SPANS).alias("done"), F.col("start").alias("from"), F.col("start").alias("at"), F.lit(0).alias("pipes"), F.lit(0).alias("n"))
    cut = F.aggregate("lines", start, step, lambda a: F.array_append(a["done"], _span(a["from"], a["at"], tabular(a["pipes"], a["n"]))))
    atomic = F.col("fenced") | tabular(F.col("pipes"), F.size("lines"))
    whole = F.array(_span(F.col("start"), F.col("end"), atomic))
    return rows.select(*_KEY, F.explode(F.when((F.col("end") - F.col("start") <= most) | atomic, whole).otherwise(cut)).alias("s")).select(*_KEY, "s.*")


def merge_short(spans: Column, least: int, most: int) -> Column:
    """Short neighbours as one span: never over atomic ones, never above ``most``; a short last group joins the one before."""
    none = F.lit(None).cast("struct<start:int,end:int,atomic:boolean>")

    def step(a: Column, s: Column) -> Column:
        last = a["last"]
        joins = F.coalesce(~s["atomic"] & ~last["atomic"] & (last["end"] - last["start"] < least) & (s["end"] - last["start"] <= most), F.lit(False))
        done = F.when(joins | last.isNull(), a["done"]).otherwise(F.array_append(a["done"], last))
        return F.struct(done.alias("done"), F.when(joins, _span(last["start"], s["end"], F.lit(False))).otherwise(_span(s["start"], s["end"], s["atomic"])).alias("last"))

    def close(a: Column) -> Column:
        last, before = a["last"], F.element_at(F.when(F.size(a["done"]) > 0, a["done"]), -1)
        joins = F.coalesce((last["end"] - last["start"] < least) & ~last["atomic"] & ~before["atomic"] & (last["end"] - before["start"] <= most), F.lit(False))
        joined = F.array_append(F.slice(a["done"], F.lit(1), F.greatest(F.size(a["done"]) - 1, F.lit(0))), _span(before["start"], last["end"], F.lit(False)))
        return F.when(joins, joined).otherwise(F.array_append(a["done"], last))

    return F.aggregate(spans, F.struct(F.array().cast(_SPANS).alias("done"), none.alias("last")), step, close)


def paragraph_bounds(lines: DataFrame, least: int = 1600, most: int = 4800) -> DataFrame:
    """``doc_id, window_index, paragraph_id, start, end`` of lines of :func:`paragraph_lines`."""
    spans = F.array_sort(F.collect_list(F.struct("start", "end", "atomic")))
    rows = pieces(lines, most).groupBy(*_KEY).agg(spans.alias("spans"))
    rows = rows.select(*_KEY, F.posexplode(merge_short(F.col("spans"), least, most)).alias("paragraph_id", "s"))
    return rows.select(*_KEY, "paragraph_id", "s.start", "s.end")


def paragraphs(window_rows: DataFrame, least: int = 1600, most: int = 4800) -> DataFrame:
    """``doc_id, window_index, paragraph_id, start, end, text`` of ``windows(doc_id, window_index, text)``; offsets are in the window.

    The texts of merged paragraphs hold the blank lines between them.
    """
    window_rows = stored(window_rows.select(*_KEY, "text"))
    bounds = stored(paragraph_bounds(paragraph_lines(window_rows), least, most))
    whole = window_rows.select(*_KEY, F.posexplode(T.split_lines(F.col("text"))).alias("line_no", "l")).select(*_KEY, "line_no", F.concat("l.line", "l.mark").alias("body"))
    so_far = W.partitionBy(*_KEY).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    whole = whole.withColumn("start", (F.sum(F.length("body")).over(so_far) - F.length("body")).cast("int"))
    same = F.lit(True)
    for c in _KEY:
        same = same & whole[c].eqNullSafe(bounds[c])
    rows = whole.join(bounds, same & (whole["start"] == bounds["start"]), "left").select(*[whole[c] for c in (*_KEY, "line_no", "body", "start")], bounds["paragraph_id"], bounds["end"])
    for c in ("paragraph_id", "end"):
        rows = rows.withColumn(c, F.last(c, ignorenulls=True).over(so_far))
    held = F.array_sort(F.collect_list(F.struct("line_no", "body")))
    out = rows.filter(F.col("start") < F.col("end")).groupBy(*_KEY, "paragraph_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.array_join(F.transform(held, lambda r: r["body"]), "").alias("text")
    )
    return out


def rendered(paragraph_rows: DataFrame) -> DataFrame:
    """``doc_id, window_index, prompt``: paragraphs with their labels, as shown to a provider."""
    body = F.concat(F.lit("[P"), F.col("paragraph_id").cast("string"), F.lit("] "), T.rstrip(F.col("text")))
    held = F.array_sort(F.collect_list(F.struct("paragraph_id", body.alias("b"))))
    return paragraph_rows.groupBy("doc_id", "window_index").agg(F.array_join(F.transform(held, lambda r: r["b"]), "\n\n").alias("prompt"))
