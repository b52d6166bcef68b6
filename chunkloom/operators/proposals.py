"""Chunk boundaries proposed for windows: attempts, repair, validation, fallback.

A provider is any function from windows to rows ``(doc_id, window_index, attempt, args_json)``.  The
default is a deterministic one that proposes blocks, so that the whole plan runs without a network.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions import text as T
from chunkloom.functions.tokens import TokenCounter, chars4
from chunkloom.operators.paragraphs import paragraphs
from chunkloom.operators.windows import blocks
from chunkloom.sources.shared import stored

BoundaryProvider = Callable[[DataFrame], DataFrame]
KEY = ("doc_id", "window_index", "attempt")
# The keys of a chunk's metadata.
METADATA = "summary string, document_type string, keywords array<string>, topics array<string>, entities array<string>, references array<string>, questions array<string>, action_items array<string>"
ITEM = f"start bigint, end bigint, title string, chunk_type string, summary string, level int, metadata struct<{METADATA.replace(' ', ':').replace(',:', ',')}>"
# The keys that a proposed chunk must have.
REQUIRED = ("start", "end", "title", "chunk_type")


def propose_paragraphs(window_rows: DataFrame, least: int = 1600, most: int = 4800) -> DataFrame:
    """One attempt per window: a chunk for each paragraph, through the same steps as a model's answer by paragraph."""
    spans = stored(paragraphs(window_rows, least, most))
    number = F.col("paragraph_id")
    item = F.struct(number.alias("start_paragraph"), number.alias("end_paragraph"), F.lit("").alias("title"), F.lit("").alias("summary"), T.chunk_type(F.col("text")).alias("chunk_type"))
    lists = spans.groupBy("doc_id", "window_index").agg(F.array_sort(F.collect_list(item)).alias("chunks"))
    return from_paragraphs(lists.select("doc_id", "window_index", F.lit(1).alias("attempt"), F.to_json(F.struct("chunks")).alias("args_json")), spans)


def from_paragraphs(answers: DataFrame, paragraph_rows: DataFrame) -> DataFrame:
    """Answers by paragraph number ``(doc_id, window_index, attempt, args_json[, problem])`` as proposals by offset.

    ``problem`` names answers that cannot be read, are empty, or whose ranges do not follow each other.
    """
    kind = "array<struct<start_paragraph:int,end_paragraph:int,title:string,summary:string,chunk_type:string>>"
    raw = F.from_json("args_json", f"chunks {kind}")["chunks"]
    bad = F.when(F.col("args_json").isNull(), "no tool call").when(F.get_json_object("args_json", "$").isNull(), "bad json").when(raw.isNull(), "missing chunks").when(F.size(raw) == 0, "empty chunks")
    if "problem" in answers.columns:
        bad = F.coalesce("problem", bad)
    rows = stored(answers.select(*KEY, bad.alias("problem"), raw.alias("chunks")))
    ranges = rows.filter("problem is null").select(*KEY, F.posexplode("chunks").alias("chunk_index", "c")).select(*KEY, "chunk_index", "c.*")
    found = by_paragraph(ranges, paragraph_rows).join(ranges.select(*KEY, "chunk_index", "title", "summary", "chunk_type"), [*KEY, "chunk_index"])
    item = F.struct("chunk_index", "start", "end", "title", "summary", "chunk_type", F.lit(None).cast("int").alias("level"))
    lists = found.groupBy(*KEY).agg(F.max("error").alias("error"), F.array_sort(F.collect_list(item)).alias("chunks"))
    out = rows.select(*KEY, "problem").join(lists, list(KEY), "left")
    return out.select(*KEY, F.to_json(F.struct("chunks")).alias("args_json"), F.coalesce("problem", "error").alias("problem"))


def propose_blocks(window_rows: DataFrame) -> DataFrame:
    """One attempt per window: a chunk for each block, titled by the last open heading."""
    keys = F.concat_ws(":", "doc_id", F.col("window_index").cast("string"))
    parts = blocks(window_rows.select(keys.alias("doc_id"), F.col("text").alias("markdown")), unique=True).withColumnRenamed("doc_id", "k")
    item = F.struct("block_no", "start", "end", F.lit("").alias("title"), F.col("type").alias("chunk_type"), F.lit("").alias("summary"))
    lists = parts.groupBy("k").agg(F.array_sort(F.collect_list(item)).alias("chunks"))
    rows = window_rows.withColumn("k", keys).join(lists, "k")
    return rows.select("doc_id", "window_index", F.lit(1).alias("attempt"), F.to_json(F.struct("chunks")).alias("args_json"))


propose_blocks.fixed = propose_paragraphs.fixed = True


def parsed(proposals: DataFrame) -> DataFrame:
    """Attempts with ``items``, the proposed chunks as text; ``problem`` names an attempt that cannot be read."""
    raw = F.from_json("args_json", "chunks array<string>")
    problem = F.when(F.col("args_json").isNull(), "no tool call").when(F.get_json_object("args_json", "$").isNull(), "bad json").when(raw["chunks"].isNull(), "missing chunks")
    if "problem" in proposals.columns:
        problem = F.coalesce("problem", problem)
    return proposals.select(*KEY, problem.alias("problem"), raw["chunks"].alias("items"))


def _cut(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start.cast("int") + 1, (end - start).cast("int"))


def repaired(text: Column, items: Column) -> Column:
    """Proposed chunks with bounds moved past white space at both ends; spans of white space only stay.

    ``complete`` and ``known`` tell whether the required keys are there and the type is one of the three, ``inside``
    whether the bounds are a range of the text.
    """

    def read(item: Column, i: Column) -> Column:
        missing = F.array_except(F.array(*map(F.lit, REQUIRED)), F.coalesce(F.json_object_keys(item), F.array().cast("array<string>")))
        return F.struct(i.alias("chunk_index"), (F.size(missing) == 0).alias("complete"), F.from_json(item, ITEM).alias("v"))

    def placed(x: Column) -> Column:
        v = x["v"]
        inside = F.coalesce((v["start"] >= 0) & (v["end"] <= F.length(text)) & (v["start"] < v["end"]), F.lit(False))
        return F.struct(x["chunk_index"], x["complete"], v.alias("v"), inside.alias("inside"), F.when(inside, _cut(text, v["start"], v["end"])).alias("own"))

    def trimmed(x: Column) -> Column:
        v, own = x["v"], x["own"]
        full = F.coalesce(~T.is_blank(own), F.lit(False))
        start = F.when(full, v["start"] + F.length(own) - F.length(T.lstrip(own))).otherwise(v["start"])
        end = F.when(full, v["end"] - F.length(own) + F.length(T.rstrip(own))).otherwise(v["end"])
        known = F.coalesce(v["chunk_type"].isin("text", "code", "table"), F.lit(False))
        kept = [v[c].alias(c) for c in ("title", "summary", "level", "chunk_type", "metadata")]
        return F.struct(start.alias("start"), end.alias("end"), x["chunk_index"].alias("chunk_index"), x["complete"].alias("complete"), known.alias("known"), x["inside"].alias("inside"), *kept)

    return F.array_sort(F.transform(F.transform(F.transform(items, read), placed), trimmed))


def snapped(chunks: Column, gap: int = 3) -> Column:
    """Ends extended over gaps of up to ``gap`` characters to the next start; ``overlap`` where a chunk starts before its neighbour's end."""

    def move(x: Column, i: Column) -> Column:
        after, before = F.get(chunks, i + 1)["start"], F.get(chunks, i - 1)["end"]
        end = F.when((after - x["end"]).between(1, gap), after).otherwise(x["end"])
        kept = [x[c].alias(c) for c in ("chunk_index", "complete", "known", "inside", "title", "summary", "level", "chunk_type", "metadata")]
        return F.struct(x["start"].alias("start"), end.alias("end"), F.coalesce(before > x["start"], F.lit(False)).alias("overlap"), *kept)

    return F.transform(chunks, move)


def uncovered(text: Column, chunks: Column) -> Column:
    """Stretches ``(start, end)`` of a text that no chunk (in order, all inside) covers and that are not blank."""
    stretch = lambda a, b: F.struct(a.cast("bigint").alias("start"), b.cast("bigint").alias("end"))
    before = F.transform(chunks, lambda x, i: stretch(F.coalesce(F.get(chunks, i - 1)["end"], F.lit(0)), x["start"]))
    last = stretch(F.coalesce(F.array_max(F.transform(chunks, lambda x: x["end"])), F.lit(0)), F.length(text))
    return F.filter(F.concat(before, F.array(last)), lambda g: (g["start"] < g["end"]) & ~T.is_blank(_cut(text, g["start"], g["end"])))


def validated(proposals: DataFrame, window_rows: DataFrame, max_tokens: int = 1200, slack: float = 1.1, gap: int = 3, count: TokenCounter = chars4) -> tuple[DataFrame, DataFrame]:
    """``(chunks, attempts)``: repaired chunks of every attempt, and each attempt's ``is_valid, error_reasons``.

    Checks run in stages, as a later one makes sense only after the earlier: keys and types, ranges, overlaps,
    coverage and size.  An attempt is one row with an array of its chunks, which meets its window's text once; no
    step but that join and the sum of sizes moves rows.

    Defined cases: an attempt of no known window has no text, so its chunks are out of range; null ids match nothing;
    repeated attempts get equal verdicts; an empty table gives empty results.
    """
    texts = window_rows.select("doc_id", "window_index", F.col("text").alias("window_text"), "oversized")
    rows = parsed(proposals).join(texts, ["doc_id", "window_index"], "left")
    text = F.col("window_text")
    rows = rows.withColumn("c", repaired(text, F.col("items"))).withColumn("c", snapped(F.col("c"), gap))
    rows = rows.withColumn("ins", F.filter("c", lambda x: x["inside"]))
    rows = rows.withColumn("holes", uncovered(text, F.col("ins")))
    fails = lambda test, name: F.when(F.exists("c", test), name)
    early = fails(lambda x: ~x["complete"], "missing keys")
    later = F.array_compact(F.array(fails(lambda x: ~x["known"], "bad type"), fails(lambda x: ~x["inside"], "bad range")))
    first = (
        F.when(F.col("problem").isNotNull(), F.array("problem"))
        .when(F.size("items") == 0, F.array(F.lit("uncovered")))
        .when(early.isNotNull(), F.array(early))
        .when(F.size(later) > 0, later)
        .when(F.exists("c", lambda x: x["overlap"]), F.array(F.lit("overlap")))
    )
    cut = F.transform("c", lambda x: F.struct(x.alias("v"), F.when(x["inside"], _cut(text, x["start"], x["end"])).alias("content")))
    rows = stored(rows.select(*KEY, "oversized", first.alias("first"), (F.size("holes") > 0).alias("hole"), cut.alias("c")))
    chunks = rows.select(*KEY, "oversized", F.explode("c").alias("c")).select(*KEY, "oversized", "c.v.*", "c.content")
    limit = int(max_tokens * slack)
    large = chunks.filter(~F.col("oversized") & (count(F.col("content")) > limit)).select(*KEY).distinct().withColumn("large", F.lit("too large"))
    heads = rows.select(*KEY, "first", F.when(F.col("hole"), "uncovered").alias("hole")).join(large, list(KEY), "left")
    reasons = F.coalesce("first", F.array_compact(F.array("hole", "large")))
    attempts = heads.select(*KEY, (F.size(reasons) == 0).alias("is_valid"), reasons.alias("error_reasons"))
    summary = T.strip(F.coalesce("summary", F.lit("")))
    out = chunks.select(*KEY, "chunk_index", "start", "end", "title", summary.alias("summary"), "level", "chunk_type", "content", *normalised())
    return out, attempts


def normalised() -> list[Column]:
    """What every chunk carries whatever was proposed: type, flags from the type, and metadata with all its keys."""
    kind, meta = F.col("chunk_type"), F.col("metadata")
    filled = [F.coalesce(meta[c], F.lit("") if kind_ == "string" else F.array().cast(kind_)).alias(c) for c, kind_ in (x.split() for x in METADATA.split(", "))]
    return [kind.alias("primary_type"), *((kind == c).alias(f"has_{c}") for c in ("text", "code", "table")), F.struct(*filled).alias("metadata")]


def accepted(chunks: DataFrame, attempts: DataFrame) -> DataFrame:
    """Chunks of the first valid attempt of each window, in order of their bounds."""
    best = attempts.filter("is_valid").groupBy("doc_id", "window_index").agg(F.min("attempt").alias("attempt"))
    rows = chunks.join(best, list(KEY))
    order = F.row_number().over(W.partitionBy("doc_id", "window_index").orderBy("start", "end", "chunk_index")) - 1
    return rows.withColumn("chunk_index", order).drop("attempt")


def exhausted(window_rows: DataFrame, attempts: DataFrame) -> DataFrame:
    """Windows without a valid attempt."""
    return window_rows.join(attempts.filter("is_valid").select("doc_id", "window_index").distinct(), ["doc_id", "window_index"], "left_anti")


def by_paragraph(ranges: DataFrame, paragraph_rows: DataFrame) -> DataFrame:
    """Offsets of proposals by paragraph number, or the first reason why an attempt fails.

    ``ranges(doc_id, window_index, attempt, chunk_index, start_paragraph, end_paragraph)`` must follow each
    other without gap or overlap, from paragraph 0 to the last.
    """
    ends = paragraph_rows.groupBy("doc_id", "window_index").agg(F.max("paragraph_id").alias("last"))
    rows = ranges.join(ends, ["doc_id", "window_index"])
    w = W.partitionBy(*KEY).orderBy("chunk_index")
    expected = F.coalesce(F.lag("end_paragraph").over(w), F.lit(-1)) + 1
    final = F.lead("chunk_index").over(w).isNull()
    a, b = F.col("start_paragraph"), F.col("end_paragraph")
    reason = (
        F.when(a.isNull() | b.isNull(), "not integers")
        .when((a < 0) | (b > F.col("last")), "out of range")
        .when(a > b, "start after end")
        .when(a != expected, F.when(a > expected, "gap").otherwise("overlap"))
        .when(final & (b != F.col("last")), "short tail")
    )
    rows = rows.withColumn("expected", expected).withColumn("reason", reason)
    starts = paragraph_rows.select("doc_id", "window_index", F.col("paragraph_id").alias("start_paragraph"), "start")
    stops = paragraph_rows.select("doc_id", "window_index", F.col("paragraph_id").alias("end_paragraph"), "end")
    rows = rows.join(starts, ["doc_id", "window_index", "start_paragraph"], "left").join(stops, ["doc_id", "window_index", "end_paragraph"], "left")
    first = F.first(F.when(F.col("reason").isNotNull(), F.col("reason")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return rows.select(*KEY, "chunk_index", "start", "end", first.alias("error"))
