"""Greedy packing under a token budget, as folds over a row's own array.

Each fold sees one section's sentences, one table's rows or one run's chunks; nothing crosses rows.  A fold
gathers places of cuts, not texts: with a counter by length it adds lengths, and each piece is put together
once.  Other counters count each candidate joined, as token counts need not add up.

Defined cases: null texts give no pieces; a blank text gives none (its block stays whole); one item over the
budget is a piece of its own; repeated document rows are one document each by their ``doc_id`` (see ``lines``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions import text as T
from chunkloom.functions.tokens import TokenCounter, chars4


def prefix_of(title: Column) -> Column:
    """The clean title that stands before a chunk when its tokens are counted."""
    return F.coalesce(T.clean_title(title), F.lit(""))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda sees a bound variable, not the expression."""
    return F.transform(F.array(value), use)[0]


def pack_sentences(text: Column, prefix: Column, budget: int, count: TokenCounter = chars4) -> Column:
    """Pieces of whole sentences joined by a space; lines where a long text is one sentence.

    A further sentence is joined and the piece stripped, so a piece loses the space before its first item and after
    each of the others.
    """
    sized = lambda s: count(F.concat(prefix, F.lit("\n"), s)) <= budget
    sentences = F.split(T.strip(text), f"(?<=[.?!])[{T.SPACE}]+")
    single = (F.size(sentences) <= 1) & ~sized(text)
    items = F.when(single, F.filter(T.plain_lines(text), lambda x: ~T.is_blank(x))).otherwise(sentences)
    piece = lambda own: F.when(F.size(own) == 1, own[0]).otherwise(F.array_join(F.transform(own, lambda s, i: F.when(i == 0, T.lstrip(s)).otherwise(T.rstrip(s))), " "))
    of_length = getattr(count, "of_length", None)
    if of_length is None:  # each candidate is joined and counted
        fits = lambda a, s: sized(T.strip(F.concat(a["now"], F.lit(" "), s)))
        step = lambda a, s, ok: F.when(ok, T.strip(F.concat(a["now"], F.lit(" "), s))).otherwise(s)
        blank = F.lit("")
        return _once(items, lambda own: _cut(own, own, fits, step, blank, piece))
    room = lambda n: of_length(F.length(prefix) + 1 + n) <= budget
    sizes = lambda own: F.transform(own, lambda s: F.struct(F.length(s).alias("n"), F.length(T.lstrip(s)).alias("left"), F.length(T.rstrip(s)).alias("right")))
    joined = lambda a, x: a["now"] + 1 + x["right"]
    return _once(items, lambda own: _cut(own, sizes(own), lambda a, x: room(joined(a, x)), lambda a, x, ok: F.when(ok, joined(a, x)).otherwise(x["left"]), F.lit(0), piece))


def _cut(items: Column, sizes: Column, fits, step, zero: Column, piece) -> Column:
    """Greedy groups of neighbours as pieces; ``fits`` and ``step`` see what is known of the open group and the next size.

    Only the places of the cuts are gathered in the fold; each piece is put together once, after it.
    """
    start = F.struct(F.array().cast("array<int>").alias("cuts"), zero.alias("now"), F.lit(0).alias("i"))

    def add(a: Column, x: Column) -> Column:
        ok = (a["i"] > 0) & fits(a, x)
        cuts = F.when(ok, a["cuts"]).otherwise(F.array_append(a["cuts"], a["i"]))
        return F.struct(cuts.alias("cuts"), step(a, x, ok).alias("now"), (a["i"] + 1).alias("i"))

    cuts = F.aggregate(sizes, start, add, lambda a: F.array_append(a["cuts"], a["i"]))
    between = lambda found: F.transform(F.slice(found, F.lit(1), F.size(found) - 1), lambda c, k: piece(F.slice(items, c + 1, F.get(found, k + 1) - c)))
    return F.filter(_once(cuts, between), lambda s: s != "")


def pack_rows(table: Column, prefix: Column, budget: int, count: TokenCounter = chars4) -> Column:
    """Pieces of a table, each with its two header lines; short tables stay whole."""
    return _once(F.filter(F.split(table, "\n"), lambda x: ~T.is_blank(x)), lambda rows: _packed_rows(table, rows, prefix, budget, count))


def _packed_rows(table: Column, rows: Column, prefix: Column, budget: int, count: TokenCounter) -> Column:
    head = F.array_join(F.slice(rows, 1, 2), "\n")
    body = F.slice(rows, F.lit(3), F.greatest(F.size(rows) - 2, F.lit(0)))
    piece = lambda own: F.concat(head, F.lit("\n"), F.array_join(own, "\n"))
    of_length = getattr(count, "of_length", None)
    if of_length is None:
        longer = lambda a, row: F.concat(a["now"], F.lit("\n"), row)
        fits = lambda a, row: count(F.concat(prefix, F.lit("\n"), longer(a, row))) <= budget
        step = lambda a, row, ok: F.when(ok, longer(a, row)).otherwise(F.concat(head, F.lit("\n"), row))
        packed = _once(body, lambda own: _cut(own, own, fits, step, F.lit(""), piece))
    else:
        fits = lambda a, n: of_length(F.length(prefix) + 1 + a["now"] + 1 + n) <= budget
        step = lambda a, n, ok: F.when(ok, a["now"]).otherwise(F.length(head)) + 1 + n
        packed = _once(body, lambda own: _cut(own, F.transform(own, lambda r: F.length(r)), fits, step, F.lit(0), piece))
    return F.when(F.size(rows) <= 2, F.array(table)).otherwise(packed)


def split_oversized(blocks: DataFrame, budget: int, count: TokenCounter = chars4) -> DataFrame:
    """Text and table blocks over the budget as pieces; code stays whole.  ``ord`` is renumbered."""
    prefix = prefix_of(F.col("title"))
    over = (count(F.concat(prefix, F.lit("\n"), F.col("content"))) > budget) & (F.col("chunk_type") != "code")
    whole = F.array(F.col("content"))
    pieces = F.when(~over, whole).when(F.col("chunk_type") == "table", pack_rows(F.col("content"), prefix, budget, count)).otherwise(pack_sentences(F.col("content"), prefix, budget, count))
    pieces = F.when(F.size(pieces) > 0, pieces).otherwise(whole)
    rows = blocks.select("doc_id", F.col("ord").alias("block"), "title", "level", "chunk_type", F.posexplode(pieces).alias("piece", "content"))
    order = F.row_number().over(W.partitionBy("doc_id").orderBy("block", "piece")) - 1
    return rows.select("doc_id", order.alias("ord"), "title", "level", "chunk_type", "content")


def runs(chunks: DataFrame, *keys: str) -> DataFrame:
    """``run``: number of the stretch of neighbours that agree (null-safe) on ``keys``."""
    w = W.partitionBy("doc_id").orderBy("ord")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.lag(k).over(w))
    turn = (F.lag("ord").over(w).isNull() | ~same).cast("int")
    return chunks.withColumn("_turn", turn).withColumn("run", F.sum("_turn").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int")).drop("_turn")


def merge_runs(chunks: DataFrame, least: int, budget: int, count: TokenCounter = chars4) -> DataFrame:
    """Neighbours of one title, level and type merged while small; contents are joined without a separator."""
    prefix = prefix_of(F.col("title"))
    sized = count(F.when(prefix != "", F.concat(prefix, F.lit("\n"), F.col("content"))).otherwise(F.col("content")))
    rows = runs(chunks, "title", "level", "chunk_type").withColumn("tokens", sized)
    item = F.struct("ord", "tokens", "content")
    grouped = rows.groupBy("doc_id", "run").agg(
        F.first("title").alias("title"), F.first("level").alias("level"), F.first("chunk_type").alias("chunk_type"), F.array_sort(F.collect_list(item)).alias("items")
    )

    def add(a: Column, x: Column) -> Column:
        apart = (a["i"] == 0) | ((a["held"] >= least) & (x["tokens"] >= least)) | (a["held"] + x["tokens"] > budget) | (F.col("chunk_type") == "code")
        cuts = F.when(apart, F.array_append(a["cuts"], a["i"])).otherwise(a["cuts"])
        return F.struct(cuts.alias("cuts"), F.when(apart, x["tokens"]).otherwise(a["held"] + x["tokens"]).alias("held"), (a["i"] + 1).alias("i"))

    start = F.struct(F.array().cast("array<int>").alias("cuts"), F.lit(0).alias("held"), F.lit(0).alias("i"))
    grouped = grouped.withColumn("cuts", F.aggregate("items", start, add, lambda a: F.array_append(a["cuts"], a["i"])))
    whole = lambda own: F.array_join(F.transform(own, lambda x: x["content"]), "")
    merged = F.transform(F.slice("cuts", F.lit(1), F.size("cuts") - 1), lambda c, k: whole(F.slice("items", c + 1, F.get("cuts", k + 1) - c)))
    out = grouped.select("doc_id", "run", "title", "level", "chunk_type", F.posexplode(merged).alias("part", "content"))
    order = F.row_number().over(W.partitionBy("doc_id").orderBy("run", "part")) - 1
    return out.select("doc_id", order.alias("ord"), "title", "level", "chunk_type", "content")
