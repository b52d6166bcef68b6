"""Links between the chunks of a document: ids, neighbours, siblings, parents and title paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions import text as T
from chunkloom.sources.shared import stored

_PATH = "array<struct<level:int,title:string,id:string>>"


def with_ids(chunks: DataFrame, group: Column | None = None) -> DataFrame:
    """``chunk_id``: uuid5 of document, group and the chunk's place in its group (group 0 is written empty)."""
    group = F.lit("") if group is None else group
    place = F.row_number().over(W.partitionBy("doc_id", group).orderBy("ord")) - 1
    name = F.concat_ws("|", F.coalesce("doc_id", F.lit("")), group, place.cast("string"))
    return chunks.withColumn("chunk_id", T.uuid5(name))


def with_neighbours(chunks: DataFrame) -> DataFrame:
    w = W.partitionBy("doc_id").orderBy("ord")
    return chunks.withColumn("prev_chunk_id", F.lag("chunk_id").over(w)).withColumn("next_chunk_id", F.lead("chunk_id").over(w))


def with_siblings(chunks: DataFrame, *keys: str) -> DataFrame:
    """``sibling_chunk_ids``: the other chunks that agree on ``keys``, in order; the list is gathered once for each group."""
    whole = W.partitionBy("doc_id", *keys).orderBy("ord").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return chunks.withColumn("sibling_chunk_ids", F.array_remove(F.collect_list("chunk_id").over(whole), F.col("chunk_id")))


def broken_links(chunks: DataFrame) -> DataFrame:
    """``doc_id, chunk_id, kind, target`` of links to ids that no chunk has; empty for whole sets of chunks."""
    one = lambda c: F.array(F.struct(F.lit(c.split("_")[0]).alias("kind"), F.col(c).alias("target")))
    lists = [F.transform("sibling_chunk_ids", lambda x: F.struct(F.lit("sibling").alias("kind"), x.alias("target"))), F.transform("parent_titles", lambda x: F.struct(F.lit("title").alias("kind"), x["chunk_id"].alias("target")))]
    links = chunks.select("doc_id", "chunk_id", F.explode(F.concat(*map(one, ("parent_chunk_id", "prev_chunk_id", "next_chunk_id")), *lists)).alias("l")).select("doc_id", "chunk_id", "l.*")
    known = chunks.select(F.col("chunk_id").alias("target")).distinct()
    return links.filter("target is not null").join(known, "target", "left_anti").select("doc_id", "chunk_id", "kind", "target")


def open_headings(heads: Column, seed: Column | None = None) -> Column:
    """For each prefix of an array of headings (level, title, id), the empty one first, the headings open after it."""
    empty = F.array().cast(_PATH)

    def step(a: Column, h: Column) -> Column:
        own = F.struct(h["level"].cast("int").alias("level"), h["title"].alias("title"), h["id"].cast("string").alias("id"))
        path = F.array_append(F.filter(a["path"], lambda p: p["level"] < h["level"]), own)
        return F.struct(path.alias("path"), F.array_append(a["all"], path).alias("all"))

    first = empty if seed is None else F.coalesce(seed, empty)
    start = F.struct(first.alias("path"), F.array(first).alias("all"))
    return F.aggregate(F.coalesce(heads, empty), start, step, lambda a: a["all"])


def has_heading(title: str = "title") -> Column:
    return F.col(title).isNotNull() & (F.coalesce("level", F.lit(0)) > 0)


def with_paths(chunks: DataFrame, keys: tuple[str, ...] = ("doc_id",), title: str = "title", seeds: DataFrame | None = None) -> DataFrame:
    """``path`` (level, title, id of the group's last chunk): the headings open at each chunk, its own included.

    Heading groups are neighbours of one title and level within ``keys``; ``seeds(*keys, seed)`` gives what is
    open at the start.
    """
    w = W.partitionBy(*keys).orderBy("ord")
    turn = F.lag("ord").over(w).isNull() | ~(F.col(title).eqNullSafe(F.lag(title).over(w)) & F.col("level").eqNullSafe(F.lag("level").over(w)))
    rows = chunks.withColumn("_turn", turn.cast("int")).withColumn("run", F.sum("_turn").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
    rows = rows.withColumn("_head", has_heading(title))
    rows = rows.withColumn("_at", F.sum((F.col("_turn") * F.col("_head").cast("int")).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
    rows = stored(rows)
    heads = rows.filter("_head").groupBy(*keys, "_at").agg(F.first("level").alias("level"), F.first(title).alias("title"), F.max_by("chunk_id", "ord").alias("id"))
    per_key = heads.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_at", "level", "title", "id"))).alias("_heads"))
    if seeds is not None:
        per_key = seeds.join(per_key, list(keys), "left")
    per_key = per_key.withColumn("_paths", open_headings(F.transform("_heads", lambda h: F.struct(h["level"].cast("int").alias("level"), h["title"].alias("title"), h["id"].alias("id"))), F.col("seed") if seeds is not None else None))
    rows = rows.join(per_key.select(*keys, "_paths"), list(keys), "left")
    path = F.coalesce(F.get("_paths", F.col("_at")), F.array().cast(_PATH))
    return rows.withColumn("path", path).drop("_turn", "_paths", "_at")


def with_parents(pathed: DataFrame, orphan_parent: bool = False) -> DataFrame:
    """``parent_chunk_id``: last chunk of the open heading above; for chunks without heading none, or the deepest open one."""
    above = F.get("path", F.size("path") - 2)["id"]
    below = F.get("path", F.size("path") - 1)["id"] if orphan_parent else F.lit(None).cast("string")
    return pathed.withColumn("parent_chunk_id", F.when(F.col("_head"), above).otherwise(below))


def last_ids(chunks: DataFrame, title: str = "title") -> DataFrame:
    """``doc_id, last``: for each (title, level) the last chunk that has it, in order of first appearance."""
    each = chunks.filter(has_heading(title)).groupBy("doc_id", F.col(title).alias("title"), "level").agg(F.min("ord").alias("first"), F.max_by("chunk_id", "ord").alias("id"))
    return each.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("first", "title", "level", "id"))).alias("last"))


def with_titles(pathed: DataFrame, title: str = "title") -> DataFrame:
    """``parent_titles`` as (chunk_id, title): each open heading with the last chunk that has it in the whole document."""
    pathed = stored(pathed)
    joined = pathed.join(last_ids(pathed, title), "doc_id", "left")
    known = lambda p: F.get(F.filter("last", lambda m: (m["title"] == p["title"]) & (m["level"] == p["level"])), F.lit(0))["id"]
    entry = lambda p: F.struct(F.coalesce(known(p), p["id"]).alias("chunk_id"), T.strip(F.regexp_replace(p["title"], "^#+", "")).alias("title"))
    entries = joined.withColumn("_entries", F.transform("path", entry))
    once = F.filter("_entries", lambda e, i: F.array_position(F.transform("_entries", lambda x: x["chunk_id"]), e["chunk_id"]) == i + 1)
    return entries.withColumn("parent_titles", once).drop("last", "_entries")
