"""The rule-based splitter: sections, typed blocks, pieces under budget, merged runs, links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.tokens import TokenCounter, chars4
from chunkloom.operators import links, packing, structure
from chunkloom.sources.shared import stored


def rule_chunks(md: DataFrame, least: int | None = 300, budget: int | None = 1200, count: TokenCounter = chars4, unique: bool = False) -> DataFrame:
    """Chunks without links: ``doc_id, ord, title, level, chunk_type, content``."""
    chunks = structure.typed_blocks(structure.lines(md, unique)).drop("section")
    if budget is not None:
        chunks = packing.split_oversized(chunks, budget, count)
    if budget is not None and least is not None:
        chunks = packing.merge_runs(chunks, least, budget, count)
    return chunks


def rule_split(md: DataFrame, least: int | None = 300, budget: int | None = 1200, count: TokenCounter = chars4, unique: bool = False) -> DataFrame:
    """The splitter end to end, one row per linked chunk; ``unique`` says that ids are known to differ.

    Defined cases as for lines: one row for each ``doc_id``, none without, and nothing for blank texts.
    """
    md = md if unique else stored(structure.documents(md))
    rows = links.with_neighbours(links.with_ids(stored(rule_chunks(md, least, budget, count, True))))
    rows = links.with_titles(links.with_parents(links.with_paths(rows)))
    rows = links.with_siblings(rows, "run")
    titles = F.array_join(F.transform("parent_titles", lambda t: t["title"]), " > ")
    rows = rows.withColumn("embedding_text", F.concat(titles, F.lit("\n"), F.col("content")))
    rows = rows.withColumn("token_count", count(F.col("embedding_text")))
    source = md.select("doc_id", "source")
    columns = ["doc_id", "ord", "chunk_id", "title", "level", "chunk_type", "content", "parent_chunk_id", "parent_titles", "prev_chunk_id", "next_chunk_id", "sibling_chunk_ids", "embedding_text", "token_count"]
    return rows.select(*columns).join(source, "doc_id")
