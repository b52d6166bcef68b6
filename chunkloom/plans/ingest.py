"""Documents to linked chunks and points, over all documents at once.

Each step is a DataFrame plan; steps that several later ones read are written as tables in the shared folder
while the plan is built, so building it runs jobs.

Defined cases: rows that cannot be ingested (no user, no document id, blank text) are left out and listed by
``rejected``; of rows with one ``doc_id`` one is taken, the same in each run; columns beyond the four are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.config import Settings, settings
from chunkloom.functions.tokens import TokenCounter, chars4
from chunkloom.operators import assembly, prompts, proposals, vectors
from chunkloom.operators.windows import windows
from chunkloom.sources.files import input_error
from chunkloom.sources.shared import settled, stored
from chunkloom.sources.sinks import points

_COLUMNS = ["doc_id", "source", "window_index", "chunk_index", "title", "summary", "level", "chunk_type", "content", "producer"]


def accepted_input(md: DataFrame) -> DataFrame:
    """``user_id, doc_id, source, markdown`` of rows that can be ingested, one for each ``doc_id``."""
    rows = md.filter(input_error(md).isNull()).select("user_id", "doc_id", "source", "markdown")
    one = F.min_by(F.struct("user_id", "source", "markdown"), F.xxhash64("user_id", "source", "markdown")).alias("r")
    return rows.groupBy("doc_id").agg(one).select("r.user_id", "doc_id", "r.source", "r.markdown")


def _users(md: DataFrame) -> DataFrame:
    """``doc_id, user_id`` of :func:`accepted_input`, without moving the texts."""
    rows = md.filter(input_error(md).isNull()).select("doc_id", "user_id", F.xxhash64("user_id", "source", "markdown").alias("h"))
    return rows.groupBy("doc_id").agg(F.min_by("user_id", "h").alias("user_id"))


def _linked(md: DataFrame, provider: proposals.BoundaryProvider, use: Settings, count: TokenCounter) -> DataFrame:
    def linked() -> DataFrame:
        window_rows = settled(lambda: windows(md.select("doc_id", "source", "markdown"), use.window_budget_tokens, use.window_threshold_tokens, count))
        rows = settled(lambda: assembly.numbered(_chunk_rows(window_rows, provider, use, count)))
        return assembly.linked(rows, window_rows, count)

    return settled(linked)


def _chunk_rows(window_rows: DataFrame, provider: proposals.BoundaryProvider, use: Settings, count: TokenCounter) -> DataFrame:
    normal = window_rows.filter("not oversized")
    chunks, attempts = prompts.attempted(normal, provider, use.max_attempts, use.max_chunk_tokens, use.token_slack, use.gap_snap, count)
    failed = prompts.failed_documents(attempts).select("doc_id")
    agent = proposals.accepted(chunks, attempts).join(normal.select("doc_id", "window_index", "source"), ["doc_id", "window_index"]).withColumn("producer", F.lit("agent"))
    rule = assembly.fallback_chunks(proposals.exhausted(normal, attempts), use.splitter_min_tokens, use.max_chunk_tokens, count)
    rows = agent.select(*_COLUMNS).unionByName(rule.select(*_COLUMNS)).unionByName(assembly.oversized_chunks(window_rows).select(*_COLUMNS))
    return rows.join(failed, "doc_id", "left_anti")


def linked_chunks(md: DataFrame, provider: proposals.BoundaryProvider = proposals.propose_blocks, use: Settings | None = None, count: TokenCounter = chars4) -> DataFrame:
    """Windows, proposals, validation, fallback and assembly; documents that a provider's hard error ends are left out."""
    return _linked(accepted_input(md), provider, use or settings("azure"), count)


def ingested(md: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """``(chunks, fallback)``: all linked chunks, and those of them that the rule splitter made."""
    chunks = stored(linked_chunks(md, **options))
    return chunks, chunks.filter("producer = 'fallback'")


def with_vectors(chunks: DataFrame, embed: vectors.Embedder, size: int, **options) -> DataFrame:
    """Linked chunks with ``vector``, ``embed_ok`` and ``sparse`` (indices, values) of their embedding texts."""
    chunks = stored(chunks)
    dense = vectors.dense_vectors(chunks.select("chunk_id", F.col("embedding_text").alias("text")), embed, size, **options).drop("text")
    sparse = vectors.sparse_vectors(chunks.select(F.col("chunk_id").alias("id"), F.coalesce("embedding_text", F.lit("")).alias("text")))
    sparse = sparse.select(F.col("id").alias("chunk_id"), F.struct("indices", "values").alias("sparse"))
    return chunks.join(dense, "chunk_id").join(sparse, "chunk_id", "left")


def ingest(md: DataFrame, provider: proposals.BoundaryProvider = proposals.propose_blocks, use: Settings | None = None, count: TokenCounter = chars4, embed: vectors.Embedder | None = None) -> DataFrame:
    """Points of ``md(user_id, doc_id, source, markdown)`` with dense and sparse vectors."""
    use = use or settings("azure")
    chunks = with_vectors(_linked(accepted_input(md), provider, use, count), embed or vectors.hashed_embedder(use.vector_size), use.vector_size, token_cap=use.embed_token_cap)
    return points(chunks.join(_users(md), "doc_id"))


def rejected(md: DataFrame) -> DataFrame:
    """``doc_id, error`` of rows that cannot be ingested."""
    return md.select("doc_id", input_error(md).alias("error")).filter("error is not null")
