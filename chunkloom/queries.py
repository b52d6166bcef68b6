"""The registered queries of the engine and, where SQL can express them, their DuckDB equivalents.

Queries run over whole tables.  Long texts and arrays are compared by digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.config import Settings
from chunkloom.functions import text as T
from chunkloom.operators import links, messages, packing, paragraphs, proposals, structure, vectors, windows
from chunkloom.plans.ingest import ingest, linked_chunks
from chunkloom.sources import files, sinks
from chunkloom.sources.corpus import md_corpus
from chunkloom.sources.shared import fresh, stored
from chunkloom.streaming import jobs

#: Small budgets, so that every branch is taken on the test tables.
SMALL = Settings(150, 30, 40, 400, 300, 64)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _md(spark: SparkSession, sf_dir: str) -> DataFrame:
    return md_corpus(_table(spark, sf_dir, "documents"))


def lines(spark, sf):
    return structure.lines(_md(spark, sf)).select("doc_id", "line_no", "start", "end", F.length("line").alias("size"))


def headings(spark, sf):
    return structure.headings(structure.lines(_md(spark, sf))).select("doc_id", "line_no", "start", "title", "level")


def sections(spark, sf):
    return structure.sections(structure.lines(_md(spark, sf))).select("doc_id", "section", "title", "level", F.md5("content").alias("digest"))


def typed_blocks(spark, sf):
    return structure.typed_blocks(structure.lines(_md(spark, sf))).select("doc_id", "ord", "title", "level", "chunk_type", F.md5("content").alias("digest"))


def sentence_pack(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.withColumn("p", packing.pack_sentences(F.col("text"), F.lit("head"), 100))
    return rows.select("doc_id", F.size("p").alias("n_pieces"), F.md5(F.array_join("p", "|")).alias("digest"))


def table_pack(spark, sf):
    rows = _table(spark, sf, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name", "c_mktsegment"))).alias("c"))
    body = F.array_join(F.transform("c", lambda r: F.concat(F.lit("| "), r["c_name"], F.lit(" | "), r["c_mktsegment"], F.lit(" |"))), "\n")
    text = F.concat(F.lit("| name | segment |\n| --- | --- |\n"), body)
    out = rows.withColumn("p", packing.pack_rows(text, F.lit("customers"), 120))
    return out.select("c_nationkey", F.size("p").alias("n_pieces"), F.md5(F.array_join("p", "#")).alias("digest"))


def _rule_chunks(spark, sf):
    return packing.merge_runs(packing.split_oversized(structure.typed_blocks(structure.lines(_md(spark, sf))), 150), 40, 150)


def run_merge(spark, sf):
    blocks = structure.typed_blocks(structure.lines(_md(spark, sf))).drop("section")
    return packing.merge_runs(blocks, 40, 150).select("doc_id", "ord", "title", "level", "chunk_type", F.md5("content").alias("digest"))


def rule_chunks(spark, sf):
    return _rule_chunks(spark, sf).select("doc_id", "ord", "title", "level", "chunk_type", F.md5("content").alias("digest"))


def _blocks_with_ids(spark, sf):
    return links.with_ids(stored(structure.typed_blocks(structure.lines(_md(spark, sf))).drop("section")))


def chunk_ids(spark, sf):
    return _blocks_with_ids(spark, sf).select("doc_id", "ord", "chunk_id")


def seq_links(spark, sf):
    return links.with_neighbours(_blocks_with_ids(spark, sf)).select("doc_id", "ord", "prev_chunk_id", "next_chunk_id")


def siblings(spark, sf):
    rows = links.with_siblings(packing.runs(_blocks_with_ids(spark, sf), "title", "level"), "run")
    return rows.select("doc_id", "ord", F.array_join("sibling_chunk_ids", ",").alias("siblings"))


def parents(spark, sf):
    return links.with_parents(links.with_paths(_blocks_with_ids(spark, sf))).select("doc_id", "ord", "parent_chunk_id")


def title_paths(spark, sf):
    rows = links.with_titles(links.with_paths(_blocks_with_ids(spark, sf)))
    return rows.select("doc_id", "ord", F.array_join(F.transform("parent_titles", lambda t: F.concat(t["chunk_id"], F.lit("="), t["title"])), ">").alias("path"))


def blocks(spark, sf):
    return windows.blocks(_md(spark, sf)).select("doc_id", "block_no", "start", "end", "type", "tokens")


def window_packing(spark, sf):
    return windows.pack_windows(windows.blocks(_md(spark, sf)), 400)


def leading_paths(spark, sf):
    rows = windows.windows(_md(spark, sf), 400, 300)
    return rows.select("doc_id", "window_index", "start", "end", "token_count", "oversized", F.array_join("leading_heading_path", ">").alias("path"))


def paragraph_spans(spark, sf):
    whole = _md(spark, sf).select("doc_id", F.lit(0).alias("window_index"), F.col("markdown").alias("text"))
    return paragraphs.paragraph_bounds(paragraphs.paragraph_lines(whole), 400, 1200).select("doc_id", "paragraph_id", "start", "end")


def _scripted(spark, sf):
    """Windows of whole texts, and three attempts for each that differ in their faults by document number."""
    md = _md(spark, sf)
    whole = md.select("doc_id", "source", F.lit(0).alias("window_index"), F.col("markdown").alias("text"), F.lit(False).alias("oversized"))
    rows = windows.blocks(md).withColumn("n", F.col("doc_id").cast("long")).withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    fault = F.pmod(F.col("n") + F.col("attempt"), F.lit(7))
    start, end = F.col("start"), F.when((fault == 3) & (F.col("block_no") == 1), F.col("end") + 5).when((fault == 4) & (F.col("block_no") == 0), F.col("start") + 1).otherwise(F.col("end"))
    kind = F.when((fault == 2) & (F.col("block_no") == 0), "list").otherwise(F.col("type"))
    item = F.struct("block_no", start.alias("start"), end.alias("end"), F.when((fault != 5) | (F.col("block_no") != 0), "t").alias("title"), kind.alias("chunk_type"))
    lists = rows.groupBy("doc_id", "n", "attempt").agg(F.array_sort(F.collect_list(item)).alias("chunks"))
    fault = F.pmod(F.col("n") + F.col("attempt"), F.lit(7))
    args = F.when(fault == 0, F.lit("{oops")).when(fault == 1, F.lit('{"chunks": null}')).otherwise(F.to_json(F.struct("chunks")))
    return lists.select("doc_id", F.lit(0).alias("window_index"), "attempt", args.alias("args_json")), whole


def _validated(spark, sf):
    offered, whole = _scripted(spark, sf)
    return (*proposals.validated(stored(offered), whole, 150), whole)


def validation(spark, sf):
    _, attempts, _ = _validated(spark, sf)
    return attempts.select("doc_id", "attempt", "is_valid", F.array_join("error_reasons", ",").alias("reasons"))


def gap_snap(spark, sf):
    rows, _, _ = _validated(spark, sf)
    return rows.select("doc_id", "attempt", "chunk_index", "start", "end", "chunk_type")


def first_valid_attempt(spark, sf):
    _, attempts, _ = _validated(spark, sf)
    return attempts.filter("is_valid").groupBy("doc_id", "window_index").agg(F.min("attempt").alias("attempt"))


def fallback_windows(spark, sf):
    _, attempts, whole = _validated(spark, sf)
    return proposals.exhausted(whole, attempts).select("doc_id", "window_index")


def proposal_offsets(spark, sf):
    whole = _md(spark, sf).select("doc_id", F.lit(0).alias("window_index"), F.col("markdown").alias("text"))
    rows = stored(paragraphs.paragraph_bounds(paragraphs.paragraph_lines(whole), 400, 1200))
    n = F.col("doc_id").cast("long")
    pairs = rows.groupBy("doc_id", "window_index", F.floor(F.col("paragraph_id") / 2).cast("int").alias("chunk_index")).agg(F.min("paragraph_id").alias("a"), F.max("paragraph_id").alias("b"))
    ranges = pairs.select(
        "doc_id", "window_index", F.lit(1).alias("attempt"), "chunk_index", F.when((n % 5 == 1) & (F.col("chunk_index") == 1), F.col("a") + 1).when((n % 5 == 2) & (F.col("chunk_index") == 1), F.col("a") - 1).otherwise(F.col("a")).alias("start_paragraph"),
        F.when((n % 5 == 3) & (F.col("chunk_index") == 0), F.col("b") + 1000).otherwise(F.col("b")).alias("end_paragraph"),
    )
    return proposals.by_paragraph(ranges, rows).select("doc_id", "chunk_index", "start", "end", "error")


def assembled_chunks(spark, sf):
    rows = linked_chunks(_md(spark, sf), use=SMALL)
    return rows.select("doc_id", "ord", "chunk_id", "parent_chunk_id", "prev_chunk_id", "next_chunk_id", F.size("sibling_chunk_ids").alias("n_siblings"), F.size("parent_titles").alias("depth"), "producer", "token_count", F.md5("embedding_text").alias("digest"))


def _point_columns(rows):
    sparse = F.transform(F.coalesce("sparse.indices", F.array().cast("array<int>")), lambda i: i.cast("string"))
    return rows.select(
        "collection", "id", "payload.doc_id", "payload.chunk_type", "payload.token_count", "payload.has_table", F.size("payload.parent_titles").alias("depth"),
        F.md5("payload.content").alias("digest"), F.size("vector").alias("vector_size"), "embed_ok", F.size(sparse).alias("n_terms"),
    )


def points(spark, sf):
    return _point_columns(ingest(_md(spark, sf), use=SMALL))


def job_stream(spark, sf):
    """The points of ``points``, ingested from a stream of one job message for each document."""
    md, folder = stored(_md(spark, sf)), fresh(spark, "jobs")
    named = md.filter("doc_id is not null").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("job_id"), "user_id", F.col("doc_id").alias("object_key"))
    named.repartition(4, "job_id").write.json(f"{folder}/messages")
    tables = jobs.run_jobs(jobs.job_stream(spark, f"{folder}/messages", 4), md, lambda rows: ingest(rows, use=SMALL), f"{folder}/out", f"{folder}/checkpoint")
    return _point_columns(tables.points.current())


def embedding_text(spark, sf):
    rows = linked_chunks(_md(spark, sf), use=SMALL)
    return rows.select("chunk_id", F.length("embedding_text").alias("size"), F.md5("embedding_text").alias("digest"), "token_count")


def payload_check(spark, sf):
    """Links of the assembled chunks that lead nowhere, and payload keys that are missing: none."""
    rows = stored(linked_chunks(_md(spark, sf), use=SMALL))
    missing = sinks.first_missing_key(sinks.with_payload_defaults(rows).columns)
    broken = links.broken_links(rows).agg(F.count("*").alias("n_broken"))
    return broken.select("n_broken", F.lit(missing).cast("string").alias("missing_key"), F.lit(len(sinks.PAYLOAD)).alias("n_keys"))


def job_log(spark, sf):
    """Job records of orders: times in the records' zone, elapsed time, status messages."""
    rows = _table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("job_id"), F.col("o_custkey").cast("string").alias("user_id"), F.concat(F.lit("doc"), "o_orderkey").alias("doc_id"), F.when(F.col("o_orderstatus") == "F", "done").otherwise("failed").alias("status"), F.col("o_orderpriority").alias("msg"), "o_orderdate", "o_orderkey")
    start = F.from_utc_timestamp(F.col("o_orderdate").cast("timestamp"), F.current_timezone())  # the table's times are in UTC
    out = sinks.log_record(rows, start, start + F.make_interval(secs=F.col("o_orderkey") * 7))
    return out.select("id", "user_id", "doc", "task.error", "task.msg", "time.start", "time.elapsed", F.col("time.end").alias("end_"), "time.tz")


def job_messages(spark, sf):
    """Messages for the finished and the failed queue, and status callbacks."""
    rows = _table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("job_id"), F.col("o_custkey").cast("string").alias("user_id"), F.expr("case o_orderstatus when 'F' then 'done' when 'O' then 'failed' else 'started' end").alias("status"))
    finished, failed = sinks.notifications(rows)
    sent = finished.withColumn("queue", F.lit("finished")).unionByName(failed.withColumn("queue", F.lit("failed")))
    calls = sinks.callbacks(rows, "embedding").select(F.col("id").alias("job_id"), F.col("user-id").alias("user_id"), "stage", F.col("jobSuccessful").alias("ok"))
    return sent.join(calls, "job_id")


def payload_defaults(spark, sf):
    rows = sinks.with_payload_defaults(_blocks_with_ids(spark, sf))
    return rows.select("chunk_id", "primary_type", "has_text", "has_code", "has_table", F.col("split_group_id").isNull().alias("no_group"), "summary")


def retry_routing(spark, sf):
    rows = _table(spark, sf, "events").select("event_id", F.concat_ws(" ", "event_type", "props").alias("m"))
    return rows.select("event_id", T.is_retryable(F.col("m")).alias("retry"))


def sparse_bm25(spark, sf):
    texts = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return vectors.sparse_bm25(texts).select("id", "term", "tf", F.round("weight", 6).alias("weight"))


def dense_vectors(spark, sf):
    texts = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    out = vectors.dense_vectors(texts, vectors.hashed_embedder(64), 64)
    return out.select("id", F.size("vector").alias("size"), "embed_ok")


def topk_cosine(spark, sf):
    rows = _table(spark, sf, "embeddings")
    return vectors.topk_cosine(rows.filter("vec_id % 50 = 0"), rows, 5).select("query_id", "vec_id", "rank")


def upsert_latest(spark, sf):
    rows = _table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return sinks.latest(rows, ["user_id", "event_type"], "event_id")


def log_insert(spark, sf):
    rows = _table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey", "o_orderstatus")
    old = sinks.latest(rows.filter("o_orderstatus = 'F'"), ["id"], "o_orderkey")
    return sinks.inserted(old, sinks.latest(rows.filter("o_orderstatus = 'O'"), ["id"], "o_orderkey"), ["id"])


def log_replace(spark, sf):
    rows = _table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey", "o_orderstatus")
    old = sinks.latest(rows.filter("o_orderstatus = 'F'"), ["id"], "o_orderkey")
    return sinks.replaced(old, sinks.latest(rows.filter("o_orderstatus = 'O'"), ["id"], "o_orderkey"), ["id"])


def upsert_batches(spark, sf):
    rows = _table(spark, sf, "customer").select(F.col("c_nationkey").alias("collection"), F.col("c_custkey").alias("id"))
    return sinks.batches(rows, "id", 250)


def message_split(spark, sf):
    out = messages.split_messages(_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"))
    return out.select("conv_id", "system", F.size("turns").alias("n_turns"), F.md5(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), F.coalesce(t["text"], F.lit("")))), "|")).alias("digest"))


def html_markdown(spark, sf):
    out = _table(spark, sf, "pages").select("page_id", files.html_to_markdown(F.col("html")).alias("m"))
    return out.select("page_id", F.length("m").alias("size"), F.md5("m").alias("digest"))


def input_guards(spark, sf):
    rows = _table(spark, sf, "conversations").select(F.when(F.col("turn") % 3 != 0, F.col("role")).alias("user_id"), F.when(F.col("turn") % 2 == 0, F.col("conv_id").cast("string")).otherwise("").alias("doc_id"), F.when(F.col("turn") % 5 != 0, F.col("text")).otherwise(" ").alias("markdown"), "conv_id", "turn")
    return rows.select("conv_id", "turn", files.input_error(rows).alias("error"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        lines, headings, sections, typed_blocks, sentence_pack, table_pack, run_merge, rule_chunks, chunk_ids, seq_links, siblings, parents, title_paths, blocks,
        window_packing, leading_paths, paragraph_spans, validation, gap_snap, first_valid_attempt, fallback_windows, proposal_offsets, assembled_chunks, points, job_stream, embedding_text, payload_check, job_log, job_messages, payload_defaults,
        retry_routing, sparse_bm25, dense_vectors, topk_cosine, upsert_latest, log_insert, log_replace, upsert_batches, message_split, html_markdown, input_guards,
    )
}
