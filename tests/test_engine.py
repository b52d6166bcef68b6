"""Written invariants and edge cases of the engine."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import bench
from chunkloom.config import Settings, settings
from chunkloom.functions import text as T
from chunkloom.operators import assembly, messages, packing, paragraphs, proposals, structure, vectors, windows
from chunkloom.operators.splitter import rule_split
from chunkloom.plans.ingest import ingest, linked_chunks, rejected
from chunkloom.queries import QUERIES
from chunkloom.sources import files, sinks
from chunkloom.streaming.jobs import Heartbeat, job_stream, run_jobs
from tests.conftest import SF

FENCE = "```"


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text", ["", "a", "a\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i j k", "\n\n", "x\n\ny", "😀 \n é"]
)
def test_lines_and_strip(spark, text):
    assert one(spark, T.plain_lines(F.lit(text))) == text.splitlines()
    assert one(spark, T.strip(F.lit(text))) == text.strip()
    assert "".join(r.line + r.mark for r in one(spark, T.split_lines(F.lit(text)))) == text


def test_uuid(spark):
    assert one(spark, T.uuid5(F.lit("doc|1|é"))) == uuid.uuid5(uuid.NAMESPACE_DNS, "doc|1|é").hex


def test_headings_and_sections(md):
    text = "pre\n# A\n## B\nbody\n#tag\nt\n#[[no\n####### deep\nd\n"
    found = structure.lines(md(text))
    assert rows(structure.headings(found), "title", "level") == [("# A", 1), ("## B", 2), ("####### deep", 7), ("#tag", 1)]
    out = rows(structure.sections(found), "section", "title", "content")
    assert out == [(0, None, "pre\n"), (2, "## B", "body\n"), (3, "#tag", "t\n#[[no\n"), (4, "####### deep", "d\n")]


@pytest.mark.parametrize(
    "text, want",
    [
        ("\n| t |\n\nfoo\n", [("table", "| t |\n"), ("text", "\n\nfoo\n")]),
        (f"{FENCE}\ncode\n", [("code", f"{FENCE}\ncode\n")]),
        (f"a\n{FENCE}\n\n| x |\n{FENCE}\n{FENCE}\nb\n{FENCE}\n", [("text", "a\n"), ("code", f"{FENCE}\n\n| x |\n{FENCE}\n"), ("code", f"{FENCE}\nb\n{FENCE}\n")]),
        ("a\n| t |\n \n", [("text", "a\n"), ("table", "| t |\n")]),
    ],
)
def test_typed_blocks(md, text, want):
    out = structure.typed_blocks(structure.lines(md(text))).orderBy("ord").collect()
    assert [(r.chunk_type, r.content) for r in out] == want


def test_sentences_and_rows(spark):
    assert one(spark, packing.pack_sentences(F.lit("One. Two!  Three?\nFour"), F.lit(""), 3)) == ["One. Two!", "Three? Four"]
    assert one(spark, packing.pack_sentences(F.lit("aaaa bbbb\ncccc dddd"), F.lit(""), 3)) == ["aaaa bbbb", "cccc dddd"]
    assert one(spark, packing.pack_sentences(F.lit("x" * 50), F.lit(""), 3)) == ["x" * 50]
    table = "| h |\n| - |\n| 1 |\n| 2 |\n| 3 |"
    assert one(spark, packing.pack_rows(F.lit(table), F.lit(""), 6)) == ["| h |\n| - |\n| 1 |\n| 2 |", "| h |\n| - |\n| 3 |"]
    assert one(spark, packing.pack_rows(F.lit("| h |\n| - |"), F.lit(""), 1)) == ["| h |\n| - |"]


def test_splitter_links(md):
    text = "# X\nx1\n## Y\ny\n| a |\n# Z\nz\n## Y\nagain\n### W\nw\n"
    out = {r.ord: r for r in rule_split(md(text, text)).filter("doc_id = '0'").collect()}
    ids = {r.chunk_id for r in out.values()}
    name = {r.chunk_id: o for o, r in out.items()}
    assert len(ids) == len(out)
    assert [name.get(out[i].parent_chunk_id) for i in sorted(out)] == [None, 0, 0, None, 3, 4]
    assert [[name[x.chunk_id] for x in out[i].parent_titles] for i in sorted(out)] == [[0], [0, 4], [0, 4], [3], [3, 4], [3, 4, 5]]
    assert [name.get(out[i].next_chunk_id) for i in sorted(out)] == [1, 2, 3, 4, 5, None]
    assert [[name[x] for x in out[i].sibling_chunk_ids] for i in sorted(out)] == [[], [2], [1], [], [], []]
    assert out[5].embedding_text == "Z > Y > W\nw\n"


def test_windows_cover_and_paths(md):
    text = "\n\n# A\n\npara one\n\n## B\n\n" + "| t | x |\n" * 60 + "\nend words here\n"
    made = md(text, "short", "   ")
    out = windows.windows(made, 20, 10).collect()
    for doc, body in (("0", text), ("1", "short"), ("2", "   ")):
        own = sorted((r for r in out if r.doc_id == doc), key=lambda r: r.window_index)
        assert "".join(r.text for r in own) == body and [r.window_index for r in own] == list(range(len(own)))
        assert all(own[i].end == own[i + 1].start for i in range(len(own) - 1))
    big = [r for r in out if r.oversized]
    assert len(big) == 1 and big[0].leading_heading_path == ["A", "B"]
    chunk = assembly.oversized_chunks(windows.windows(made, 20, 10)).first()
    assert chunk.title == "B" and chunk.chunk_type == "table"


def test_paragraphs(spark, md):
    text = f"aa\n\nbb\n{FENCE}\ncode\n\nmore\n{FENCE}\ncc\n\n\n| t |\n\n" + "line of prose\n" * 6
    whole = md(text).select("doc_id", F.lit(0).alias("window_index"), F.col("markdown").alias("text"))
    out = [r.text for r in paragraphs.paragraphs(whole, 10, 40).orderBy("paragraph_id").collect()]
    assert out == ["aa\n\nbb\n", f"{FENCE}\ncode\n\nmore\n{FENCE}\n", "cc\n", "| t |\n", "line of prose\nline of prose\n", "line of prose\nline of prose\n", "line of prose\nline of prose\n"]
    prompt = paragraphs.rendered(paragraphs.paragraphs(whole, 10, 40)).first().prompt
    assert prompt.startswith("[P0] aa\n\nbb\n\n[P1] ")


def offer(spark, *attempts):
    return spark.createDataFrame([("0", 0, i + 1, a if a is None or isinstance(a, str) else json.dumps({"chunks": a})) for i, a in enumerate(attempts)], "doc_id string, window_index int, attempt int, args_json string")


def chunk(start, end, **more):
    return {"start": start, "end": end, "title": "t", "chunk_type": "text"} | more


def test_validation_names_the_first_stage_that_fails(spark, md):
    text = "0123456789 abcdefghij"
    window = md(text).select("doc_id", "source", F.lit(0).alias("window_index"), F.col("markdown").alias("text"), F.lit(False).alias("oversized"))
    missing = chunk(0, 21)
    del missing["title"]
    cases = [
        None, "{oops", "{}", [], [missing], [chunk(0, 21, chunk_type="list")], [chunk(0, 99)], [chunk(5, 5)], [chunk(0, 12), chunk(11, 21)],
        [chunk(0, 10)], [chunk(0, 10), chunk(16, 21)], [chunk(0, 10), chunk(13, 21)], [chunk(0, 21)], [chunk(0, 11), chunk(11, 21, title=None)],
    ]
    _, attempts = proposals.validated(offer(spark, *cases), window, max_tokens=5, slack=1.1)
    got = {r.attempt: list(r.error_reasons) for r in attempts.collect()}
    want = [["no tool call"], ["bad json"], ["missing chunks"], ["uncovered"], ["missing keys"], ["bad type"], ["bad range"], ["bad range"], ["overlap"], ["uncovered"], ["uncovered"], [], ["too large"], []]
    assert [got[i + 1] for i in range(len(cases))] == want


def test_repair_snap_and_first_valid(spark, md):
    window = md("  ab  cd   ef ").select("doc_id", "source", F.lit(0).alias("window_index"), F.col("markdown").alias("text"), F.lit(False).alias("oversized"))
    chunks, attempts = proposals.validated(offer(spark, "x", [chunk(0, 5), chunk(5, 9), chunk(9, 14)], [chunk(0, 14)]), window)
    out = proposals.accepted(chunks, attempts).orderBy("chunk_index").collect()
    assert [(r.start, r.end, r.content) for r in out] == [(2, 6, "ab  "), (6, 11, "cd   "), (11, 13, "ef")]
    assert proposals.exhausted(window, attempts).count() == 0
    _, bad = proposals.validated(offer(spark, "x", None), window)
    assert proposals.exhausted(window, bad).count() == 1


def test_by_paragraph(spark):
    spans = spark.createDataFrame([("0", 0, i, 10 * i, 10 * i + 10) for i in range(4)], "doc_id string, window_index int, paragraph_id int, start int, end int")
    cases = {1: [(0, 1), (2, 3)], 2: [(0, 1), (3, 3)], 3: [(0, 2), (2, 3)], 4: [(0, 9)], 5: [(0, 2)], 6: [(0, 1), (2, 1)], 7: [(0, None)]}
    data = [("0", 0, a, i, s, e) for a, pairs in cases.items() for i, (s, e) in enumerate(pairs)]
    ranges = spark.createDataFrame(data, "doc_id string, window_index int, attempt int, chunk_index int, start_paragraph int, end_paragraph int")
    out = proposals.by_paragraph(ranges, spans)
    assert {r.attempt: r.error for r in out.collect()} == {1: None, 2: "gap", 3: "overlap", 4: "out of range", 5: "short tail", 6: "start after end", 7: "not integers"}
    assert rows(out.filter("attempt = 1"), "start", "end") == [(0, 20), (20, 40)]


def test_pipeline_invariants(spark, md):
    texts = ["# A\n\n" + "words and more words. " * 30 + f"\n\n## B\n\n{FENCE}\nx\n{FENCE}\n\n| a | b |\n| - | - |\n| 1 | 2 |\n\ntail\n", "plain", ""]
    small = Settings(60, 10, 15, 80, 40, 8)
    made = md(*texts)
    out = linked_chunks(made, use=small).collect()
    ids = {r.chunk_id: r for r in out}
    assert len(ids) == len(out) and {r.doc_id for r in out} == {"0", "1"}
    for r in out:
        for other in [r.parent_chunk_id, r.prev_chunk_id, r.next_chunk_id, *r.sibling_chunk_ids, *[t.chunk_id for t in r.parent_titles]]:
            assert other is None or ids[other].doc_id == r.doc_id
        assert r.chunk_id not in r.sibling_chunk_ids and all(r.chunk_id in ids[s].sibling_chunk_ids for s in r.sibling_chunk_ids)
        if r.next_chunk_id:
            assert ids[r.next_chunk_id].prev_chunk_id == r.chunk_id and ids[r.next_chunk_id].ord == r.ord + 1
    again = linked_chunks(made.repartition(3), use=small).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert rows(rejected(made), "doc_id", "error") == [("2", "empty document")]


def test_sinks(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    assert rows(sinks.upserted(old, new, ["id"]), "id", "v") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(sinks.upserted(sinks.upserted(old, new, ["id"]), new, ["id"]), "id", "v") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(sinks.inserted(old, new, ["id"]), "id", "v") == [(1, "a"), (2, "b"), (3, "C")]
    assert rows(sinks.replaced(old, new, ["id"]), "id", "v") == [(1, "a"), (2, "B")]
    assert sinks.first_missing_key(["doc_id"]) == "source" and sinks.first_missing_key(list(sinks.PAYLOAD)) is None
    with pytest.raises(ValueError):
        sinks.points(spark.createDataFrame([("u", "c", "text")], "user_id string, chunk_id string, chunk_type string"))


def test_vectors(spark):
    texts = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None)], "id int, text string")
    assert rows(vectors.sparse_bm25(texts), "id", "term", "tf") == [(1, "a", 1), (1, "b", 2)]
    assert [r.embed_ok for r in vectors.dense_vectors(texts, vectors.hashed_embedder(8), 8).collect()] == [True] * 3

    def limited(_):
        raise RuntimeError("rate limit")

    out = vectors.dense_vectors(texts, limited, 4).collect()
    assert all(not r.embed_ok and r.vector == [0.0] * 4 for r in out)


def test_messages(spark):
    chat = spark.createDataFrame([(1, 0, "system", "s1"), (1, 1, "user", "u"), (1, 2, "tool", "x"), (1, 3, "system", "s2"), (2, 0, "user", "v")], "conv_id int, turn int, role string, text string")
    out = {r.conv_id: (r.system, [t.text for t in r.turns]) for r in messages.split_messages(chat).collect()}
    assert out == {1: ("s1\n\ns2", ["u"]), 2: ("", ["v"])}
    assert messages.tool_config([{"function": {"name": "f", "parameters": {"a": 1}}}], "f")["toolChoice"] == {"tool": {"name": "f"}}
    blocks = spark.createDataFrame([([("a", None, None), (None, "r", None), ("b", None, "t")],)], "b array<struct<text:string,reasoning:string,tool:string>>")
    r = blocks.select(messages.block_text(F.col("b")).alias("t"), messages.block_reasoning(F.col("b")).alias("r"), messages.block_tool(F.col("b")).alias("x")).first()
    assert (r.t, r.r, r.x) == ("ab", "r", "t")


def test_sources(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.md").write_text("# A\n\nb")
    assert rows(files.text_folder(spark, str(tmp_path / "d")), "doc_id", "markdown") == [("a.md", "# A\n\nb")]
    (tmp_path / "d" / "z.pdf").write_bytes(b"1")
    (tmp_path / "d" / "y.pdf").write_bytes(b"2")
    assert [r.path.rsplit("/", 1)[1] for r in files.first_files(spark, str(tmp_path / "d")).collect()] == ["y.pdf"]
    names = spark.createDataFrame([("a.docx",), ("b.pdf",), ("c.txt",)], "n string")
    assert [r.x for r in names.select(T.route(F.col("n")).alias("x")).collect()] == ["office", "pdf", "rename_to_pdf"]
    assert settings("aws").max_chunk_tokens == 1200 and pytest.raises(ValueError, settings, "none") and pytest.raises(ValueError, Settings, 0, 1, 1, 1, 1, 1)


def test_job_stream(spark, md, tmp_path):
    documents = md("# A\n\nhello there", "# B\n\nsecond", "bad", " ").cache()
    (tmp_path / "jobs").mkdir()
    for i, key in enumerate(["0", "1", "missing", "2", "3"]):
        (tmp_path / "jobs" / f"{i}.json").write_text(json.dumps({"job_id": f"j{i}", "user_id": "u", "object_key": key}))

    def fragile(rows):
        if not rows.filter("markdown = 'bad'").isEmpty():
            raise RuntimeError("cannot read")
        return ingest(rows)

    beat = Heartbeat()
    spark.streams.addListener(beat)
    for _ in range(2):  # a second run finds nothing new
        tables = run_jobs(job_stream(spark, str(tmp_path / "jobs"), 9), documents, fragile, str(tmp_path / "out"), str(tmp_path / "check"))
    spark.streams.removeListener(beat)
    assert rows(tables.status(), "job_id", "status", "msg") == [
        ("j0", "done", "success"), ("j1", "done", "success"), ("j2", "failed", "no such document"), ("j3", "failed", "cannot read"), ("j4", "failed", "empty document"),
    ]
    want = documents.filter("doc_id < 2")
    assert rows(tables.points.current(), "id") == rows(ingest(want), "id")
    assert rows(tables.finished.current(), "job_id", "body") == [("j0", '{"job_id":"j0"}'), ("j1", '{"job_id":"j1"}')]
    assert rows(tables.failed.current(), "job_id") == [("j2",), ("j3",), ("j4",)] and tables.callbacks.current().count() == 5
    record = tables.records.current().filter("id = 'j3'").first()
    assert (record.task.error, record.task.msg, record.time.tz) == (True, "cannot read", "Asia/Kolkata") and record.time.elapsed.startswith("00:0")

    # the document comes again, shorter: its older points go, the others stay
    shorter = spark.createDataFrame([("u", "0", "dir/f0.md", "new text")], documents.schema)
    (tmp_path / "jobs" / "9.json").write_text(json.dumps({"job_id": "j9", "user_id": "u", "object_key": "0"}))
    tables = run_jobs(job_stream(spark, str(tmp_path / "jobs"), 9), shorter, ingest, str(tmp_path / "out"), str(tmp_path / "check"))
    assert rows(tables.points.current(), "id") == rows(ingest(shorter.union(documents.filter("doc_id = '1'"))), "id")
    assert {p.content for p in [r.payload for r in tables.points.current().collect()]} >= {"new text"}
    assert tables.points.collections().first().distance == "cosine"


def test_stream_stops_when_told(spark, md, tmp_path):
    (tmp_path / "jobs").mkdir()
    for i in range(30):
        (tmp_path / "jobs" / f"{i}.json").write_text(json.dumps({"job_id": f"j{i}", "user_id": "u", "object_key": "0"}))
    tables = run_jobs(job_stream(spark, str(tmp_path / "jobs")), md("text"), ingest, str(tmp_path / "out"), str(tmp_path / "check"), go_on=lambda: not (tmp_path / "out" / "finished").exists())
    assert 1 <= tables.finished.current().count() < 30


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_streamed_points_equal_batch_points(spark):
    columns = ("collection", "id", "doc_id", "chunk_type", "token_count", "has_table", "digest", "vector_size", "embed_ok", "n_terms")
    assert rows(QUERIES["job_stream"](spark, SF), *columns) == rows(QUERIES["points"](spark, SF), *columns)


def test_bench_times_every_query():
    assert bench.chosen(entry.queries(), set()) == list(entry.queries())
    assert bench.chosen(entry.queries(), {"points"}) == ["points"]
