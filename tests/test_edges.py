"""Edge cases: nulls, repeated rows, empty tables, clashing names, long texts; and the seams to the outside."""

import html.parser
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from chunkloom.config import Settings
from chunkloom.functions import dates, tokens
from chunkloom.functions import text as T
from chunkloom.operators import links, packing, paragraphs, prompts, proposals, structure, vectors, windows
from chunkloom.operators.splitter import rule_split
from chunkloom.plans.ingest import ingest, ingested, linked_chunks
from chunkloom.sources import convert, files, shared, sinks
from tests.conftest import SF

SMALL = Settings(60, 10, 15, 80, 40, 8)
MD = "user_id string, doc_id string, source string, markdown string, title string, level int, ord long"


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def made(spark, *data):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([("u", d, "s/f.md", t, "x", 9, 7) for d, t in data], MD)


def test_repeated_null_and_empty_documents(spark):
    df = made(spark, ("a", "# T\nx\n"), ("a", "# T\nx\n"), (None, "# T\nlost\n"), ("b", None), ("c", ""), ("d", " \n\n"))
    assert rows(structure.lines(df), "doc_id", "line_no", "line") == [("a", 0, "# T"), ("a", 1, "x"), ("d", 0, " "), ("d", 1, "")]
    assert rows(rule_split(df), "doc_id", "content", "title") == [("a", "x\n", "# T")]
    assert rows(windows.blocks(df), "doc_id", "text") == [("a", "# T\nx\n")]
    out = windows.windows(df, 100, 50)
    assert rows(out, "doc_id", "window_index", "text") == [("a", 0, "# T\nx\n"), ("c", 0, ""), ("d", 0, " \n\n")]
    assert rows(linked_chunks(df), "doc_id", "content") == [("a", "# T\nx")]
    assert rows(ingest(df), "collection", "id") == rows(ingest(df.filter("doc_id = 'a'").limit(1)), "collection", "id")


def test_empty_tables(spark):
    none = made(spark).filter("false")
    for out in (structure.lines(none), structure.typed_blocks(structure.lines(none)), rule_split(none), windows.windows(none), ingest(none, use=SMALL), links.broken_links(linked_chunks(none))):
        assert out.collect() == []
    window = none.select("doc_id", F.lit(0).alias("window_index"), F.col("markdown").alias("text"), F.lit(False).alias("oversized"))
    assert paragraphs.paragraphs(window).collect() == [] and proposals.propose_paragraphs(window).collect() == []
    chunks, attempts = proposals.validated(proposals.propose_blocks(window), window)
    assert chunks.collect() == [] and attempts.collect() == []


def test_very_long_texts(spark):
    table = "| a | b |\n| - | - |\n" + "| 1 | 2 |\n" * 4000
    text = "# H\n\n" + "A sentence of words. " * 20000 + "\n\n" + table + "\n" + "line of prose here\n" * 4000 + "x" * 100000 + "\n"
    df = made(spark, ("a", text))
    chunks = shared.stored(linked_chunks(df, use=SMALL))
    got = chunks.select("content").collect()
    kept = lambda s: re.sub(r"\s", "", s)
    assert sum(len(kept(r.content)) for r in got) >= len(kept(text)) - 2 and links.broken_links(chunks).isEmpty()
    window = df.select("doc_id", F.lit(0).alias("window_index"), F.col("markdown").alias("text"))
    spans = paragraphs.paragraphs(window, 400, 1200).orderBy("paragraph_id").collect()
    assert all(text[r.start : r.end] == r.text for r in spans) and kept("".join(r.text for r in spans)) == kept(text)
    pieces = df.select(packing.pack_sentences(F.col("markdown"), F.lit(""), 50).alias("p")).first().p
    assert kept("".join(pieces)) == kept(text)


def window_rows(spark, *texts):
    data = [("u", str(i), "s/f.md", t, "x", 9, 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, MD)
    return df.select("doc_id", "source", F.lit(0).alias("window_index"), F.col("markdown").alias("text"), F.lit(False).alias("oversized"), F.array(F.lit("A"), F.lit("B")).alias("leading_heading_path"))


def answer(*chunks):
    return json.dumps({"chunks": [{"start": a, "end": b, "title": "t", "chunk_type": "text"} | more for a, b, more in chunks]})


def test_attempts_are_corrected(spark):
    """The first answer leaves a gap, the second mends it; a limit is tried again; a hard error ends its document."""

    def model(messages):
        system, user = messages[0]["content"], messages[1]["content"]
        assert "A > B" in user and "Length of the text in characters: " in user
        if "hard" in user:
            raise ValueError("no such deployment")
        if "limited" in user and "could not be used" not in system:
            raise RuntimeError("429 too many")
        if "never" in user:
            return "{oops"
        return answer((0, 5, {}), (5, 11, {})) if "uncovered" in system or "provider error" in system else answer((0, 5, {}))

    texts = ("hello world", "limited tex", "never ready", "hard  error")
    chunks, attempts = prompts.attempted(window_rows(spark, *texts), prompts.by_offsets(model, permits=2))
    got = {(r.doc_id, r.attempt): (r.is_valid, list(r.error_reasons)) for r in attempts.collect()}
    assert got == {
        ("0", 1): (False, ["uncovered"]), ("0", 2): (True, []), ("1", 1): (False, ["provider error"]), ("1", 2): (True, []),
        ("2", 1): (False, ["bad json"]), ("2", 2): (False, ["bad json"]), ("2", 3): (False, ["bad json"]), ("3", 1): (False, ["hard error"]),
    }
    assert rows(prompts.failed_documents(attempts), "doc_id") == [("3",)]
    assert rows(proposals.accepted(chunks, attempts), "doc_id", "chunk_index", "content") == [("0", 0, "hello "), ("0", 1, "world"), ("1", 0, "limit"), ("1", 1, "ed tex")]
    df = made(spark, *[(str(i), t) for i, t in enumerate(texts)])
    out, fallback = ingested(df, provider=prompts.by_offsets(lambda m: model([m[0], {"content": m[1]["content"].replace("(none)", "A > B")}]), permits=2))
    assert {(r.doc_id, r.producer) for r in out.collect()} == {("0", "agent"), ("1", "agent"), ("2", "fallback")} and {r.doc_id for r in fallback.collect()} == {"2"}


def test_answers_by_paragraph(spark):
    text = "one one one\n\ntwo two two\n\nthree three\n"

    def model(messages):
        assert "[P0] one one one" in messages[1]["content"] and "3 paragraphs, [P0] to [P2]" in messages[1]["content"]
        said = messages[0]["content"]
        item = lambda a, b: {"start_paragraph": a, "end_paragraph": b, "title": "t", "chunk_type": "text", "summary": " s "}
        return json.dumps({"chunks": [] if "could not" not in said else [item(0, 0), item(2, 2)] if "empty" in said else [item(0, 1), item(2, 2)]})

    chunks, attempts = prompts.attempted(window_rows(spark, text), prompts.by_paragraphs(model, shortest=5, longest=100))
    assert [list(r.error_reasons) for r in attempts.orderBy("attempt").collect()] == [["empty chunks"], ["gap"], []]
    out = proposals.accepted(chunks, attempts).orderBy("chunk_index").collect()
    assert [(r.content.strip(), r.summary, r.level, r.has_text, r.metadata.keywords, r.metadata.summary) for r in out] == [("one one one\n\ntwo two two", "s", None, True, [], ""), ("three three", "s", None, True, [], "")]
    chunks, attempts = proposals.validated(proposals.propose_paragraphs(window_rows(spark, text, "| a |\n| b |\n"), 5, 100), window_rows(spark, text, "| a |\n| b |\n"))
    assert all(r.is_valid for r in attempts.collect()) and rows(chunks, "doc_id", "primary_type") == [("0", "text")] * 3 + [("1", "table")]


def test_metadata_is_filled(spark):
    offered = spark.createDataFrame([("0", 0, 1, answer((0, 11, {"metadata": {"keywords": ["k"]}, "summary": "\u00a0s\n"})))], "doc_id string, window_index int, attempt int, args_json string")
    r = proposals.validated(offered, window_rows(spark, "hello world"))[0].first()
    assert r.metadata.asDict() == {"summary": "", "document_type": "", "keywords": ["k"], "topics": [], "entities": [], "references": [], "questions": [], "action_items": []} and r.summary == "s"


def test_converter(spark):
    locked = b"%PDF-1.7 /Encrypt 5 0 R"
    office = bytes.fromhex("d0cf11e0") + "EncryptedPackage".encode("utf-16-le")
    data = [("d/a.md", b"# A"), ("d/b.pdf", locked), ("d/c.docx", office), ("d/e.txt", b"\xff\xfe"), ("d/f.pdf", None)]
    out = convert.converted(spark.createDataFrame(data, "path string, content binary"))
    assert rows(out, "path", "route", "status", "markdown") == [("d/a.md", "rename_to_pdf", "done", "# A"), ("d/b.pdf", "pdf", "encrypted", None), ("d/c.docx", "office", "encrypted", None), ("d/e.txt", "rename_to_pdf", "failed", None), ("d/f.pdf", "pdf", "failed", None)]


def test_times(spark):
    row = spark.range(1).select(dates.local_time(F.expr("timestamp'2024-03-01 20:00:05Z'")).alias("at"), dates.elapsed(F.lit("2024-03-01T20:00:05"), F.lit("2024-03-03T21:02:04")).alias("e")).first()
    assert (row["at"], row.e) == ("2024-03-02T01:30:05", "49:01:59")


def test_counters(spark):
    with pytest.raises(ValueError):
        tokens.counter_for("none")
    assert tokens.counter_for("azure") is tokens.chars4 and tokens.truncated(["abcdefghij"], 2) == ["abcdefgh"]
    for name in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"):
        path = f"/opt/tokenizers/{name}"
        if os.path.exists(path):
            count = tokens.counter_for("ollama", {"local": path})
            assert spark.createDataFrame([("hello world, hello",), (None,)], "t string").select(count("t").alias("n")).collect()[0].n == 4
            assert tokens.truncated(["hello world, hello"], 2, path) == ["hello world"]


def test_packing_without_a_length_counter_agrees(spark):
    slow = lambda c: F.ceil(F.length(c) / 4).cast("int")
    text = F.lit("One two. Three!  Four five six? Seven\u00a0eight. " * 5)
    table = F.lit("| h |\n| - |\n" + "".join(f"| {i} |\n" for i in range(30)))
    row = spark.range(1).select(packing.pack_sentences(text, F.lit("p"), 9).alias("a"), packing.pack_sentences(text, F.lit("p"), 9, slow).alias("b"), packing.pack_rows(table, F.lit("p"), 9).alias("c"), packing.pack_rows(table, F.lit("p"), 9, slow).alias("d")).first()
    assert row.a == row.b and len(row.a) > 3 and row.c == row.d and len(row.c) > 3


def test_vectors_survive_any_error(spark):
    texts = spark.createDataFrame([(i, "x", 1) for i in range(3)], "id int, text string, vector int")

    def broken(part):
        raise KeyError("no deployment")

    def odd(part):
        return [[1.0, 2.0]] * len(part)

    for embed in (broken, odd):
        out = vectors.dense_vectors(texts, embed, 4).collect()
        assert len(out) == 3 and all(not r.embed_ok and r.vector == [0.0] * 4 for r in out)
    sparse = vectors.sparse_vectors(spark.createDataFrame([(1, "b a b"), (2, "")], "id int, text string")).collect()
    assert len(sparse) == 1 and len(sparse[0].indices) == 2 and sparse[0].indices == sorted(sparse[0].indices)


def test_topk_in_blocks(spark):
    data = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)] + [(90, None), (91, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id int, embedding array<float>")
    whole = rows(vectors.topk_cosine(df.filter("vec_id < 20"), df, 3), "query_id", "vec_id", "rank")
    assert whole == rows(vectors.topk_cosine(df.filter("vec_id < 20"), df, 3, broadcast_rows=6), "query_id", "vec_id", "rank") and len(whole) == 60


def test_saved_documents_stay(spark, tmp_path):
    path = str(tmp_path / "md")
    files.write_markdown(made(spark, ("a.pdf", "one"), ("b", "two")), path, 0)
    files.write_markdown(made(spark, ("a.pdf", "new")).withColumn("user_id", F.lit("u")), path, 1)
    files.write_markdown(made(spark, ("a.pdf", "new")).withColumn("user_id", F.lit("u")), path, 1)  # tried again
    files.write_markdown(made(spark, ("a.pdf", "other's")).withColumn("user_id", F.lit("v")), path, 2)
    assert rows(files.saved_markdown(spark, path), "user_id", "doc_id", "file", "markdown") == [("u", "a.pdf", "a.md", "new"), ("u", "b", "b.md", "two"), ("v", "a.pdf", "a.md", "other's")]


def test_sent_in_batches(spark, tmp_path):
    out = str(tmp_path)

    def post(held):
        import uuid

        with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(held)))

    sinks.send(spark.range(25).select(F.lit("c").alias("collection"), "id"), "id", post, 10)
    sizes = [int(open(f"{out}/{f}").read()) for f in os.listdir(out)]
    assert sum(sizes) == 25 and max(sizes) <= 10
    parts = sinks.batches(spark.range(1000).select(F.lit("c").alias("collection"), "id"), "id", 10, parts=4)
    assert parts.groupBy("part", "batch").count().agg(F.max("count").alias("m"), F.sum("count").alias("n")).first() == (10, 1000)


def test_broken_links_are_named(spark):
    kind = "doc_id string, chunk_id string, parent_chunk_id string, prev_chunk_id string, next_chunk_id string, sibling_chunk_ids array<string>, parent_titles array<struct<chunk_id:string,title:string>>"
    df = spark.createDataFrame([("d", "a", None, None, "b", ["z"], [("a", "t")]), ("d", "b", "q", "a", None, [], [("y", "t")])], kind)
    assert rows(links.broken_links(df), "chunk_id", "kind", "target") == [("a", "sibling", "z"), ("b", "parent", "q"), ("b", "title", "y")]


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = type("C", (), {"get": staticmethod(lambda *a: None)}), Context

    with pytest.raises(ValueError):
        shared.fresh(Session, "tables")


class Page(html.parser.HTMLParser):
    """Headings, items and paragraphs of a page, by a real parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "head"):
            self.skip += 1
        elif tag in ("h1", "h2", "h3"):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag == "br":
            self.out.append("\n")
        elif tag in ("p", "div", "ul", "ol", "h4", "h5", "h6", "section", "article", "body", "html", "nav", "footer", "header"):
            self.out.append("\n\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "head"):
            self.skip -= 1
        elif tag in ("p", "div", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "body", "html", "nav", "footer", "header"):
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def plain(page):
    parser = Page()
    parser.feed(page)
    # white space is not what this test is about
    return re.sub(r"\s*\n\s*", "\n", re.sub(r"[ \t]+", " ", "".join(parser.out))).strip()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pages_against_a_parser(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("html", files.html_to_markdown(F.col("html")).alias("m")).collect()
    squeeze = lambda s: re.sub(r"\s*\n\s*", "\n", re.sub(r"[ \t]+", " ", s)).strip()
    assert [squeeze(r.m) for r in pages] == [plain(r.html) for r in pages]


def test_text_helpers(spark):
    row = spark.range(1).select(T.lstrip(F.lit("\u00a0 a ")).alias("a"), T.rstrip(F.lit(" a\u3000")).alias("b")).first()
    assert (row.a, row.b) == ("a ", " a")
