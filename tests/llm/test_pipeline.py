"""The pipeline's stages against plain versions, each on what its predecessor kept."""

import random
import re

import pytest

import corpus_pipeline as p
from chunkloom.llm import mixing
from tests.llm.test_decontaminate import brute as plain_leaks
from tests.llm.test_line_dedup import brute as plain_lines
from tests.llm.test_simhash_dedup import classes as plain_classes


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefgh") + rng.choice("klmnopqr") + str(rng.randrange(99))
    items = [(i, " ".join(word() for _ in range(20))) for i in range(4)]
    rows, labels = [], []
    for i in range(260):
        lines = [" ".join(word() for _ in range(rng.randrange(5, 20))) + "." for _ in range(rng.randrange(1, 12))]
        if i % 3 == 0:
            lines[0] = "you vilest " + lines[0]
        if i % 40 == 7:
            lines.append(items[i % 4][1])
        if i % 10 == 9:
            lines = rows[-1][1].split("\n") + lines[:1]
        rows.append((i, "\n".join(lines), "en", f"s{i % 3}", 5))
        labels.append((i, 1, int(i % 3 == 0)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "s1", 0), (None, "no id here at all", "en", None, 3), (5, *rows[5][1:])]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, items


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, folder):
    d, items = folder
    docs = spark.read.parquet(f"{d}/documents.parquet").cache()
    columns = docs.columns
    before = rows_of(docs)

    docs = p.toxicity_filter(spark, docs, d).cache()
    assert docs.columns == columns
    after = rows_of(docs)
    assert all("vilest" not in (t or "") for _, t in after)
    assert sum("vilest" not in (t or "") for _, t in before) - len(after) <= 2

    lines = p.line_filter(spark, docs, d).cache()
    assert lines.columns == columns
    got = sorted(((r.doc_id, r.text or "", r.n_chars) for r in lines.collect()), key=str)
    assert got == sorted(((i, t, len(t)) for i, _, _, t in plain_lines(after)), key=str)

    given = rows_of(lines)
    near = p.simhash_filter(spark, lines, d).cache()
    assert near.columns == columns
    kept = {}
    for (i, t), (j, _, c) in zip(sorted(given, key=lambda r: (str(r[0]), r[1] or "")), plain_classes(sorted(given, key=lambda r: (str(r[0]), r[1] or "")))):
        assert i == j
        kept.setdefault(c if c is not None else "none", i)
    assert sorted((r.doc_id for r in near.collect()), key=str) == sorted((c if c != "none" else None for c in kept), key=str)

    given = rows_of(near)
    clean = p.decontamination(spark, near, d).cache()
    assert clean.columns == columns
    dirty = {x[0] for x in plain_leaks(given, items)}
    assert dirty and sorted((r.doc_id for r in clean.collect()), key=str) == sorted((i for i, _ in given if i not in dirty), key=str)

    mixed = p.mixing(spark, clean, d).collect()
    size = {}
    for r in clean.collect():
        size[r.source] = size.get(r.source, 0) + len(re.findall(r"[^ \t-\r]+", r.text or ""))
    target = mixing.targets(size)
    for s in size:
        assert abs(sum(r.taken for r in mixed if r.source == s) - target[s]) <= 250 and all(r.target == target[s] for r in mixed if r.source == s)


def test_run_equals_stages_and_clashing_columns(spark, folder):
    d, _ = folder
    out = sorted(map(str, p.run(spark, d).collect()))
    assert out and sorted(map(str, p.run(spark, d).collect())) == out
    docs = spark.read.parquet(f"{d}/documents.parquet").selectExpr("*", "1 score", "2 th", "3 kept_text", "4 n_removed", "5 _id", "6 fp", "7 `a.b`")
    for name, stage in p.STAGES[:-1]:
        got = stage(spark, docs, d)
        assert got.columns == docs.columns, name
        assert got.filter("score <> 1 or th <> 2 or kept_text <> 3 or _id <> 5").isEmpty()
    p.mixing(spark, docs, d).collect()


def test_empty(spark, folder):
    d, _ = folder
    docs = spark.read.parquet(f"{d}/documents.parquet").filter("doc_id < -1")
    for _, stage in p.STAGES:
        docs = stage(spark, docs, d)
        assert docs.collect() == []
