import random
import re

import pyarrow as pa
import pytest

from chunkloom.llm import decontaminate as m
from chunkloom.llm.decontaminate import leaks


def shingles(text, k):
    w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    k = min(k, len(w))
    return k, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()


def brute(rows, items, t=0.8, k=5):
    out = set()
    for d, text in rows:
        for i, item in items:
            n, own = shingles(item, k)
            if own:
                shared = len(own & (shingles(text, n)[1] if n == min(n, shingles(text, n)[0]) else set()))
                if shared >= t * len(own):
                    out.add((d, i, len(own), shared))
    return sorted(out, key=str)


@pytest.mark.parametrize("budget", [64 << 20, 0])
def test_against_brute_force(spark, docs, budget):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.randrange(5, 50)))) for i in range(60)]
    items += [(100, "Ab cd"), (101, None), (102, ""), (103, "solo"), (None, "x1 x2 x3 x4 x5 x6"), (7, items[7][1])]
    rows = []
    for i in range(150):
        w = [rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.randrange(0, 300))]
        for _ in range(rng.randrange(3)):
            part = items[rng.randrange(60)][1].split()
            if rng.random() < 0.5:
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = part
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w).upper()))
    rows += [(900, None), (901, ""), (902, "zz ab  CD solo"), (None, "x1 x2 x3 x4 x5 x6 x7"), (3, rows[3][1]), (903, "filler " * 50000 + items[0][1])]
    table = spark.createDataFrame([(i, t, 0, "e") for i, t in items], "item_id long, text string, doc_id int, extra string")
    got = [(r.doc_id, r.item_id, r.item_shingles, r.shared) for r in leaks(docs(rows), table, sketch_bytes=budget).collect()]
    assert sorted(got, key=str) == brute(rows, items)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks(docs([(1, "a b c d e f")]), none).collect() == []
    assert leaks(docs([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).collect() == []


def test_each_size_partition_is_reached_and_pruned(spark, docs):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(10**6))
    sizes = [1, 3, 6, 12, 25, 50, 100, 200, 400]
    items = [(i, " ".join(word() for _ in range(n + 4))) for i, n in enumerate(sizes)]
    rows = [(i, " ".join([word() for _ in range(30)] + text.split()[: -max(1, n // 6)] + ["end"])) for i, ((_, text), n) in enumerate(zip(items, sizes))]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    assert [x[0] for x in want] == [i for i in range(len(sizes)) if sizes[i] > 3] and {m.size_part(sizes[x[1]]) for x in want} == {2, 3, 4, 5, 6, 7, 8}
    assert sorted((r.doc_id, r.item_id, r.item_shingles, r.shared) for r in leaks(docs(rows), table).collect()) == want
    for part, n in ((2, 4), (4, 16), (8, 511)):  # one k for a partition is enough for all of its sizes
        assert m.sketch_size(part, 0.8) >= n - -(-8 * n // 10) + 1 and m.size_part(n) == part
    held = [(i, 0, t) for i, t in items]
    sketches = [r for b in m._sketch_rows(iter([pa.record_batch([pa.array([i for i, _ in items]), pa.array([0] * len(items)), pa.array([t for _, t in items])], names=["doc_id", "th", "text"])]), 5, 0.8) for r in zip(*[c.to_pylist() for c in b.columns])]
    probe = m._Probe(held, [(i, th, part, h, k) for i, th, _, part, h, k in sketches], 5, 0.8)
    short = " ".join(items[-1][1].split()[:40])  # holds sketch hashes of the largest item, but cannot hold 80% of it
    for w in m.words(pa.array([short, items[-1][1]]), lower=True):
        assert set(probe.candidates(w)) == {1}
