import random
import re
import tracemalloc
from collections import Counter

import pyarrow as pa

from chunkloom.llm import substring_dedup as m
from chunkloom.llm.substring_dedup import substring_dedup


def brute(rows, k):
    words = [re.findall(r"[^ \t-\r]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone |= set(range(i, i + k))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def run(df, **k):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(df, **k).collect()), key=str)


def test_against_brute_force(docs):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = [rng.choice("abcdefgé") + str(rng.randrange(40)) for _ in range(rng.randrange(0, 90))]
        if i % 3 == 0:
            a, n = rng.randrange(20), rng.randrange(8, 40)
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[a : a + n]
        rows.append((i, rng.choice([" ", "\n", "  ", "\t"]).join(w)))
    rows += [(500, rows[4][1]), (501, "z " * 100), (None, "q r s " * 30), (502, None), (503, ""), (504, " \n"), (9, rows[9][1]), (505, "one " * 20000)]
    got = run(docs(rows), min_words=12, seed_words=7)
    assert got == brute(rows, 12)
    assert sum(r[2] for r in got) > 500


def test_spans_are_maximal_and_end_with_their_document(docs):
    text = " ".join(f"w{i}" for i in range(40))
    out = substring_dedup(docs([(1, text), (2, text), (3, "a b " + text + " c")])).collect()
    assert sorted((r.doc_id, [tuple(s) for s in r.spans]) for r in out) == [(1, [(0, 40)]), (2, [(0, 40)]), (3, [(2, 42)])]


def test_empty_table(docs):
    assert run(docs([])) == []


def test_memory_of_a_batch_is_that_of_a_slice():
    rng = random.Random(3)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(150)) for _ in range(4000)]  # 4 MB
    numbers = pa.array(range(len(texts)), pa.int64())
    batch = pa.record_batch([numbers, numbers, pa.array(texts)], names=["doc_id", "th", "text"])
    tracemalloc.start()
    found = sum(b.num_rows for b in m._seeds(iter([batch]), 35, 12))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 4000
    assert peak < 16 << 20, peak
