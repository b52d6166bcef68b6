import random
import re

import numpy as np
import pytest
import xxhash

from chunkloom.llm import simhash_dedup as m


def fingerprint(text):
    w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def classes(rows):
    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    find = lambda x: x if label[x] == x else find(label[x])
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_against_brute_force(docs):
    rng = random.Random(3)
    rows, base = [], [rng.choice(["Aé", "b", "Cc"]) + str(rng.randrange(300)) for _ in range(400)]
    for i in range(150):
        w = list(base) if i % 2 else [str(rng.randrange(999)) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            if w:
                w[rng.randrange(len(w))] = "x" + str(i)
        rows.append((i * 7 % 150, " ".join(w)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "ONE two"), (None, base[0]), (905, base[0]), (906, "the end " * 30000)]
    out = m.simhash_classes(docs(rows)).collect()
    got = sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in out), key=str)
    assert got == classes(rows)


@pytest.mark.parametrize("leaf, chunk", [(8, 16), (64, 4096), (10**6, 50)])
def test_trees_lose_no_link(spark, monkeypatch, leaf, chunk):
    monkeypatch.setattr(m, "LEAF_POINTS", leaf)
    monkeypatch.setattr(m, "CHUNK_POINTS", chunk)
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 1 << 62, 5, np.uint64)[rng.integers(0, 5, 700)] ^ (np.uint64(1) << rng.integers(0, 64, 700, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 40, 700, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 700, np.uint64)))
    edges = m.near_pairs(spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")).collect()
    label = {int(v): int(v) for v in x.view(np.int64)}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for e in edges:
        assert ((e.a ^ e.b) & (1 << 64) - 1).bit_count() >= 1
        label[find(e.a)] = find(e.b)
    near = np.argwhere(np.bitwise_count(x[:, None] ^ x[None]) <= 4)
    s = x.view(np.int64)
    assert all(find(int(s[i])) == find(int(s[j])) for i, j in near)
    want = list(range(len(x)))
    for i, j in near:
        a, b = want[i], want[j]
        want = [b if k == a else k for k in want]
    assert len(set(want)) == len({find(int(v)) for v in s})


@pytest.mark.parametrize("n", [5000, 40000])
def test_branches_are_entered_and_pruned(n):
    x = np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    forest = m.fitted_forest(x[: m.SAMPLE], n, 4)
    flips = np.zeros(n, np.uint64)
    rng = np.random.default_rng(1)
    for _ in range(4):
        flips |= np.uint64(1) << rng.integers(0, 64, n, np.uint64)
    met = np.zeros(n, bool)
    for tree in forest:
        assert tree.levels == int(np.ceil(np.log2(n / m.LEAF_POINTS))) >= 3
        point, leaf, home = tree.visits(x)
        assert np.array_equal(np.sort(point[home]), np.arange(n))  # one home each
        sizes = np.bincount(leaf[home], minlength=1 << tree.levels)
        assert (sizes > 0).mean() > 0.9 and sizes.max() < 4 * m.LEAF_POINTS
        assert len(point) < 0.8**tree.levels * n * (1 << tree.levels)  # the others are pruned
        homes = np.zeros(n, np.int64)
        homes[point[home]] = leaf[home]
        other, visited, _ = tree.visits(x ^ flips)
        met[other[homes[other] == visited]] = True
    assert met.all()  # who is at most 4 bits away visits the home in one tree at least


def test_empty_table(docs):
    assert m.simhash_classes(docs([])).collect() == []
