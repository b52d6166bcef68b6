import random
from collections import defaultdict

import pytest

from chunkloom.llm import mixing as m


def test_targets_share_again_what_a_source_cannot_give():
    got = m.targets({"b": 10, "a": 100, None: 1000})
    assert got == {"b": 20.0, "a": 200.0, None: 1445.0}
    got = m.targets({"a": 100, "b": 100, "c": 100, "d": 100})
    assert got["a"] == 200 and got["b"] == pytest.approx(200 / 3) and sum(got.values()) == pytest.approx(600)
    assert m.targets({}) == {} and m.targets({"a": 0}) == {"a": 0.0}


@pytest.mark.parametrize("equal", [False, True])
def test_flight_keeps_both_totals(equal):
    rng = random.Random(2)
    size = [float(5 if equal else rng.randrange(1, 500)) for _ in range(500)]
    p = [rng.random() for _ in size]
    x = m.flight(p, size, random.Random(1))
    assert sum(0 < v < 1 for v in x) <= 2
    assert sum(x) == pytest.approx(sum(p)) and sum(v * s for v, s in zip(x, size)) == pytest.approx(sum(v * s for v, s in zip(p, size)))


def test_flight_is_fair():
    """Each document's mean over many draws is its probability: steps go up and down in proportion."""
    p, total = [0.1, 0.9, 0.5, 0.3, 0.7, 0.5, 0.2], [0.0] * 7
    for k in range(6000):
        total = [t + v for t, v in zip(total, m.flight(p, [900.0, 1, 30, 4, 500, 6, 70], random.Random(k)))]
    assert all(abs(t / 6000 - v) < 0.025 for t, v in zip(total, p))


def test_targets_and_sample_against_plain_python(spark):
    """Sizes, targets and whole copies exactly; the sample's words within one document of each source's target."""
    rng = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(rng.choice([1, 3, 9, 30, 200]))), f"s{i % 4}") for i in range(1200)]
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(t.split())
    left, weight, target = 1.5 * sum(size.values()), {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size))}, {}
    while True:  # plain form of the sharing
        open_ = [s for s in size if s not in target]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * size[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * size[s]
        left = 1.5 * sum(size.values()) - sum(target.values())
    taken = defaultdict(int)
    for r in m.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=100).collect():
        assert r.size == len(rows[r.doc_id][1].split()) and r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert r.copies - int(target[r.source] / size[r.source] + 1e-9) in (0, 1) and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 200 for s in size)


def test_inclusion_probabilities_hold():
    hits = [0] * 6
    for k in range(4000):
        hits = [h + v for h, v in zip(hits, m.landing(m.flight([0.5] * 6, [1.0, 2, 3, 4, 5, 6], random.Random(k)), [1.0, 2, 3, 4, 5, 6]))]
    assert all(abs(h / 4000 - 0.5) < 0.25 for h in hits)


@pytest.mark.parametrize("block", [7, 1000])
def test_mix(spark, block):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(200))), rng.choice(["s1", "s1", "s1", "s2", "é", None])) for i in range(900)]
    rows += [(1, None, "s1"), (None, "a b", "s2"), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]), (7, "x", "empty"), (8, "", "zero")]
    df = spark.createDataFrame([(i, t, s, 3) for i, t, s in rows], "doc_id long, text string, source string, target int")
    out = m.mix(df, block=block).collect()
    assert len(out) == len(rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        assert r.taken <= 2 * r.size and r.taken == r.size * r.copies
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert target == pytest.approx(m.targets(dict(size))) and all(r.source_size == size[r.source] for r in out)
    assert all(abs(taken[s] - target[s]) <= 200 for s in size)
    again = m.mix(df.repartition(3), block=block).collect()
    key = lambda r: (str(r.doc_id), r.th, r.source or "", r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_empty_table(spark):
    assert m.mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
