import random
import re

import pytest

from chunkloom.llm import line_dedup as m


def brute(rows, t=0.8):
    order = sorted({(d is None, d or 0, x or "") for d, x in rows})
    seen, out = [], {}
    for none, d, text in order:
        kept, gone = [], 0
        for line in text.split("\n"):
            s = set(re.findall(r"[^ \t-\r]+", line))
            if s and any(len(s & o) >= t * len(s | o) - 1e-9 for o in seen):
                gone += 1
            else:
                kept.append(line)
            if s:
                seen.append(s)
        out[None if none else d, text] = (len(text.split("\n")), gone, "\n".join(kept))
    return sorted(((d, *out[d, x or ""]) for d, x in rows), key=str)


@pytest.mark.parametrize("hot", [2, 64])
def test_against_brute_force(docs, monkeypatch, hot):
    monkeypatch.setattr(m, "HOT_COUNT", hot)
    monkeypatch.setattr(m, "HOT_LOADS", 0)
    rng = random.Random(11)
    bases = [[rng.choice("abcdefgé") + str(rng.randrange(60)) for _ in range(rng.randrange(1, 70))] for _ in range(12)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(0, 8)):
            w = list(rng.choice(bases)) if rng.random() < 0.7 else [str(rng.randrange(500)) for _ in range(rng.randrange(0, 40))]
            for _ in range(rng.randrange(4)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(["new", "x", str(i)])
            rng.shuffle(w)
            lines.append(rng.choice([" ", "  ", "\t"]).join(w))
        rows.append((i * 37 % 60, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n \n\n"), (103, "a b c d e\nA b c d e\na b c d e"), (None, "a b c d e\nq"), (3, next(t for d, t in rows if d == 3)), (104, "w " * 50000)]
    out = m.line_dedup(docs(rows)).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in out), key=str) == brute(rows)
    assert sum(r.n_removed for r in out) > 100


def test_columns_stay_and_empty_table(docs):
    df = docs([(1, "a b\na b"), (2, "b a")])
    out = m.line_dedup(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed", "kept_text"]
    assert sorted((r.doc_id, r.kept_text, r.th) for r in out.collect()) == [(1, "a b", "x"), (2, "", "x")]
    assert m.line_dedup(docs([])).collect() == []


def test_few_heavy_buckets_do_not_raise_the_level_of_frequent_words():
    rare, heavy = 1 + 3 * 4, 1 + 3 * 16
    assert m._hot_level(bytes([rare] * 1000 + [heavy] * 24)) == m._hot_level(bytes([rare] * 1024))


def test_rarity_table_grows_with_the_input(docs, monkeypatch):
    rows = [(i, " ".join(f"w{(i * j) % 31}" for j in range(9))) for i in range(30)]
    assert m._rarity_bits(docs(rows)) == m.RARITY_BITS  # of no known size
    df = m.materialize(docs(rows), "rows")
    assert m._rarity_bits(m.keyed(df)) == m.RARITY_BITS
    monkeypatch.setattr(m, "RARITY_BITS", 6)
    monkeypatch.setattr(m, "RARITY_INPUT", 1)
    monkeypatch.setattr(m, "MOST_BITS", 11)
    assert m._rarity_bits(m.keyed(df)) > 6
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in m.line_dedup(df).collect()), key=str) == brute(rows)
