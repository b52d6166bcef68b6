import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chunkloom.llm import quality as m

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    gap = "[ \t\n\x0b\x0c\r]"
    w = re.findall(r"[^ \t\n\x0b\x0c\r]+", text)
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(g)
    lines = [x for x in text.split("\n") if re.sub(gap, "", x)]
    repeated = set().union(*[{i, i + 1, i + 2} for i, x in enumerate(g) if c[x] > 1]) if g else set()
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text), len(lines) - len(set(lines)), len(repeated)


def rows():
    rng = random.Random(3)
    out = [(i, "".join(rng.choice(["a", "bé", "c", "😀"]) + rng.choice([" ", "\n", "  ", "\t", " # ", "|", "! "]) for _ in range(rng.randrange(0, 200)))) for i in range(150)]
    prose = " ".join(f"word{i}" for i in range(80))
    return out + [(200, None), (201, ""), (202, prose), (203, "SHOUTING WORDS ARE LOUD " + prose.upper()), (204, prose.replace(" ", "!! ")), (None, prose), (202, prose), (205, "long one " * 20000), (206, " ".join(str(i) for i in range(30000)))]


@pytest.mark.parametrize("bits", [20, 2])
def test_measures_against_brute_force(docs, monkeypatch, bits):
    monkeypatch.setattr(m, "_POSITION_BITS", bits)
    monkeypatch.setattr(m, "_POSITIONS", 1 << bits)  # few bits: texts go the exact way
    given = [x for x in rows() if bits == 20 or len(x[1] or "") < 2000]
    out = m.quality(docs(given), NAMES).collect()
    got = sorted(((r.doc_id, *(r[n] for n in NAMES)) for r in out), key=str)
    assert got == sorted(((d, *brute(t)) for d, t in given), key=str)


def test_clashing_hashes_are_told_apart(docs, monkeypatch):
    monkeypatch.setattr(m.F, "xxhash64", lambda *c: m.F.lit(0).cast("long"))
    df = m.with_measures(m._rows(docs([(1, "a b c d a b c"), (2, "a b c d e f")])), ("n_repeat_words",))
    assert sorted((r.doc_id, r.n_repeat_words) for r in df.collect()) == [(1, 6), (2, 0)]


def test_verdict_does_not_depend_on_order(docs, monkeypatch):
    df = docs(rows())
    verdict = lambda: sorted(((r.doc_id, r.kept) for r in m.quality(df).collect()), key=str)
    first = verdict()
    monkeypatch.setattr(m, "cascade_order", lambda d, rules, sample: [(r, 1.0, 0.0) for r in reversed(rules)])
    assert verdict() == first
    kept = dict(first)
    assert kept[202] and not any(kept[i] for i in (200, 201, 203, 204, 205))


def test_order_is_by_rejections_per_step_and_stays(docs):
    df = docs(rows())
    first = [(r.name, c, s) for r, c, s in m.cascade_order(df)]
    assert first == [(r.name, c, s) for r, c, s in m.cascade_order(df.repartition(7))]  # and so the order in every run
    by = lambda d: sorted(((r.doc_id, r.rejected_by) for r in m.quality(d).collect()), key=str)
    assert by(df) == by(df.repartition(3))
    # rule 0 rejects most but dearly, rule 3 (exclamations) little but for next to nothing
    texts = [(0b0001, 1000, 100)] * 30 + [(0b1000, 1000, 100)] * 10 + [(0b1001, 1000, 100)] * 10 + [(0, 1000, 100)] * 50
    rules = tuple(m.RULES[i] for i in (1, 2, 4, 3))
    order = m.greedy_order(rules, texts)
    assert [r.name for r, _, _ in order][0] == "exclamations" and [s for _, _, s in order][0] == 0.2
    assert [(r.name, s) for r, _, s in order if s][1] == ("repeated_words", 30 / 80)  # of those that are left
    spent = dict((r.name, c) for r, c, _ in order)
    assert spent["symbols"] < m.WORK["n_symbols"][0] * 1000 + m.WORK["words"][0] * 1000  # words were known by then


def test_cascade_skips_what_is_decided(docs):
    """A dear measure is null for texts that a cheaper rule has rejected, until the caller asks for it."""
    df = m._rows(docs([(1, "few words"), (2, " ".join(f"word{i}" for i in range(80)))])).withColumn("rejected_by", F.lit(None).cast("string"))
    for rule in m.RULES[:2]:
        alive = F.col("rejected_by").isNull()
        df = m.with_measures(df, rule.needs, alive)
        df = df.withColumn("rejected_by", F.when(alive, F.when(rule.rejects(), F.lit(rule.name))).otherwise(F.col("rejected_by")))
    assert {r.doc_id: r.n_repeat_words for r in df.collect()} == {1: None, 2: 0}
    assert {r.doc_id: r.n_repeat_words for r in m.completed(df, ("n_repeat_words",)).collect()} == {1: 0, 2: 0}


def test_empty_table(docs):
    assert m.quality(docs([]), NAMES).collect() == []
