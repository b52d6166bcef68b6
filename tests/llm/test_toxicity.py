import random

import pytest

from chunkloom.llm.toxicity import features, toxicity


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        s = [[rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(40)) for _ in range(8)] for _ in range(rng.randrange(1, 30))]
        if toxic:
            rng.choice(s)[3] = rng.choice(["vileness", "vilely", "nastiest"])
        rows.append((i, ". ".join(" ".join(x) for x in s)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learns_from_document_labels_and_locates_sentences(spark, docs):
    rows, labels = corpus(600)
    more = [(9001, "Clean words here. This one is VILELY put. More."), (9002, None), (9003, ""), (9004, "...\n!"), (None, "ab1"), (9005, "ab12 " * 60000), (0, rows[0][1])]
    table = spark.createDataFrame([*[x for x in labels if x[0] % 5], (9001, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    out = toxicity(docs(rows + more), table).collect()
    assert len(out) == len(rows) + len(more)
    by = {r.doc_id: r for r in out}
    truth = dict(labels)
    held = [i for i in truth if i % 5 == 0]
    assert sum((by[i].score >= 0.5) == truth[i] for i in held) >= 0.97 * len(held)
    hit = by[9001].offending
    assert by[9001].score > 0.5 and [(s.start, s.end) for s in hit] == [(17, 40)]
    assert by[9002].score == by[9003].score == by[9004].score == 0 and by[9005].score < 0.5
    assert all(0 <= r.score <= 1 for r in out)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)]])
def test_without_both_classes(spark, docs, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert [r.score for r in toxicity(docs([(1, "a b. c"), (2, "d")]), table).collect()] == [0, 0]
    assert toxicity(docs([]), table).collect() == []


def test_features():
    assert features("ab") == ["ab$"] and features("abcdefgh") == ["abcdefgh$", "abc", "abcd", "abcde", "abcdef"]
