"""Toxicity by multiple-instance learning: documents are bags of sentences.

A sentence is toxic with probability sigmoid(bias + weights of its features); a document is toxic if
any sentence is (noisy-or).  Only documents are labelled; fitting the noisy-or to their labels finds
the sentences that explain them, which are then located in every text.

*Features* are lower-cased words and their beginnings of 3 to 6 letters, so that inflected forms share
evidence.  They are chosen by the likelihood-ratio statistic of document counts between the classes.

*Bounded training sample.*  At most ``sample`` labelled documents of each class, those with the least
hash of the id, are used (``SAMPLE`` by default); their feature counts are summed on the executors,
and at most ``FEATURES`` features and the sample's sparse sentences reach the driver.  Negative
examples are weighted back to their share of the labels.

*Scoring* is one pass over all texts without a shuffle; the broadcast model has ``FEATURES`` entries
at most.

Defined cases: null and empty texts have no sentence and score 0; a null id is scored and not held
out; labels that are null are ignored, of contradicting ones the toxic one counts; repeated rows are
scored alike; other columns are kept; an empty table gives an empty result.  Without labels of
both classes every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chunkloom.llm._store import materialize

SAMPLE = 4000
FEATURES = 4096
LEAST_STATISTIC = 16.0
OFFENDING = 0.5
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")
_CACHE = 500_000


def fold(doc_id, of: int = 5):
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def features(word: str) -> list[str]:
    return [word + "$"] + [word[:k] for k in range(3, min(6, len(word)) + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: list[Counter] = [Counter(), Counter()]
    for b in batches:
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            seen: set[str] = set()
            for w in set(_WORD.findall((text or "").lower())):
                seen.update(features(w))
            counts[toxic].update(seen)
        if sum(map(len, counts)) > 1_000_000:
            yield _counted(counts)
            counts = [Counter(), Counter()]
    yield _counted(counts)


def _counted(counts: list[Counter]) -> pa.RecordBatch:
    keys = list(counts[0] | counts[1])
    return pa.record_batch(
        [pa.array(keys, pa.string()), pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64())],
        names=["feature", "a", "b"],
    )


def _statistic(a, b, n_a: float, n_b: float):
    """Signed likelihood-ratio statistic of a feature in a of n_a toxic and b of n_b other documents."""

    def part(x, n, total, all_):
        return F.when(x > 0, x * F.log(x * all_ / (n * total))).otherwise(0.0)

    all_, with_ = n_a + n_b, a + b
    g = part(a, F.lit(n_a), with_, all_) + part(b, F.lit(n_b), with_, all_) + part(n_a - a, F.lit(n_a), all_ - with_, all_) + part(n_b - b, F.lit(n_b), all_ - with_, all_)
    return F.when(a / n_a > b / n_b, 2 * g).otherwise(0.0)


def _bags(batches: Iterator[pa.RecordBatch], index: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """``(toxic, plain, hits)``: sentences without features, and the features of each other one."""
    for b in batches:
        plain, hits = [], []
        for text in b.column("text").to_pylist():
            bags, rest = [], 0
            for s in _SENTENCE.findall((text or "").lower()):
                own = {index[f] for w in _WORD.findall(s) for f in features(w) if f in index}
                if own:
                    bags.append(sorted(own))
                else:
                    rest += 1
            plain.append(rest)
            hits.append(bags)
        yield pa.record_batch([b.column("toxic"), pa.array(plain, pa.int32()), pa.array(hits, pa.list_(pa.list_(pa.int32())))], names=["toxic", "plain", "hits"])


def fit(bags: list[tuple[int, int, list[list[int]]]], n_features: int, negative_weight: float, steps: int = 400, rate: float = 0.1, penalty: float = 1e-4) -> tuple[float, np.ndarray]:
    """Bias and weights that maximise the noisy-or likelihood of ``(toxic, plain, hits)`` bags (Adam, full batch)."""
    y = np.array([t for t, _, _ in bags], float)
    plain = np.array([p for _, p, _ in bags], float)
    per_doc = np.array([len(h) for *_, h in bags])
    sentences = [s for *_, h in bags for s in h]
    doc = np.repeat(np.arange(len(bags)), per_doc)
    row = np.repeat(np.arange(len(sentences)), [len(s) for s in sentences])
    col = np.array([f for s in sentences for f in s], int)
    weight = np.where(y > 0, 1.0, negative_weight)
    weight /= weight.sum()
    theta = np.full(n_features + 1, 0.5)
    theta[-1] = -6.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, bias = theta[:-1], theta[-1]
        z = bias + np.bincount(row, w[col], len(sentences))
        log_off = -np.logaddexp(0, z)
        p, p0 = np.exp(z + log_off), 1 / (1 + exp(-bias))
        clean = np.bincount(doc, log_off, len(bags)) + plain * log1p(-p0)
        some = -np.expm1(np.minimum(clean, -1e-12))
        pull = weight * np.where(y > 0, -np.exp(clean) / some, 1.0)
        by_sentence = pull[doc] * p
        grad = np.zeros_like(theta)
        grad[:-1] = np.bincount(col, by_sentence[row], n_features) + penalty * w
        grad[-1] = by_sentence.sum() + (pull * plain).sum() * p0
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return float(theta[-1]), theta[:-1]


class Model:
    """Scores texts; the weight of a word is kept for as many words as ``_CACHE``."""

    def __init__(self, bias: float, weights: dict[str, float]):
        self.bias, self.weights, self.cache = bias, weights, {}

    def word(self, w: str) -> float:
        known = self.cache.get(w)
        if known is None:
            if len(self.cache) >= _CACHE:
                self.cache.clear()
            known = self.cache[w] = sum(self.weights.get(f, 0.0) for f in features(w))
        return known

    def score(self, text: str | None) -> tuple[float, int, list[tuple[int, int, float]]]:
        """``(score, sentences, offending)``; offending sentences as (start, end, probability) in code points."""
        text = text or ""
        lower = text.lower()
        clean, n, offending, plain = 0.0, 0, [], 0
        if len(lower) != len(text):  # a few letters change length: positions are those of the text
            lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        for s in _SENTENCE.finditer(lower):
            n += 1
            shift = sum(map(self.word, _WORD.findall(s[0])))
            if not shift:
                plain += 1
                continue
            z = self.bias + shift
            p = 1 / (1 + exp(-z)) if z > -700 else 0.0
            clean += -log1p(exp(z)) if z < 700 else -z
            if p >= OFFENDING:
                offending.append((s.start(), s.end(), p))
        clean += -plain * log1p(exp(self.bias))
        return min(1.0, max(0.0, 1 - exp(clean))), n, offending


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = Model(*model.value)
    for b in batches:
        out = [model.score(t.as_py()) for t in b.column("text")]
        spans = [[{"start": s, "end": e, "p": p} for s, e, p in x[2]] for x in out]
        arrays = [pa.array([x[0] for x in out], pa.float64()), pa.array([x[1] for x in out], pa.int32()), pa.array(spans, _SPANS)]
        yield pa.record_batch([*b.columns, *arrays], names=[*b.schema.names, "score", "n_sentences", "offending"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[float, dict[str, float]]:
    """``(bias, weights)`` from the labelled rows of ``docs(doc_id, text)`` in ``labels(doc_id, toxic)``."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id")
    picked = known.filter("toxic = 1").orderBy(order).limit(sample).union(known.filter("toxic = 0").orderBy(order).limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    picked = materialize(texts.join(F.broadcast(picked), "doc_id").select("text", "toxic"), "labelled")
    n = {r.toxic: r["count"] for r in picked.groupBy("toxic").count().collect()}
    if not (n.get(0) and n.get(1)):
        return -1e9, {}
    counted = picked.mapInArrow(_count, "feature string, a long, b long").groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counted = counted.filter("a >= 3").withColumn("g", _statistic(F.col("a"), F.col("b"), float(n[1]), float(n[0])))
    best = counted.filter(F.col("g") >= LEAST_STATISTIC).orderBy(F.desc("g"), "feature").limit(FEATURES).collect()
    names = [r.feature for r in best]
    index = {f: i for i, f in enumerate(names)}
    bags = picked.mapInArrow(lambda it: _bags(it, index), "toxic int, plain int, hits array<array<int>>").collect()
    bags = sorted((r.toxic, r.plain, r.hits) for r in bags)
    bias, weights = fit(bags, len(names), (totals[0] / n[0]) / (totals[1] / n[1]))
    return bias, {f: float(w) for f, w in zip(names, weights) if w}


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``score double, n_sentences int, offending array<struct<start,end,p>>``, learnt from ``labels(doc_id, toxic)``.

    Columns of ``docs`` with these three names are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    rows = docs.drop("score", "n_sentences", "offending")
    schema = StructType(rows.schema.fields + StructType.fromDDL("score double, n_sentences int, offending array<struct<start:int,end:int,p:double>>").fields)
    return rows.mapInArrow(lambda it: _score(it, model), schema)
