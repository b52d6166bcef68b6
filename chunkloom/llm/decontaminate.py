"""Search of short test items inside long documents by word-shingle containment.

An item leaks into a document if at least ``threshold`` of its distinct ``shingle``-word sequences
occur there.

*Size partitions.*  Items are partitioned by their number n of distinct shingles, from one power of two to
the next.  The MinHash sketch of an item is its k smallest shingle hashes, with one k for a partition up to
n = hi: k = hi - ceil(threshold * hi) + 1.  A document that holds ``threshold`` of an item's shingles lacks at
most k - 1, so it holds one of the sketch at least, and no leak is missed however long the document is.
(Sketching the long side as well, as for Jaccard similarity, would miss nearly all: a 30-shingle item
in a document of 20,000 agrees with it on one MinHash in 700.)  Each partition is probed by itself, with all
shingles of those documents that are large enough to hold ``threshold`` of its least item.

*Two ways to probe.*  While sketches and items' shingles, as the workers hold them, fit ``SKETCH_BYTES``, they go to the executors and the texts
are read once, without a shuffle; beyond it, documents' and items' shingle hashes are joined.

*Verification.*  A document that holds a sketch hash is compared with the item's whole shingle set,
as words and not as hashes.

Words are longest runs of characters other than space and ``\\t\\n\\v\\f\\r``, A-Z lower-cased.

Defined cases: null text is empty; items with fewer words than a shingle are one shingle of all their
words, and match where a document holds these in a row; items without words never match; rows equal
in id and text are one document (or item); a null id is kept as null; other columns are ignored; empty
tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm._store import keyed, same_doc
from chunkloom.llm._words import Words, words

THRESHOLD = 0.8
SHINGLE = 5
SKETCH_BYTES = 256 << 20
SHINGLE_BYTES = 128
_BITS = 22


def _shingles(w: Words, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first word, number of words, hash)`` of each shingle; documents with fewer words have one of all."""
    hashes = w.hashes()
    at, h = w.windows(hashes, shingle)
    n, parts = np.full(len(at), shingle), [(at, h)]
    few = np.flatnonzero((w.counts() > 0) & (w.counts() < shingle))
    sizes = [n]
    for k in range(1, shingle):
        at, h = w.windows(hashes, k)
        own = np.isin(at, w.first[few[w.counts()[few] == k]])
        parts.append((at[own], h[own] ^ np.uint64(k)))
        sizes.append(np.full(int(own.sum()), k))
    return np.concatenate([p[0] for p in parts]), np.concatenate(sizes), np.concatenate([p[1] for p in parts])


def size_part(n: int) -> int:
    """The partition of items with n distinct shingles: those from 2**part to 2**(part + 1) - 1."""
    return n.bit_length() - 1


def sketch_size(part: int, threshold: float) -> int:
    """Hashes in the sketches of a partition: as many as its largest items need."""
    most = (1 << part + 1) - 1
    return most - ceil(threshold * most - 1e-9) + 1


def _sketch_rows(batches: Iterator[pa.RecordBatch], shingle: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """``(item, th, n, part, h, k)``: the sketch of each item in its size partition; k words in the shingle."""
    for b in batches:
        for w in words(b.column("text"), lower=True):
            at, k, h = _shingles(w, shingle)
            order = np.argsort(w.doc[at], kind="stable")
            doc, k, h = w.doc[at][order], k[order], h[order]
            edges = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))
            out = []
            for s, e in zip(edges[:-1], edges[1:]):
                own = np.unique(h[s:e])
                part = size_part(len(own))
                out += [(w.start_row + doc[s], len(own), part, x, k[s]) for x in own[: sketch_size(part, threshold)]]
            rows = pa.array([x[0] for x in out], pa.int64())
            yield pa.record_batch(
                [b.column("doc_id").take(rows), b.column("th").take(rows), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int32()), pa.array(np.array([x[3] for x in out], np.uint64).view(np.int64)), pa.array([x[4] for x in out], pa.int32())],
                names=["item_id", "ith", "n", "part", "h", "k"],
            )


def _token_windows(w: Words, d: int, k: int) -> set[bytes]:
    lo, hi = w.first[d], w.first[d + 1]
    own = [w.data[s:e].tobytes() for s, e in zip(w.starts[lo:hi].tolist(), w.ends[lo:hi].tolist())]
    return {b" ".join(own[i : i + k]) for i in range(len(own) - k + 1)}


def exact_shingles(text: str, shingle: int) -> tuple[int, set[bytes]]:
    """``(k, set)``: an item's shingles as words, k words each."""
    for w in words(pa.array([text]), lower=True):
        k = min(shingle, int(w.counts()[0]))
        return k, _token_windows(w, 0, k) if k else set()
    return 0, set()


class _Probe:
    """Size partitions of sketch hashes in sorted order behind a bit table, and the exact shingles of their items."""

    def __init__(self, items: list[tuple], sketches: list[tuple], shingle: int, threshold: float):
        self.items = [(item, th, *exact_shingles(text, shingle)) for item, th, text in items]
        place = {(item, th): i for i, (item, th, *_) in enumerate(self.items)}
        entries = sorted((part, h & (1 << 64) - 1, k, place[item, th]) for item, th, part, h, k in sketches)
        self.lengths, self.shingle = sorted({e[2] for e in entries}), shingle
        self.table = np.zeros(1 << _BITS, bool)
        self.parts = []
        for part in sorted({e[0] for e in entries}):
            own = [e for e in entries if e[0] == part]
            h = np.array([e[1] for e in own], np.uint64)
            self.table[(h >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.parts.append((ceil(threshold * (1 << part) - 1e-9), h, [e[3] for e in own]))

    def candidates(self, w: Words) -> dict[int, set[int]]:
        """Items by row of the slice that share a sketch hash with it."""
        found: dict[int, set[int]] = defaultdict(set)
        hashes, counts = w.hashes(), w.counts()
        for k in self.lengths:
            at, h = w.windows(hashes, k)
            h = h if k == self.shingle else h ^ np.uint64(k)
            near = np.flatnonzero(self.table[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
            at, h = at[near], h[near]
            room = counts[w.doc[at]] - k + 1  # shingles of the document, repeats included
            for least, sketch, owner in self.parts:
                fit = np.flatnonzero(room >= least)
                left, right = np.searchsorted(sketch, h[fit], "left"), np.searchsorted(sketch, h[fit], "right")
                for i in np.flatnonzero(right > left):
                    found[int(w.doc[at[fit[i]]])].update(owner[left[i] : right[i]])
        return found


def _verified(w: Words, d: int, items: list[tuple]) -> list[tuple]:
    sets: dict[int, set[bytes]] = {}
    out = []
    for item, th, k, own in items:
        if k not in sets:
            sets[k] = _token_windows(w, d, k)
        out.append((item, th, len(own), len(own & sets[k])))
    return out


_OUT = "doc_id long, th long, item_id long, ith long, item_shingles long, shared long, containment double"


def _result(b: pa.RecordBatch, found: list[tuple], threshold: float) -> pa.RecordBatch:
    found = [x for x in found if x[3] and x[4] >= threshold * x[3] - 1e-9]
    rows = pa.array([x[0] for x in found], pa.int64())
    columns = [pa.array([x[i] for x in found], pa.int64()) for i in range(1, 5)]
    share = pa.array([x[4] / x[3] for x in found], pa.float64())
    return pa.record_batch([b.column("doc_id").take(rows), b.column("th").take(rows), *columns, share], names=["doc_id", "th", "item_id", "ith", "item_shingles", "shared", "containment"])


def _search(batches: Iterator[pa.RecordBatch], probe, threshold: float) -> Iterator[pa.RecordBatch]:
    probe = probe.value
    for b in batches:
        found = []
        for w in words(b.column("text"), lower=True):
            for d, items in probe.candidates(w).items():
                found += [(w.start_row + d, *x) for x in _verified(w, d, [probe.items[i] for i in sorted(items)])]
        yield _result(b, found, threshold)


def _all_shingles(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w in words(b.column("text"), lower=True):
            hashes = w.hashes()
            for k in range(1, shingle + 1):
                at, h = w.windows(hashes, k)
                h = h if k == shingle else h ^ np.uint64(k)
                rows = pa.array(w.start_row + w.doc[at])
                yield pa.record_batch([b.column("doc_id").take(rows), b.column("th").take(rows), pa.array(h.view(np.int64))], names=["doc_id", "th", "h"])


def _verify_pairs(batches: Iterator[pa.RecordBatch], shingle: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found, texts = [], b.column("item_text").to_pylist()
        item, ith = b.column("item_id").to_pylist(), b.column("ith").to_pylist()
        for w in words(b.column("text"), lower=True):
            for d in range(w.n_docs):
                row = w.start_row + d
                found += [(row, *x) for x in _verified(w, d, [(item[row], ith[row], *exact_shingles(texts[row], shingle))])]
        yield _result(b, found, threshold)


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """``doc_id, th, item_id, ith, item_shingles, shared, containment``: items of ``items(item_id, text)`` found in ``docs(doc_id, text)``."""
    spark, source, tests = docs.sparkSession, keyed(docs), keyed(items, "item_id").distinct()
    sketches = tests.mapInArrow(lambda it: _sketch_rows(it, shingle, threshold), "item_id long, ith long, n int, part int, h long, k int")
    # what the probe holds: each shingle's words, once as text and once as an object in a set
    bytes_ = tests.agg(F.sum(F.octet_length("text") * (shingle + 1) + F.size(F.split("text", r"[\x20\x09-\x0D]+")) * SHINGLE_BYTES)).first()[0] or 0
    if bytes_ <= sketch_bytes:
        held = [tuple(r) for r in tests.select("doc_id", "th", "text").collect()]
        rows = [tuple(r) for r in sketches.select("item_id", "ith", "part", "h", "k").collect()]
        probe = spark.sparkContext.broadcast(_Probe(held, rows, shingle, threshold))
        return source.mapInArrow(lambda it: _search(it, probe, threshold), _OUT).distinct()
    probes = source.mapInArrow(lambda it: _all_shingles(it, shingle), "doc_id long, th long, h long").distinct()
    pairs = probes.join(sketches.select("item_id", "ith", "h"), "h").select("doc_id", "th", "item_id", "ith").distinct()
    texts = tests.select(F.col("doc_id").alias("i"), F.col("th").alias("t"), F.col("text").alias("item_text"))
    pairs = pairs.join(texts, pairs["item_id"].eqNullSafe(texts["i"]) & (pairs["ith"] == texts["t"])).drop("i", "t")
    unique = source.distinct()
    both = pairs.join(unique, same_doc(pairs, unique)).select(pairs["doc_id"], pairs["th"], "item_id", "ith", "item_text", "text")
    return both.mapInArrow(lambda it: _verify_pairs(it, shingle, threshold), _OUT)
