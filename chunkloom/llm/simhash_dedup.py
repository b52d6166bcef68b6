"""Near-duplicate classes by SimHash: all pairs of fingerprints that differ in few bits, exactly.

*Fingerprints* are made in one pass: XXH64 of each word shingle, a bit set where over half of the
hashes have it.  Equal fingerprints collapse before any comparison, so a group of copies of any size
is one point.

*Vantage-point trees.*  The 64 bits are cut into ``radius`` blocks, and each block has a tree.  Two
fingerprints within ``radius`` bits are within one bit of each other in at least one block, so a tree
needs to look around a point by one bit only (by ``radius`` bits in one tree over all 64 it would visit 0.85 of
the branches at each split, by one bit in a block 0.69).  A node holds a vantage point and the median distance of
its points; those nearer go left, the others right.  A point's home is one leaf; by the triangle bound it
can have neighbours in a branch only if its distance to the vantage point is within one bit of the
branch's range, so it also visits the leaves that are left when all other branches are pruned.  Trees are
fitted on at most ``SAMPLE`` fingerprints (those of least hash), and are as deep as leaves of about
``LEAF_POINTS`` need; every fingerprint is sent through them.

*Leaves* are the shards: home points are compared with all visitors, exactly, over all 64 bits; sorted by
distance to one of them, only those within ``radius`` of each other's distance are.  A leaf with more than
``CHUNK_POINTS`` home points, counted before, is dealt to several tasks by home point, each of which
gets all visitors.  A task returns a spanning forest, never all of its pairs.

Defined cases: null text is an empty document (fingerprint 0); rows equal in id and text are one
document; a null id takes part in linking, and a component's id is its least non-null id; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm._components import components
from chunkloom.llm._store import keyed, materialize, release
from chunkloom.llm._words import Words, words

RADIUS = 4
SHINGLE = 4
SEED = 42
SAMPLE = 1 << 14
LEAF_POINTS = 1024
CHUNK_POINTS = 2048
MAX_LEVELS = 20
_STEP = 1 << 15


def _joined(w: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words of a slice joined by one space, and where each begins and ends there."""
    lengths = w.ends - w.starts + 1
    stops = np.cumsum(lengths)
    begins = stops - lengths
    out = w.data[np.minimum(np.repeat(w.starts - begins, lengths) + np.arange(stops[-1]), len(w.data) - 1)]
    out[stops - 1] = 32
    return out.tobytes(), begins, stops - 1


def fingerprints(w: Words, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The SimHash of each document of a slice (uint64)."""
    out = np.zeros(w.n_docs, np.uint64)
    if not len(w.starts):
        return out
    text, begins, ends = _joined(w)
    view, digest = memoryview(text), xxhash.xxh64_intdigest
    counts = w.counts()
    n = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    edges = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(w.n_docs), n)
    begin = w.first[doc] + np.arange(edges[-1]) - edges[doc]
    last = np.minimum(begin + shingle - 1, w.first[doc + 1] - 1)
    a, b = begins[begin].tolist(), ends[last].tolist()
    ones = np.zeros((w.n_docs, 64), np.int64)
    for at in range(0, len(a), _STEP):
        h = np.fromiter((digest(view[s:e], seed) for s, e in zip(a[at : at + _STEP], b[at : at + _STEP])), np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = doc[at : at + _STEP]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    bits = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little")
    return bits.view(np.uint64).ravel()


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w in words(b.column("text"), lower=True):
            fp = fingerprints(w, shingle, seed)
            yield pa.record_batch(
                [b.column(c).slice(w.start_row, w.n_docs) for c in ("doc_id", "th")] + [pa.array(fp.view(np.int64))],
                names=["doc_id", "th", "fp"],
            )


@dataclass
class Tree:
    """A vantage-point tree over some bits; node i has children 2i+1 and 2i+2, ``levels`` levels of nodes stand above the leaves."""

    mask: int
    radius: int
    levels: int
    vantage: np.ndarray
    limit: np.ndarray

    def visits(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(point, leaf, home)`` of every leaf that may hold points within the tree's radius of a point."""
        point, node, home = np.arange(len(fp)), np.zeros(len(fp), np.int64), np.ones(len(fp), bool)
        own = fp & np.uint64(self.mask)
        for _ in range(self.levels):
            d = np.bitwise_count(own[point] ^ self.vantage[node]).astype(np.int64)
            near = d <= self.limit[node]
            left, right = d - self.radius <= self.limit[node], d + self.radius > self.limit[node]
            home = np.concatenate([home[left] & near[left], home[right] & ~near[right]])
            node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
            point = np.concatenate([point[left], point[right]])
        return point, node - ((1 << self.levels) - 1), home


def fitted_tree(sample: np.ndarray, mask: int, radius: int, levels: int) -> Tree:
    """A tree whose nodes halve their part of a sample; of three vantage points the one with the fewest points at its boundary."""
    nodes = (1 << levels) - 1
    vantage, limit = np.zeros(nodes, np.uint64), np.full(nodes, 32, np.int64)
    held = {0: sample & np.uint64(mask)}
    for node in range(nodes):
        part = held.pop(node, np.zeros(0, np.uint64))
        best = None
        for v in part[[0, len(part) // 3, 2 * len(part) // 3]] if len(part) else []:
            d = np.bitwise_count(part ^ v).astype(np.int64)
            middle = int(np.median(d))
            for cut in (middle - 1, middle):
                larger = max(np.count_nonzero(d - radius <= cut), np.count_nonzero(d + radius > cut))
                if best is None or larger < best[0]:
                    best = larger, v, cut, d <= cut
        if best is None:
            continue
        _, vantage[node], limit[node], near = best
        held[2 * node + 1], held[2 * node + 2] = part[near], part[~near]
    return Tree(mask, radius, levels, vantage, limit)


def fitted_forest(sample: np.ndarray, n_points: int, radius: int) -> list[Tree]:
    """One tree for each block of bits, for ``n_points`` points."""
    blocks = max(1, radius)
    levels = min(MAX_LEVELS, max(0, int(np.ceil(np.log2(max(n_points, 1) / LEAF_POINTS)))))
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [fitted_tree(sample, m, radius // blocks, levels) for m in masks]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i]; label[x] becomes the least member of x's class."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (jump := label[label]).tolist() != label.tolist():
            label[:] = jump


def _leaf(fp: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the links of home points among the points of one leaf."""
    distance = np.bitwise_count(fp ^ fp[0])
    order = np.argsort(distance, kind="stable")
    x, d = fp[order], distance[order].astype(np.int64)
    label = np.arange(len(fp))
    mine = np.flatnonzero(home[order])
    for s in range(0, len(mine), 64):
        some = mine[s : s + 64]
        low, high = np.searchsorted(d, d[some[0]] - radius), np.searchsorted(d, d[some[-1]] + radius, "right")
        i, j = np.nonzero(np.bitwise_count(x[some][:, None] ^ x[None, low:high]) <= radius)
        _merge(label, some[i], j + low)
    tied = np.flatnonzero(label != np.arange(len(fp)))
    return x[tied], x[label[tied]]


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Spanning edges of each leaf; the rows of a leaf arrive together."""

    def edges(fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        a, b = _leaf(fp, home, radius)
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    now, held = None, []
    for batch in batches:
        leaf, home, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "home", "fp"))
        cuts = [0, *(np.flatnonzero(leaf[1:] != leaf[:-1]) + 1).tolist(), len(leaf)]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            if leaf[s] != now:
                if held:
                    yield edges(*map(np.concatenate, zip(*held)))
                now, held = leaf[s], []
            held.append((fp[s:e].view(np.uint64), home[s:e]))
    if held:
        yield edges(*map(np.concatenate, zip(*held)))


def _home_counts(batches: Iterator[pa.RecordBatch], forest: list[Tree]) -> Iterator[pa.RecordBatch]:
    """Home points of each leaf, leaves numbered through the trees."""
    width = 1 << forest[0].levels
    found = np.zeros(width * len(forest), np.int64)
    for b in batches:
        fp = b.column("fp").to_numpy().view(np.uint64)
        for t, tree in enumerate(forest):
            _, leaf, home = tree.visits(fp)
            found += np.bincount(leaf[home] + t * width, minlength=len(found))
    at = np.flatnonzero(found)
    yield pa.record_batch([pa.array(at), pa.array(found[at])], names=["leaf", "n"])


def _sent(batches: Iterator[pa.RecordBatch], forest: list[Tree], chunks: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Each point for each leaf that it visits, and for each chunk of that leaf; ``home`` in one chunk of one leaf of each tree."""
    width = 1 << forest[0].levels
    split = np.ones(width * len(forest), np.int64)
    for leaf, n in chunks.items():
        split[leaf] = n
    for b in batches:
        every = b.column("fp").to_numpy()
        for s in range(0, len(every), 1024):
            fp = every[s : s + 1024].view(np.uint64)
            for t, tree in enumerate(forest):
                point, leaf, home = tree.visits(fp)
                leaf = leaf + t * width
                times = split[leaf]
                row = np.repeat(np.arange(len(leaf)), times)
                chunk = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                own = (fp[point[row]] % times[row].astype(np.uint64)).astype(np.int64) == chunk
                columns = leaf[row] << 24 | chunk, home[row] & own, fp[point[row]].view(np.int64)
                yield pa.record_batch(list(map(pa.array, columns)), names=["leaf", "home", "fp"])


def forest_of(points: DataFrame, radius: int = RADIUS) -> list[Tree]:
    """Trees fitted on at most ``SAMPLE`` of ``points(fp)``."""
    n = points.count()
    sample = points.select("fp", F.xxhash64("fp").alias("h")).orderBy("h").limit(SAMPLE).collect()
    return fitted_forest(np.array([r.fp for r in sample], np.int64).view(np.uint64), n, radius)


def near_pairs(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` that span the classes of ``points(fp)``, distinct fingerprints linked at ``radius`` bits or fewer."""
    forest = forest_of(points, radius)
    counts = points.mapInArrow(lambda it: _home_counts(it, forest), "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))
    # one row a leaf at most, and only those of crowded leaves
    chunks = {r.leaf: -(-r.n // CHUNK_POINTS) for r in counts.filter(F.col("n") > CHUNK_POINTS).collect()}
    rows = points.mapInArrow(lambda it: _sent(it, forest, chunks), "leaf long, home boolean, fp long")
    rows = rows.repartition("leaf").sortWithinPartitions("leaf")
    return rows.mapInArrow(lambda it: _links(it, radius), "a long, b long")


def simhash_classes(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, th, fp, component_id, root`` of each row of ``docs(doc_id, text)``; root, the least fingerprint of a class, names it."""
    spark = docs.sparkSession
    prints = keyed(docs).mapInArrow(lambda it: _fingerprint_batches(it, shingle, seed), "doc_id long, th long, fp long")
    prints = materialize(prints, "fingerprints")
    points = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    edges = materialize(near_pairs(points.select("fp"), radius), "links")
    release(spark)
    roots = components(edges).withColumnRenamed("node", "fp")
    members = materialize(roots.join(points, "fp"), "members")
    least = materialize(members.groupBy("root").agg(F.min("first").alias("least")), "least")
    linked = members.join(least, "root").select("fp", "root", "least")
    named = points.join(linked, "fp", "left").select("fp", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"), F.coalesce("root", "fp").alias("root"))
    return prints.join(materialize(named, "named"), "fp").select("doc_id", "th", "fp", "component_id", "root")
