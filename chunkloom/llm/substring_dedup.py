"""Removal of long word sequences that occur more than once (seed and extend).

*Seed.*  Every document is winnowed: of each run of ``min_words`` words, the smallest hash among its
``seed_words``-grams is an anchor.  Two equal runs of ``min_words`` words hold the same anchor at the
same place, so a repeat always shows as an anchor that occurs twice.  Documents are joined on
anchors; an anchor that occurs once ends there.

*Extend.*  To the right, an anchor carries a hash of the ``2 * min_words`` words from it on; where that
occurs twice as well, all windows in between are repeats; one occurrence of each such group stands for
the others below, so that copies of long texts need no more rows than they have anchors.  Around the other repeated anchors, both ways, every window of ``min_words`` words
that holds one is named by two independent 64-bit hashes; a window that occurs twice is a repeat.
Counting extends all pairs of occurrences at once: a passage with a million copies costs a million
rows, not its square, and counts are partly summed before the shuffle.

*Keep maximal repeats.*  Overlapping and touching repeated windows of a document merge into maximal
spans, which are removed.

Defined cases: null text is an empty document; documents below ``min_words`` words lose nothing;
rows equal in id and text are two documents (they repeat each other) with equal results; null ids
are kept; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm._store import discard, keyed, materialize, release, same_doc
from chunkloom.llm._words import words

MIN_WORDS = 35
SEED_WORDS = 12


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over x[i:i+width] for each i, the array taken as if its end were cut off."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.concatenate([op(x[:-step], x[step:]), x[-step:]])
        done += step
    return x


def anchors(at: np.ndarray, h: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Indices into ``at`` of winnowed seeds: smallest hash of any ``width`` consecutive seeds of a document."""
    n = len(at) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = _sliding(h, width, np.minimum)[:n]
    own = doc[at[:n]] == doc[at[width - 1 :]]
    padded = np.zeros(len(at) + width - 1, np.uint64)
    padded[width - 1 : width - 1 + n] = np.where(own, least, 0)
    return np.flatnonzero(_sliding(padded, width, np.maximum)[: len(at)] == h)


def _seeds(batches: Iterator[pa.RecordBatch], min_words: int, seed_words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, th = b.column("doc_id"), b.column("th")
        for w in words(b.column("text")):
            hashes = w.hashes()
            at, h = w.windows(hashes, seed_words)
            j = anchors(at, h, w.doc, min_words - seed_words + 1)
            at, h = at[j], h[j]
            far, g = w.windows(hashes, 2 * min_words, second=True)
            ahead = np.searchsorted(far, at)
            found = ahead < len(far)
            found[found] = far[ahead[found]] == at[found]
            long = np.zeros(len(at), np.uint64)
            long[found] = g[ahead[found]]
            rows = pa.array(w.start_row + w.doc[at])
            yield pa.record_batch(
                [ids.take(rows), th.take(rows), pa.array(w.position()[at].astype(np.int32)), pa.array(h.view(np.int64)), pa.array(long.view(np.int64), mask=~found)],
                names=["doc_id", "th", "pos", "h", "g"],
            )


def _lists(column: pa.Array, row: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row within the slice, value)`` of a list column's rows row..row+n-1; null is empty."""
    part = column.slice(row, n)
    return pa.compute.list_parent_indices(part).to_numpy(zero_copy_only=False), part.flatten().to_numpy(zero_copy_only=False)


def _covered(doc: np.ndarray, pos: np.ndarray, first: np.ndarray, counts: np.ndarray, before: int, after: int) -> np.ndarray:
    """Per word of the slice: whether it lies in pos-before..pos+after of its document for any given position."""
    change = np.zeros(int(first[-1]) + 1, np.int32)
    np.add.at(change, first[doc] + np.maximum(pos - before, 0), 1)
    np.add.at(change, first[doc] + np.minimum(pos + after + 1, counts[doc]), -1)
    return np.cumsum(change[:-1]) > 0


def _extensions(batches: Iterator[pa.RecordBatch], min_words: int, seed_words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, th, seeds, skip, stand = (b.column(c) for c in ("doc_id", "th", "seeds", "skip", "stand"))
        for w in words(b.column("text")):
            doc, pos = _lists(seeds, w.start_row, w.n_docs)
            near = _covered(doc, pos, w.first, w.counts(), min_words - seed_words, 0)
            doc, pos = _lists(skip, w.start_row, w.n_docs)
            near &= ~_covered(doc, pos, w.first, w.counts(), 0, min_words)
            doc, pos = _lists(stand, w.start_row, w.n_docs)
            near |= _covered(doc, pos, w.first, w.counts(), 0, min_words)
            hashes = w.hashes()
            at, h1 = w.windows(hashes, min_words)
            h2 = w.windows(hashes, min_words, second=True)[1]
            j = np.flatnonzero(near[at])
            rows = pa.array(w.start_row + w.doc[at[j]])
            yield pa.record_batch(
                [ids.take(rows), th.take(rows), pa.array(w.position()[at[j]].astype(np.int32)), pa.array(h1[j].view(np.int64)), pa.array(h2[j].view(np.int64))],
                names=["doc_id", "th", "pos", "h1", "h2"],
            )


def _cut(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hits, long = b.column("hits"), b.column("long")
        for w in words(b.column("text")):
            doc, pos = _lists(hits, w.start_row, w.n_docs)
            gone = _covered(doc, pos, w.first, w.counts(), 0, min_words - 1)
            doc, pos = _lists(long, w.start_row, w.n_docs)
            gone |= _covered(doc, pos, w.first, w.counts(), 0, 2 * min_words - 1)
            kept = np.flatnonzero(~gone)
            lengths = w.ends[kept] - w.starts[kept] + 1
            stops = np.cumsum(lengths)
            if len(kept):
                index = np.repeat(w.starts[kept] - (stops - lengths), lengths) + np.arange(stops[-1])
                out = w.data[np.minimum(index, len(w.data) - 1)]
                out[stops - 1] = 32
                out = out.tobytes()
            edges = np.concatenate([[0], stops])[np.searchsorted(kept, w.first)]
            texts = [out[a : e - 1].decode("utf-8", "replace") if e > a else "" for a, e in zip(edges[:-1], edges[1:])]
            turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            inner = w.first[1:-1][(w.first[1:-1] > 0) & (w.first[1:-1] < len(gone))]
            inner = np.unique(inner[gone[inner - 1] & gone[inner]]) if len(inner) else inner  # a span ends with its document
            turn = np.sort(np.concatenate([turn, inner, inner]))
            begin, end = turn[::2], turn[1::2]
            owner = w.doc[begin] if len(begin) else begin
            entries = pa.StructArray.from_arrays([pa.array((x - w.first[owner]).astype(np.int32)) for x in (begin, end)], names=["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(w.n_docs + 1)).astype(np.int32)), entries)
            total = np.concatenate([[0], np.cumsum(gone)])
            yield pa.record_batch(
                [b.column(c).slice(w.start_row, w.n_docs) for c in ("doc_id", "th")]
                + [pa.array(w.counts().astype(np.int64)), pa.array(total[w.first[1:]] - total[w.first[:-1]]), pa.array(texts, pa.string()), spans],
                names=["doc_id", "th", "n_words", "n_removed", "kept_text", "spans"],
            )


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS) -> DataFrame:
    """``doc_id, th, n_words, n_removed, kept_text, spans`` for each row of ``docs(doc_id, text)``.

    ``spans`` are the maximal removed runs as word indices, end exclusive.  The work is two passes
    that shuffle 8 to 16 bytes per anchor or window, and the joins that bring positions to their texts.
    """
    if not 1 <= seed_words <= min_words:
        raise ValueError("seed_words must lie between 1 and min_words")
    spark, source = docs.sparkSession, keyed(docs)
    seeds = source.mapInArrow(lambda it: _seeds(it, min_words, seed_words), "doc_id long, th long, pos int, h long, g long")
    seeds = materialize(seeds, "seeds")
    repeated = seeds.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    repeated = materialize(repeated, "repeats")  # a table, so that Spark can split a hot anchor's rows in the join
    release(spark)
    pairs = materialize(seeds.join(repeated, "h", "left_semi"), "repeated")
    discard(seeds, repeated)
    own = F.xxhash64("doc_id", "th")
    twice = pairs.filter("g is not null").groupBy("h", "g").agg(F.count("*").alias("n"), F.min(own).alias("stands")).filter("n > 1").drop("n")
    twice = materialize(twice, "long")
    both = pairs.join(twice, ["h", "g"], "left").withColumn("own", own)
    per_doc = both.groupBy("doc_id", "th").agg(
        F.collect_list("pos").alias("seeds"),
        F.collect_list(F.when(F.col("stands") != F.col("own"), F.col("pos"))).alias("skip"),
        F.collect_list(F.when(F.col("stands") == F.col("own"), F.col("pos"))).alias("stand"),
    )
    per_doc = materialize(per_doc, "anchors")
    discard(pairs, twice)
    del seeds, pairs, repeated, twice, both
    release(spark)
    held = source.join(per_doc, same_doc(source, per_doc)).select(source["doc_id"], source["th"], "text", "seeds", "skip", "stand")
    windows = held.mapInArrow(lambda it: _extensions(it, min_words, seed_words), "doc_id long, th long, pos int, h1 long, h2 long")
    windows = materialize(windows, "windows")
    del held
    release(spark)
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2")
    twice = materialize(twice, "windows2")
    release(spark)
    hits = windows.join(twice, ["h1", "h2"], "left_semi").groupBy("doc_id", "th").agg(F.collect_set("pos").alias("hits"))
    long = per_doc.select("doc_id", "th", F.concat("skip", "stand").alias("long")).filter(F.size("long") > 0)
    marks = hits.join(long, same_doc(hits, long), "full").select(
        F.coalesce(hits["doc_id"], long["doc_id"]).alias("doc_id"), F.coalesce(hits["th"], long["th"]).alias("th"), "hits", "long"
    )
    marks = materialize(marks, "marks")
    discard(windows, per_doc, twice)
    del windows, twice, hits
    release(spark)
    source = keyed(docs)
    joined = source.join(marks, same_doc(source, marks), "left").select(source["doc_id"], source["th"], "text", "hits", "long")
    return joined.mapInArrow(
        lambda it: _cut(it, min_words),
        "doc_id long, th long, n_words long, n_removed long, kept_text string, spans array<struct<start:int,end:int>>",
    )
