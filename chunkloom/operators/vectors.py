"""Sparse and dense vectors of texts, and cosine search."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chunkloom.functions.tokens import truncated

Embedder = Callable[[list[str]], np.ndarray]


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def sparse_bm25(texts: DataFrame, k: float = 1.2, b: float = 0.75) -> DataFrame:
    """``id, term, tf, weight``: BM25 document weights of the terms of ``texts(id, text)``.

    Texts are shuffled once, by id; terms are counted where they lie, and only lengths are shuffled for the mean length.
    """
    sizes = texts.select("id", F.size(terms(F.col("text"))).alias("n")).filter("n > 0")
    mean = sizes.groupBy("id").agg(F.sum("n").alias("length")).agg(F.avg("length").alias("mean"))
    rows = texts.select("id", "text").repartition("id").select("id", F.explode(terms(F.col("text"))).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    length = F.sum("tf").over(W.partitionBy("id").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    rows = rows.filter("id is not null").withColumn("length", length).join(F.broadcast(mean))
    weight = F.col("tf") * (k + 1) / (F.col("tf") + k * (1 - b + b * F.col("length") / F.col("mean")))
    return rows.select("id", "term", "tf", weight.alias("weight"))


def hashed_embedder(size: int) -> Embedder:
    """A deterministic stand-in for an embedding model: signed term hashes, unit length."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), size), np.float32)
        for row, text in zip(out, texts):
            for term in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(term.encode(), digest_size=8).digest(), "little")
                row[h % size] += 1 if h >> 63 else -1
            norm = np.linalg.norm(row)
            if norm:
                row /= norm
        return out

    return embed


def dense_vectors(
    texts: DataFrame, embed: Embedder, size: int, batch: int = 16, attempts: int = 3, token_cap: int = 8000, vocabulary: str | None = None, wait: float = 1.0
) -> DataFrame:
    """``texts(.., text)`` with ``vector`` and ``embed_ok``; texts whose batch fails get a zero vector.

    Errors whose message shows a limit or a server fault are tried again after 1, 2, 4 .. times ``wait`` seconds; any
    other fails the batch at once, and never the job.  Texts are cut at ``token_cap`` tokens of ``vocabulary``, a
    tokenizer's file, or of the estimate.  ``batch=1, attempts=1`` is the way of a local model.

    Defined cases: a null text is empty; repeated rows are embedded each; columns of these two names are replaced;
    an empty table gives an empty result.
    """
    texts = texts.drop("vector", "embed_ok")
    schema = StructType(texts.schema.fields + StructType.fromDDL("vector array<float>, embed_ok boolean").fields)

    def vectors(part: list[str]) -> tuple[np.ndarray, bool]:
        for turn in range(attempts):
            try:
                found = np.asarray(embed(truncated(part, token_cap, vocabulary)), np.float32)
                if found.shape == (len(part), size):
                    return found, True
                break
            except Exception as error:  # noqa: BLE001  the provider's own exception types are not known here
                said = str(error).lower()
                if turn + 1 == attempts or not any(x in said for x in ("429", "rate", "500")):
                    break
                time.sleep(wait * 2**turn)
        return np.zeros((len(part), size), np.float32), False

    def run(batches):
        for rows in batches:
            out, ok = [], []
            for at in range(0, len(rows), batch):
                found, fine = vectors(rows["text"].iloc[at : at + batch].fillna("").tolist())
                out += list(found)
                ok += [fine] * len(found)
            yield rows.assign(vector=pd.Series([v.tolist() for v in out], index=rows.index, dtype=object), embed_ok=pd.Series(ok, index=rows.index, dtype=bool))

    return texts.mapInPandas(run, schema)


def sparse_vectors(texts: DataFrame) -> DataFrame:
    """``id, indices, values``: the BM25 weights of each text as a sparse vector over 31-bit term hashes, in order of index."""
    weights = sparse_bm25(texts).select("id", F.xxhash64("term").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("i"), "weight")
    held = F.array_sort(F.collect_list(F.struct("i", "v")))
    rows = weights.groupBy("id", "i").agg(F.sum("weight").cast("float").alias("v")).groupBy("id").agg(held.alias("e"))
    return rows.select("id", F.transform("e", lambda x: x["i"]).alias("indices"), F.transform("e", lambda x: x["v"]).alias("values"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a) * dot(b, b)), F.lit(0.0))


_NEAR = 2e-9  # similarities are compared at nine digits
_ROUGH = 5e-5  # more than single precision errs by
_TILE = 1 << 22


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of rows, summed in order, as :func:`cosine` does."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def _by_length(ids: pa.Array, rows: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """``(places, matrix)`` of the vectors of each length, those with null elements without a matrix."""
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.combine_chunks()
    sizes, flat = rows.value_lengths().to_numpy(), rows.flatten()
    ends = np.cumsum(sizes)
    empty = np.zeros(len(flat) + 1, np.int64)
    empty[1:] = np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))
    holes = empty[ends] > empty[ends - sizes]
    values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    if holes.any():
        yield np.flatnonzero(holes), None
    for size in np.unique(sizes[~holes]):
        at = np.flatnonzero((sizes == size) & ~holes)
        yield at, values[(ends[at] - size)[:, None] + np.arange(size)]


class _Side:
    """Vectors of one length: their squared lengths, and unit rows in single precision; ``odd`` ones have no such row."""

    def __init__(self, at: np.ndarray, matrix: np.ndarray):
        with np.errstate(all="ignore"):
            self.at, self.matrix, self.square = at, matrix, _dots(matrix, matrix)
            self.odd = ~((self.square > 1e-60) & (self.square < 1e60))
            self.unit = np.where(self.odd[:, None], 0, matrix / np.sqrt(self.square)[:, None]).astype(np.float32)


class _Best:
    """The pairs that may be among the k nearest of their query: all down to the k-th similarity, of equal ones those of least id."""

    def __init__(self, n: int, k: int, ordered: bool):
        self.k, self.ordered, self.least = k, ordered, np.full(n, -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size, self.most = 0, 1 << 18

    def add(self, query: np.ndarray, similarity: np.ndarray, vec: np.ndarray) -> None:
        """Similarities of None are given as -inf, NaN as inf, which is their order."""
        self.parts.append((query, similarity, vec))
        self.size += len(query)
        if self.size > self.most:
            self.pruned()
            self.most = max(1 << 18, 2 * self.size)

    def pruned(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        query, similarity, vec = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((vec, -similarity, query) if self.ordered else (-similarity, query))
        query, similarity, vec = query[order], similarity[order], vec[order]
        place = np.arange(len(query))
        new = np.concatenate([[True], query[1:] != query[:-1]])
        rank = place - np.maximum.accumulate(np.where(new, place, 0))
        self.least[query[rank == self.k - 1]] = similarity[rank == self.k - 1]
        kept = similarity >= self.least[query] - _NEAR
        if self.ordered:
            new |= np.concatenate([[True], similarity[1:] != similarity[:-1]])
            kept &= place - np.maximum.accumulate(np.where(new, place, 0)) < self.k
        self.parts, self.size = [(query[kept], similarity[kept], vec[kept])], int(kept.sum())
        return self.parts[0]


def _similar(q: _Side, i: np.ndarray, v: _Side, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    with np.errstate(all="ignore"):
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            length = np.sqrt(q.square[a] * v.square[b])
            found = _dots(q.matrix[a], v.matrix[b]) / length
            found = np.where(np.isnan(found), np.inf, found)
            out[at : at + (1 << 16)] = np.where(length == 0, -np.inf, found)
    return out


def _nearest(batches: Iterator[pa.RecordBatch], asked, k: int) -> Iterator[pa.RecordBatch]:
    """``query_id, vec_id, similarity``: what one task's vectors can add to the k nearest of each query.

    Products of unit rows in single precision leave out what is surely farther than the k-th so far; the others'
    similarities are as :func:`cosine` gives them.
    """
    query_ids, groups, blind = asked.value
    n = len(query_ids)
    best, ids = None, None
    for b in batches:
        if not b.num_rows:
            continue
        column = b.column("vec_id")
        if best is None:
            whole = pa.types.is_integer(column.type)
            best = _Best(n, k, whole)
            schema = pa.schema([("query_id", query_ids.type), ("vec_id", column.type), ("similarity", pa.float64())])
            ids = []
        plain = whole and not column.null_count
        if whole and not plain:  # nulls come first in an order by id
            number = np.where(column.is_null().to_numpy(zero_copy_only=False), np.iinfo(np.int64).min, column.fill_null(0).to_numpy(zero_copy_only=False))
        else:
            number = column.to_numpy().astype(np.int64) if whole else sum(map(len, ids)) + np.arange(b.num_rows)
        if not whole:
            ids.append(column)
        sides = [(at, None if matrix is None else _Side(at, matrix)) for at, matrix in _by_length(column, b.column("embedding"))]
        for at, v in sides:
            own = None if v is None else next((q for q in groups if q.matrix.shape[1] == v.matrix.shape[1]), None)
            others = np.concatenate([blind, *(q.at for q in groups if q is not own)])  # these have no similarity
            few = np.sort(number[at])[:k] if whole else number[at]
            if len(others):
                best.add(np.repeat(others, len(few)), np.full(len(others) * len(few), -np.inf), np.tile(few, len(others)))
            if own is None:
                continue
            wide = max(1, min(len(v.at), 4096))
            tall = max(1, _TILE // wide)
            for lo in range(0, len(v.at), wide):
                right = slice(lo, lo + wide)
                for top in range(0, len(own.at), tall):
                    left = slice(top, top + tall)
                    rough = own.unit[left] @ v.unit[right].T
                    least = best.least[own.at[left]]
                    fresh = np.flatnonzero(np.isneginf(least))
                    if len(fresh) and rough.shape[1] > k and not (v.odd[right].any() or own.odd[left].any()):
                        least[fresh] = np.partition(rough[fresh], -k, axis=1)[:, -k] - _ROUGH
                    near = rough >= (least - _ROUGH)[:, None]
                    near[own.odd[left]] = True
                    near[:, v.odd[right]] = True
                    i, j = np.nonzero(near)
                    best.add(own.at[i + top], _similar(own, i + top, v, j + lo), number[v.at[j + lo]])
        best.pruned()
    if best is None:
        return
    query, similarity, vec = best.pruned()
    found = pa.chunked_array(ids).take(pa.array(vec)) if ids else pa.array(vec, mask=vec == np.iinfo(np.int64).min).cast(schema.field("vec_id").type)
    found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
    value = pa.array(np.where(np.isposinf(similarity), np.nan, similarity), mask=np.isneginf(similarity), from_pandas=False)
    yield pa.record_batch([query_ids.take(pa.array(query)), found, value], schema=schema)


def topk_cosine(queries: DataFrame, vectors: DataFrame, k: int = 10, broadcast_rows: int = 1 << 16) -> DataFrame:
    """``query_id, vec_id, similarity, rank`` of the k nearest ``vectors(vec_id, embedding)`` of each of ``queries``.

    The stated queries meet every vector, as products of matrices.  Up to ``broadcast_rows`` of them go to the executors
    at once; beyond it they go in blocks of that size.  Each task leaves what may be among a query's k best, so the
    rows that are ranked are few.

    Defined cases: vectors of another length or without length have no similarity and come last; a null embedding is
    left out; ties go by id; repeated rows are ranked each.
    """
    queries = queries.filter("embedding is not null").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    vectors = vectors.filter("embedding is not null").select("vec_id", "embedding")
    n = queries.count()
    blocks = max(1, -(-n // broadcast_rows))
    kind = f"query_id {queries.schema['query_id'].dataType.simpleString()}, vec_id {vectors.schema['vec_id'].dataType.simpleString()}, similarity double"
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc_nulls_last("similarity"), "vec_id"))
    out = None
    for b in range(blocks):
        some = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
        table = some.toArrow()
        ids, rows = table.column("query_id").combine_chunks(), table.column("query").combine_chunks()
        parts = list(_by_length(ids, rows))
        blind = np.concatenate([np.zeros(0, np.int64), *(at for at, matrix in parts if matrix is None)])
        asked = queries.sparkSession.sparkContext.broadcast((ids, [_Side(at, matrix) for at, matrix in parts if matrix is not None], blind))
        pairs = vectors.mapInArrow(lambda it, asked=asked: _nearest(it, asked, k), kind)
        best = pairs.withColumn("similarity", F.round("similarity", 9)).withColumn("rank", rank).filter(F.col("rank") <= k)
        out = best if out is None else out.unionByName(best)
    return out
