"""Mixing sources to target weights by cube-method balanced sampling.

*Targets.*  Sources, in order of their names, weigh 3, 1, 2, repeating, and share ``budget`` of all
words; no source is taken more than ``most`` times, what exceeds that is shared again by weight.

*Copies.*  A source whose target is r times its size takes every document floor(r) times and a
balanced sample once more, with inclusion probability r - floor(r).  The cube method draws the
sample: it moves the probabilities of three documents at a time along the null-space of two balancing
equations (words and documents), until one of them is 0 or 1; expectations never change.  Blocks of a
source's documents fly in parallel and leave two undecided documents each; these meet in the blocks of
the next level, until one block per source is left.  A block's large documents fly first, so that mostly small ones
are left; the last two land where the source's words come nearest the target.

A source with a third of all documents is many blocks; a block holds about ``BLOCK`` small rows without
texts.  One row per source (about 100 bytes) reaches the driver, which shares the targets among them in order, so a few
million sources are the limit; their plan is joined back by broadcast only where it is under Spark's own limit for that,
else by a shuffle.

Defined cases: null text has size 0; the null source is a source of its own, last in order; null ids
are kept; repeated rows are separate documents; a source of size 0 has target 0; draws depend only on
ids, texts and the seed, so that reruns agree; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm._store import materialize

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2.0
BLOCK = 1000
EPS = 1e-9
WORD_GAP = r"[\x20\x09-\x0D]+"


def word_count(text):
    """Number of words of a text column; null has none."""
    words = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.size(F.array_remove(words, "")).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> dict[str | None, float]:
    """The words to take of each source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    left, open_ = budget * sum(sizes.values()), list(names)
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            out |= share
            break
        for s in over:
            out[s] = most * float(sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def flight(p: list[float], size: list[float], rng: random.Random) -> list[float]:
    """Move ``p`` inside the cube, sums of p and of p*size kept, until two values at most are fractional."""
    x, pool, turn = list(p), [], 0
    while True:
        while len(pool) < 3 and turn < len(x):
            if EPS < x[turn] < 1 - EPS:
                pool.append(turn)
            else:
                x[turn] = float(round(x[turn]))
            turn += 1
        if len(pool) < 3:
            return x
        a, b, c = pool
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - x[i]) / d if d > 0 else x[i] / -d for i, d in zip(pool, u) if d)
        down = min(x[i] / d if d > 0 else (1 - x[i]) / -d for i, d in zip(pool, u) if d)
        step = up if rng.random() * (up + down) < down else -down
        for i, d in zip(pool, u):
            x[i] = min(1.0, max(0.0, x[i] + step * d))
            if x[i] < EPS or x[i] > 1 - EPS:
                x[i] = float(round(x[i]))
        pool = [i for i in pool if 0 < x[i] < 1]


def landing(x: list[float], size: list[float]) -> list[float]:
    """Round the fractional values so that the sum of x*size moves least."""
    open_ = [i for i, v in enumerate(x) if 0 < v < 1]
    moves = [(abs(sum(((m >> k & 1) - x[i]) * size[i] for k, i in enumerate(open_))), m) for m in range(1 << len(open_))]
    best = min(moves)[1]
    for k, i in enumerate(open_):
        x[i] = float(best >> k & 1)
    return x


def _fly(seed: int, last: bool):
    def of_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(_large=-rows["size"]).sort_values(["_large", "draw", "doc_id", "th"], kind="stable").drop(columns="_large")
        size = rows["size"].astype(float).tolist()
        x = flight(rows["p"].tolist(), size, random.Random(f"{seed}/{key}"))
        return rows.assign(p=landing(x, size) if last else x)

    return of_block


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """``doc_id, th, source, size, source_size, target, copies, taken`` for each row of ``docs(doc_id, text, source)``."""
    text = F.col("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"),
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"),
    )
    rows = materialize(rows, "sizes")
    spark = rows.sparkSession
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).collect()
    sizes = {r.source: int(r.source_size) for r in per_source}
    target = targets(sizes, weights, budget, most)
    plan = []
    for r in per_source:
        rate = target[r.source] / r.source_size if r.source_size else 0.0
        whole = int(rate + EPS)
        plan.append((r.source, int(r.source_size), target[r.source], whole, max(0.0, rate - whole), -(-int(r.n) // block)))
    plan = spark.createDataFrame(plan, "source string, source_size long, target double, whole int, p double, blocks int")
    joined = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    draw = F.xxhash64("doc_id", "th", F.lit(seed))
    joined = joined.withColumn("draw", draw).withColumn("block", F.pmod(draw, F.col("blocks")).cast("int"))
    fields = ["doc_id", "th", "source", "size", "source_size", "target", "whole", "p", "draw", "block"]
    sure = joined.filter(F.col("p") <= EPS).withColumn("p", F.lit(0.0)).select(*fields)
    still, blocks = joined.filter(F.col("p") > EPS).select(*fields), max([-(-int(r.n) // block) for r in per_source], default=1)
    done = [sure]
    while True:
        flown = still.groupBy("source", "block").applyInPandas(_fly(seed, blocks == 1), still.schema)
        flown = materialize(flown, "flown")
        done.append(flown.filter("p = 0 or p = 1"))
        if blocks == 1:
            break
        shrink = max(2, block // 2)
        still = flown.filter("p > 0 and p < 1").withColumn("block", F.floor(F.col("block") / shrink).cast("int"))
        blocks = -(-blocks // shrink)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    copies = (F.col("whole") + F.col("p")).cast("int")
    return out.select("doc_id", "th", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
