"""Secret scan: known shapes, and a randomness battery for strings of no known shape.

*Known shapes* (base spans): assignments to names such as ``token``, access key ids, long hex strings.

*Battery.*  Other unbroken runs of 16 or more characters are read in the narrowest encoding that fits
(hex, base32, base64 or its URL form) and tested as symbol sequences.  A run that mixes ``+ /`` with
``- _`` fits none; it is split at either pair, without path words at the ends, and its parts of 16 or
more characters are tested.  Of parts that overlap, the one of least p-value stands, doubled as the
choice was of two.

*Natural text* is the null hypothesis, fitted to the corpus itself: of all texts,
without the unbroken runs that may be secrets, the characters that an encoding's alphabet has give its symbol frequencies, mixed with ``EVEN`` of the uniform
ones to allow for names with digits and capitals, and stretches of ``STRETCH`` of them the spread of the other two
statistics.  (A corpus with fewer than ``LEAST_SYMBOLS`` of them takes those of plain prose, ``PROSE``.)  Only sums
leave the executors.  Each test asks how often natural text looks as random as the string:

- chi-squared uniformity over the alphabet: the statistic is linear in the number of equal symbol pairs; its
  lower tail is that of a gamma distribution with the mean and variance that pairs have under the frequencies;
- runs above and below the middle of the alphabet, as a standard score: the share of natural text with a score at
  most as far from 0;
- lag-one serial correlation, likewise.

The three p-values are combined by Simes' rule.  A string whose runs or serial score is itself beyond what random
strings show (``PATTERN``) is patterned, not random: its p-value is 1.

*Length-aware false-discovery control.*  Over the whole corpus, Benjamini-Hochberg limits are set in
each band of lengths separately, at ``fdr``.  They come from a histogram of p-values of fixed size
(``BINS`` per band), the only thing that reaches the driver.

Two passes over the texts without a shuffle, one for natural text; the rest works on the spans found.

Defined cases: null text is empty; offsets are code points, end exclusive; repeated rows get equal
results (each of them counts as a test); null ids are kept; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import erfc, exp, lgamma, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm._store import keyed, materialize
from chunkloom.llm._words import buffers, slices

# The shapes of base spans.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

KINDS = ("assign", "access", "hex")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
PARTS = re.compile(r"[A-Za-z0-9_-]{16,}={0,2}"), re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")
PATH_WORDS = re.compile(r"(?:(?:[a-z]+|[A-Z]+)?/)*")
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_CODES = {e: {c: i for i, c in enumerate(a)} for e, a in ALPHABETS.items()}
STRETCH = 32
UNIT = 1 << 20  # scores are summed in whole parts of one, so that sums do not depend on their order
EVEN = 0.1
LEAST_SYMBOLS = 2000
#: Sums of squares and cubes of symbol frequencies of plain prose, for corpora too small to tell.
PROSE = {"hex": (0.2, 0.06), "base32": (0.07, 0.007), "base64": (0.065, 0.006), "base64url": (0.065, 0.006)}
PATTERN = 1e-3
BANDS = (16, 24, 32, 48, 64)
BINS = 400
FDR = 0.01


def infer(token: str) -> tuple[str, str] | None:
    """``(encoding, symbols)`` of a string that may be encoded data; words of letters in one case are not."""
    body = token.rstrip("=")
    digits, letters = any(c.isdigit() for c in body), any(c.isalpha() for c in body)
    turns = sum(a.islower() and b.isupper() for a, b in zip(body, body[1:]))
    if not letters or not (digits or turns >= 3):
        return None
    for name, form in (("hex", body), ("hex", body.lower() if body.upper() == body else ""), ("base32", body), ("base64", body), ("base64url", body)):
        if form and all(c in _CODES[name] for c in form):
            return name, form
    return None


@dataclass(frozen=True)
class Null:
    """Natural text in one encoding: sums of squares and cubes of its symbol frequencies, mean and spread of both scores."""

    squares: float
    cubes: float
    runs: tuple[float, float]
    serial: tuple[float, float]


def null_of(name: str, counts: dict[int, float], scores: list[float]) -> Null:
    """Of an encoding, from symbol counts and (number, sum and sum of squares of the runs score, the same of the serial score)."""
    total, size = sum(counts.values()), len(ALPHABETS[name])
    share = [(1 - EVEN) * n / max(total, 1) + EVEN / size for n in counts.values()]
    n, *rest = scores

    def spread(s: float, ss: float) -> tuple[float, float]:
        return (s / n, max(sqrt(max(ss / n - (s / n) ** 2, 0)), 0.5)) if n >= 30 else (0.0, 1.0)

    squares, cubes = (sum(f * f for f in share), sum(f**3 for f in share)) if total >= LEAST_SYMBOLS else PROSE[name]
    return Null(min(squares, 0.9), cubes, spread(*rest[:2]), spread(*rest[2:]))


def lower_gamma(shape: float, x: float) -> float:
    """P(X <= x) of a gamma variable of scale 1, by its series."""
    if x <= 0:
        return 0.0
    term = total = 1 / shape
    for i in range(1, 2000):
        term *= x / (shape + i)
        total += term
        if term < total * 1e-14:
            break
    return min(1.0, total * exp(shape * log(x) - x - lgamma(shape)))


def statistics(encoding: str, symbols: str) -> tuple[int, float, float] | None:
    """``(equal pairs, runs score, serial score)``; None where all symbols lie on one side of the alphabet's middle."""
    x = [_CODES[encoding][c] for c in symbols]
    n, k = len(x), len(ALPHABETS[encoding])
    pairs = sum(c * (c - 1) // 2 for c in Counter(x).values())
    high = [v * 2 >= k for v in x]
    above = sum(high)
    below = n - above
    if not above or not below:
        return None
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 1 + 2 * above * below / n
    spread = sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    centre = sum(x) / n
    total = sum((v - centre) ** 2 for v in x)
    serial = sum((a - centre) * (b - centre) for a, b in zip(x, x[1:])) / total if total else 1.0
    return pairs, (runs - mean) / spread, (serial + 1 / n) * sqrt(n)


def _within(z: float, natural: tuple[float, float]) -> float:
    """Share of natural text whose score is at most as far from 0; scores are discrete, so none counts as nearer than a quarter."""
    mean, spread = natural
    z = max(abs(z), 0.25)
    upto = lambda v: 0.5 * erfc((mean - v) / spread / sqrt(2))
    return max(upto(abs(z)) - upto(-abs(z)), 0.0)


def tests(encoding: str, symbols: str, null: Null) -> tuple[float, float, float] | None:
    """The p-values of the three tests; None for strings that show a pattern."""
    found = statistics(encoding, symbols)
    if found is None:
        return None
    pairs, runs, serial = found
    if erfc(abs(runs) / sqrt(2)) < PATTERN or erfc(abs(serial) / sqrt(2)) < PATTERN:
        return None
    n = len(symbols)
    mean = n * (n - 1) / 2 * null.squares
    variance = n * (n - 1) / 2 * (null.squares - null.squares**2) + n * (n - 1) * (n - 2) * (null.cubes - null.squares**2)
    chi = lower_gamma(mean * mean / variance, (pairs + 0.5) * mean / variance)
    return chi, _within(runs, null.runs), _within(serial, null.serial)


def battery(encoding: str, symbols: str, nulls: dict[str, Null]) -> float:
    """The combined p-value of a string against natural text; 1 for strings that show a pattern."""
    found = tests(encoding, symbols, nulls[encoding])
    return 1.0 if found is None else min(1.0, *(3 * p / (i + 1) for i, p in enumerate(sorted(found))))


def _read_as(name: str) -> np.ndarray:
    """Of each byte, the symbol of natural text that an encoding reads it as, or -1."""
    out = np.full(256, -1, np.int8)
    for c, i in _CODES[name].items():
        if c not in "+/-_":
            for x in (c.upper(), c.lower()) if name in ("hex", "base32") else c:
                out[ord(x)] = i
    return out


_READ = {name: _read_as(name) for name in _CODES}
_RUN_BYTE = np.zeros(256, bool)
_RUN_BYTE[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True


def _plain_bytes(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether each byte lies outside of unbroken runs of 16 or more, texts being ``data[edges[i]:edges[i + 1]]``."""
    inside = np.concatenate([[False], _RUN_BYTE[data], [False]])
    opens, closes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cut = edges[(edges > 0) & (edges < len(data))]
    opens[cut] = inside[cut + 1]
    closes[cut - 1] = inside[cut]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = end - start >= 16
    change = np.zeros(len(data) + 1, np.int32)
    change[start[long]] += 1
    change[end[long]] -= 1
    return np.cumsum(change[:-1]) == 0


def _stretch_scores(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs and serial scores of :func:`statistics` of each row of symbols, without rows on one side of the middle."""
    n = x.shape[1]
    high = x * 2 >= size
    above = high.sum(axis=1)
    x, high, above = (v[(above > 0) & (above < n)] for v in (x, high, above))
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 1 + 2 * above * (n - above) / n
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    off = x - x.mean(axis=1)[:, None]  # both sides of the middle are there, so not all are equal
    serial = np.einsum("ij,ij->i", off[:, 1:], off[:, :-1]) / np.einsum("ij,ij->i", off, off)
    return (runs - mean) / spread, (serial + 1 / n) * sqrt(n)


def _natural(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(encoding, symbol, n)``: sums over texts; symbols from -5 up hold the sums of :func:`null_of`'s scores, but the first in parts of ``UNIT``."""
    counts = {name: np.zeros(len(a), np.int64) for name, a in ALPHABETS.items()}
    scores = {name: [0] * 5 for name in ALPHABETS}
    for b in batches:
        offsets, raw = buffers(b.column("text"))
        for row, last in slices(offsets):
            edges = offsets[row : last + 1] - offsets[row]
            data = raw[offsets[row] : offsets[last]]
            plain = _plain_bytes(data, edges)
            places = np.flatnonzero(plain)
            data = data[places]
            bounds = np.searchsorted(places, edges)
            for name, read in _READ.items():
                x = read[data]
                own = np.flatnonzero(x >= 0)
                at = np.searchsorted(own, bounds)
                x = x[own]
                counts[name] += np.bincount(x, minlength=len(counts[name]))
                many = np.diff(at) // STRETCH  # of each text, whole stretches from its first symbol on
                first = np.repeat(at[:-1] - STRETCH * (np.cumsum(many) - many), many) + STRETCH * np.arange(many.sum())
                for k in range(0, len(first), 1 << 13):
                    found = _stretch_scores(x[first[k : k + (1 << 13), None] + np.arange(STRETCH)].astype(np.float64), len(counts[name]))
                    scores[name][0] += len(found[0])
                    for i, v in enumerate((found[0], found[0] ** 2, found[1], found[1] ** 2)):
                        scores[name][i + 1] += int(np.rint(v * UNIT).astype(np.int64).sum())
    rows = [(name, i, n) for name in ALPHABETS for i, n in [*enumerate(counts[name].tolist()), *((i - 5, n) for i, n in enumerate(scores[name]))] if n]
    yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], names=["encoding", "symbol", "n"])


def fitted_nulls(source: DataFrame) -> dict[str, Null]:
    """Natural text in each encoding, from all rows of ``source(text)``."""
    rows = source.select("text").mapInArrow(_natural, "encoding string, symbol int, n long")
    found = {(r.encoding, r.symbol): r.n for r in rows.groupBy("encoding", "symbol").agg(F.sum("n").alias("n")).collect()}
    out = {}
    for name, alphabet in ALPHABETS.items():
        counts = {i: found.get((name, i), 0) for i in range(len(alphabet))}
        out[name] = null_of(name, counts, [found.get((name, -5), 0), *(found.get((name, i - 4), 0) / UNIT for i in range(4))])
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def parts(run: str, nulls: dict[str, Null]) -> list[tuple[int, int, str, float]]:
    """``(start, end, encoding, p)`` of the parts of a run that fits no encoding as a whole; none overlap."""
    found = {}
    for form in PARTS:
        for m in form.finditer(run):
            lo = m.start() + PATH_WORDS.match(m[0]).end()
            hi = m.end() - PATH_WORDS.match(run[lo : m.end()][::-1]).end()
            if hi - lo >= 16 and (fit := infer(run[lo:hi])):
                found[lo, hi] = (lo, hi, fit[0], battery(*fit, nulls))
    kept: list[tuple[int, int, str, float]] = []
    rivals = set()
    for x in sorted(found.values(), key=lambda x: (x[3], x[0])):
        i = bisect(kept, x)
        over = [y for y in kept[max(i - 1, 0) : i + 1] if y[0] < x[1] and x[0] < y[1]]
        rivals.update(over)
        if not over:
            kept.insert(i, x)
    return [(*x[:3], min(1.0, 2 * x[3])) if x in rivals else x for x in kept]


def candidates(text: str, base: list[tuple[str, int, int]], nulls: dict[str, Null]) -> list[tuple[int, int, str, float]]:
    """``(start, end, encoding, p)`` of the strings tested: those that touch no base span."""
    out = []
    for m in CANDIDATE.finditer(text):
        run, at = m[0], m.start()
        if ("/" in run or "+" in run) and ("-" in run or "_" in run):
            own = [(at + s, at + e, encoding, p) for s, e, encoding, p in parts(run, nulls)]
        else:
            own = [(at, m.end(), fit[0], battery(*fit, nulls))] if (fit := infer(run)) else []
        out += [x for x in own if not any(s < x[1] and x[0] < e for _, s, e in base)]
    return out


_BASE = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
_TESTS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()), ("p", pa.float64())]))


def _scan(batches: Iterator[pa.RecordBatch], nulls: dict[str, Null]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        base, tests, digests = [], [], []
        for value in b.column("text"):
            text = value.as_py()
            spans = base_spans(text)
            base.append([{"start": s, "rank": KINDS.index(k), "kind": k, "end": e} for k, s, e in spans])
            tests.append([{"start": s, "end": e, "encoding": c, "p": p} for s, e, c, p in candidates(text, spans, nulls)])
            digests.append(hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest())
        yield pa.record_batch(
            [b.column("doc_id"), b.column("th"), pa.array(base, _BASE), pa.array(tests, _TESTS), pa.array(digests, pa.string())],
            names=["doc_id", "th", "base", "tests", "base_sha256"],
        )


def _band(test: Column) -> Column:
    length = test["end"] - test["start"]
    return sum(((length >= b).cast("int") for b in BANDS[1:]), F.lit(0))


def _bin(test: Column) -> Column:
    """Bin of the p-value, by its order of magnitude; a higher bin is a smaller p-value."""
    return F.least(F.lit(BINS - 1), F.floor(-10 * F.log10(F.greatest(test["p"], F.lit(1e-300))))).cast("int")


def limits(counts: dict[tuple[int, int], int], fdr: float = FDR) -> list[int]:
    """For each band, the least bin that is a discovery (BINS: none)."""
    out = []
    for band in range(len(BANDS)):
        tests = sum(c for (b, _), c in counts.items() if b == band)
        found, best = 0, BINS
        for i in range(BINS - 1, -1, -1):
            found += counts.get((band, i), 0)
            if found and 10 ** (-i / 10) * tests <= fdr * found:
                best = i
        out.append(best)
    return out


def secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``doc_id, th, base, random, base_sha256`` of each row of ``docs(doc_id, text)``.

    ``base`` holds spans of known shape as (start, rank, kind, end), ``random`` the discoveries of the
    battery as (start, end, encoding, p).
    """
    fields = "array<struct<start:int,rank:int,kind:string,end:int>>", "array<struct<start:int,end:int,encoding:string,p:double>>"
    source = keyed(docs)
    nulls = fitted_nulls(source)
    found = source.mapInArrow(lambda it: _scan(it, nulls), f"doc_id long, th long, base {fields[0]}, tests {fields[1]}, base_sha256 string")
    found = materialize(found, "spans")
    rows = found.select(F.explode("tests").alias("t")).select(_band(F.col("t")).alias("band"), _bin(F.col("t")).alias("bin")).groupBy("band", "bin").count().collect()
    least = F.array(*[F.lit(x) for x in limits({(r.band, r.bin): r["count"] for r in rows}, fdr)])
    kept = F.filter("tests", lambda t: _bin(t) >= F.element_at(least, _band(t) + 1))
    return found.select("doc_id", "th", "base", kept.alias("random"), "base_sha256")


def span_text(base: Column, random: Column) -> Column:
    """All spans as kind:start:end by start, then kind, comma-joined."""
    more = F.transform(random, lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), F.concat(F.lit("random_"), t["encoding"]).alias("kind"), t["end"].alias("end")))
    every = F.sort_array(F.concat(base, more))
    return F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
