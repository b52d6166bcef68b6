"""Near-duplicate lines: an exact set-similarity join over all lines, later matches removed.

A line is the set of its words.  A line goes if a line before it (by doc_id, then line number) has a
Jaccard similarity of ``threshold`` or more with it.  All of it is DataFrame operations on built-in
functions.

*Rarity.*  Word counts over all lines are kept per bucket of word hashes: a table of bytes that hold the logarithm
of the count.  It has ``1 << RARITY_BITS`` buckets and twice as many for each doubling of the input beyond
``RARITY_INPUT`` bytes, up to ``1 << MOST_BITS``, as in fuller buckets rare words can't be told from frequent ones.
A word's key is (rarity, hash), so a sorted array of keys is the line in order of rarity.  Any order is exact;
the table decides only how many lines meet.

*Classes.*  Lines with equal sets collapse to one class with its first position before anything is
joined; a line repeated in a third of all documents is one row from there on.

*Join.*  Classes meet on the words of their prefixes (the longer set's first n - ceil(t n) + 1 words, the
shorter's first n - ceil(2t/(1+t) n) + 1).  In the join condition stand the length filter, the positional
filter, and a bound on the symmetric difference: the parities of word hashes in 64 bits (128 for long
lines) differ in no more bits than the sets differ in words.  Of what meets, only pairs that share as many
prefix words as the needed overlap leaves to the prefixes go on.  Of each later class the nearest candidate
is verified on the words themselves first, and the others only where that one fails.

*Hot words.*  Where a prefix word is frequent (``HOT_COUNT``, above the median load of buckets), variants of one line would meet as all
pairs.  Classes with such words are first compared with ``LEADERS`` early classes of the same size and word only, for
each of their ``LEAD_WORDS`` rarest frequent words; those that match are decided, and take no part as the later side
afterwards.  The rest meet on pairs of
frequent words: two different matching sets share two words, and the first two they share stand within
the prefix of one word more.  (Lines of over ``PAIR_WORDS`` words meet on single words, as their pairs
would be too many.)

Classes are known by 128-bit hashes of their words' 56-bit hashes, and in joins by the place of their first line.
Two different lines are taken as one class only if their words' hashes agree: two words of 10**9 share a 56-bit
hash about 7 times in a whole vocabulary of that size, and then two lines must differ in just that word.

Defined cases: null text is one empty line; lines without words are kept; rows equal in id and text are
one document; null ids come last; documents with equal ids are ordered by a hash of their texts; other
columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil, log2
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm._store import discard, keyed, materialize, release

THRESHOLD = 0.8
RARITY_BITS = 20
RARITY_INPUT = 1 << 28
MOST_BITS = 23
MARK_BITS = 20
PAIR_WORDS = 64
LONG_WORDS = 24
LEAD_WORDS = 6
LEADERS = 4
HOT_COUNT = 1700
HOT_LOADS = 4
WORD_GAP = r"[\x20\x09-\x0D]+"
_CELL = 1024
_STEPS = 3  # rarity steps per doubling of the count


def _words(line: Column) -> Column:
    """The words of a text; other gaps become spaces first where there are any, as one-letter splits need no regular expression."""
    other = [F.contains(line, F.lit(c)) for c in "\t\v\f\r\n"]
    odd = other[0]
    for c in other[1:]:
        odd = odd | c
    return F.array_remove(F.split(F.when(odd, F.regexp_replace(line, WORD_GAP, " ")).otherwise(line), " "), "")


def _bucket(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int")


def _rarity_bits(docs: DataFrame) -> int:
    """The bits of a bucket's number, by the size that the plan is thought to read; the least for plans of no known size."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return RARITY_BITS if size >> 50 else min(MOST_BITS, RARITY_BITS + max(0, ceil(log2(max(1, size) / RARITY_INPUT))))


def rarity_table(docs: DataFrame, bits: int = RARITY_BITS) -> bytes:
    """For each of ``1 << bits`` buckets of word hashes, 1 + ``_STEPS`` * log2 of its number of words, 0 if none."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))  # words of short arrays explode twice as fast as those of whole texts
    counts = lines.select(F.explode(_words(F.col("line"))).alias("w")).groupBy(_bucket(F.xxhash64("w"), bits).alias("b")).count()
    level = F.least(F.lit(126), 1 + F.floor(_STEPS * F.log2("count"))).cast("int")
    return _collected(counts.select("b", level.alias("v")), bits)


def _collected(cells: DataFrame, bits: int) -> bytes:
    """A table of ``1 << bits`` bytes from rows ``(b, v)``, joined to strings on the executors."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", "v"))), lambda e: F.concat_ws(":", (e["b"] % _CELL).cast("string"), e["v"].cast("string"))), ",")
    table = bytearray(1 << bits)
    for row in cells.groupBy(F.floor(F.col("b") / _CELL).cast("int").alias("cell")).agg(text.alias("entries")).collect():
        for entry in row.entries.split(","):
            i, v = entry.split(":")
            table[row.cell * _CELL + int(i)] = int(v)
    return bytes(table)


def _hot_level(table: bytes) -> int:
    """The rarity from which a bucket points to a frequent word: ``HOT_COUNT`` words beyond ``HOT_LOADS`` median loads.

    Few words make most of a text, so the mean load tells of the few buckets that hold them and not of the others.
    """
    middle = median(table)
    return 1 + int(_STEPS * log2(HOT_COUNT + HOT_LOADS * (2 ** ((middle - 1) / _STEPS) if middle else 0)))


def _lookup(table: bytes, index: Column) -> Column:
    """The byte (0..127) of a table at an index from 0."""
    return F.ascii(F.substring(F.lit(table), index + 1, F.lit(1)).cast("string"))


def _prefix(n: Column, share: float) -> Column:
    return (n - F.ceil(share * n - 1e-9) + 1).cast("int")


def _place() -> tuple[Column, Column]:
    """``(d, r)``: two numbers that order lines by document, then line, of rows ``(doc_id, th, line_no)``."""
    low = F.lit((1 << 31) - 1).cast("long")
    inside = F.shiftleft(F.col("th").bitwiseAND(low), 32).bitwiseOR(F.col("line_no").cast("long"))
    return F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("d"), inside.alias("r")


def _after(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Whether place a comes after place b."""
    return (a[0] > b[0]) | ((a[0] == b[0]) & (a[1] > b[1]))


def _signed_lines(docs: DataFrame, table: bytes, level: int, threshold: float) -> DataFrame:
    """One row per line with words: its document and number, hashes, size, parities, and the words of its prefix.

    ``cold`` holds 31 bits of the prefix words below the rarity ``level``, ``hot`` the keys of the others, one word
    beyond the prefix included; ``at`` is the place of the first of ``hot``.
    """
    lines = docs.select("doc_id", "th", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    bits = len(table).bit_length() - 1

    def key(h: Column) -> Column:
        return F.shiftleft(_lookup(table, _bucket(h, bits)).cast("long"), 56).bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1)))

    def bit(k: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))

    lines = lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))  # not by the size of what follows, or that would be computed twice
    lines = lines.withColumn("hashes", F.array_distinct(F.transform(_words(F.col("line")), lambda w: F.xxhash64(w))))
    lines = lines.withColumn("sig", F.sort_array(F.transform("hashes", key)))
    lines = lines.withColumn("n", F.size("sig")).withColumn("head", F.slice("sig", F.lit(1), _prefix(F.col("n"), threshold) + 1))
    frequent = lambda k: F.shiftright(k, 56) >= level
    lines = lines.withColumn("hot", F.filter("head", frequent))
    cold = F.slice("head", F.lit(1), F.least(_prefix(F.col("n"), threshold), F.size("head") - F.size("hot")))
    parity = lambda keys: F.aggregate(keys, F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(bit(k)))
    upper = F.when(F.col("n") > LONG_WORDS, parity(F.filter("sig", lambda k: k.bitwiseAND(F.lit(64)) != 0))).otherwise(F.lit(0).cast("long"))
    return lines.select(
        "doc_id",
        "th",
        "line_no",
        "n",
        F.xxhash64("sig").alias("s1"),
        F.xxhash64(F.lit(7), "sig").alias("s2"),
        F.transform(cold, lambda k: k.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")).alias("cold"),
        "hot",
        (F.size("head") - F.size("hot")).alias("at"),
        parity("sig").alias("p"),
        upper.alias("q"),
    )


def _apart(a: str, b: str) -> Column:
    """Bits in which the parities of two classes ``(n, p, q)`` differ: 128 of them where both are long, else 64."""
    p, q = (F.col(f"{a}.{x}").bitwiseXOR(F.col(f"{b}.{x}")) for x in "pq")
    both = (F.col(f"{a}.n") > LONG_WORDS) & (F.col(f"{b}.n") > LONG_WORDS)
    return F.when(both, F.bit_count(p.bitwiseXOR(q)) + F.bit_count(q)).otherwise(F.bit_count(p))


def _may_match(a: str, b: str, threshold: float) -> Column:
    """Length filter and parity bound of two classes ``(n, p, q)``, a not larger than b."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (na >= threshold * nb - 1e-9) & (_apart(a, b) <= F.floor((na + nb) * ((1 - threshold) / (1 + threshold)) + 1e-9))


def _overlap(na: Column, nb: Column, threshold: float) -> Column:
    """Words that matching sets of these sizes share at least."""
    return F.ceil((na + nb) * (threshold / (1 + threshold)) - 1e-9)


def _meet(a: str, b: str, threshold: float, second: bool = False) -> Column:
    """All filters for rows ``(w, i, n, p, q)`` of two classes that share the key, a the smaller; with ``second``, ``j`` is the place of a second shared word."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    overlap = _overlap(na, nb, threshold)
    i, j = F.col(f"{a}.i"), F.col(f"{b}.i")
    if second:  # they are the first two that the sets share
        place = (na - i >= overlap) & (nb - j >= overlap) & (na - F.col(f"{a}.j") >= overlap - 1) & (nb - F.col(f"{b}.j") >= overlap - 1)
    else:  # any shared word: no more than the lesser of its places can be shared before it
        place = (na - i + F.least(i, j) >= overlap) & (nb - j + F.least(i, j) >= overlap)
    place_of = lambda x: (F.col(f"{x}.d"), F.col(f"{x}.r"))
    order = (na < nb) | ((na == nb) & _after(place_of(b), place_of(a)))
    return (F.col(f"{a}.w") == F.col(f"{b}.w")) & order & place & _may_match(a, b, threshold)


_PAIR = ("ld", "lr", "ed", "er")


def _pairs(threshold: float) -> list[Column]:
    """``ld, lr, ed, er, apart, overlap`` of joined rows a and b: places of the later and the earlier class, parity bits apart, words needed."""
    swap = _after((F.col("a.d"), F.col("a.r")), (F.col("b.d"), F.col("b.r")))
    pick = lambda x, y, c: F.when(swap, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}"))
    places = [pick(x, y, c).alias(f"{k}{c}") for k, x, y in (("l", "a", "b"), ("e", "b", "a")) for c in "dr"]
    return [*places, _apart("a", "b").alias("apart"), _overlap(F.col("a.n"), F.col("b.n"), threshold).cast("int").alias("overlap")]


def _candidates(a: DataFrame, b: DataFrame, on: Column, threshold: float, least: Column | None = None) -> DataFrame:
    """Distinct pairs that meet on ``on``, as often as ``least`` says."""
    met = a.alias("a").join(b.alias("b"), on).select(*_pairs(threshold), (F.lit(1) if least is None else least).cast("int").alias("least"))
    met = met.groupBy(*_PAIR).agg(*[F.min(c).alias(c) for c in ("apart", "overlap", "least")], F.count("*").alias("met"))
    return met.filter("met >= least").select(*_PAIR, "apart", "overlap")


def _shared_words(threshold: float) -> Column:
    """Prefix words below the hot level that the matching classes a and b (the larger) share at least.

    What two sets share lies in both prefixes or, at most, in one set's words after its prefix; ``h`` of a prefix's
    words are frequent and were not met on.
    """
    return _overlap(F.col("a.n"), F.col("b.n"), threshold) - F.ceil(threshold * F.col("b.n") - 1e-9) + 1 - F.least("a.h", "b.h")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``d, r, line`` of the lines at the places ``wanted(d, r)``; a table of bits spares most others the shuffle while they are few."""
    bucket = lambda: _bucket(F.xxhash64("d", "r"), MARK_BITS)
    some = _collected(wanted.select(bucket().alias("b"), F.lit(1).alias("v")).distinct(), MARK_BITS)
    packed = bytes(some[i] | some[i + 1] << 1 | some[i + 2] << 2 | some[i + 3] << 3 for i in range(0, len(some), 4))
    lines = docs.select("doc_id", "th", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).select(*_place(), "line")
    marked = F.call_function("shiftright", _lookup(packed, F.shiftright(bucket(), 2)), bucket().bitwiseAND(F.lit(3))).bitwiseAND(F.lit(1)) == 1
    return materialize(lines.filter(marked).join(wanted, ["d", "r"], "left_semi"), "texts")


def _similar(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Places ``ld, lr`` of the later classes of ``pairs`` that share the words needed with the earlier."""
    # whole lines travel and are split after the joins, once: an array of strings takes three times the room
    end = lambda k, name: texts.select(F.col("d").alias(f"{k}d"), F.col("r").alias(f"{k}r"), F.col("line").alias(name))
    both = pairs.select(*_PAIR, "overlap").join(end("l", "a"), ["ld", "lr"]).join(end("e", "b"), ["ed", "er"])
    shared = F.size(F.array_intersect(_words(F.col("a")), _words(F.col("b"))))
    return materialize(both.filter(shared >= F.col("overlap")).select("ld", "lr").distinct(), "similar")


def _decided(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Places ``ld, lr`` of classes that match an earlier one: the nearest is tried first, the others where it fails."""
    nearest = pairs.groupBy("ld", "lr").agg(F.min(F.struct("apart", "ed", "er", "overlap")).alias("e")).select("ld", "lr", "e.*")
    nearest = materialize(nearest, "nearest")
    found = _similar(texts, nearest)
    failed = nearest.join(found, ["ld", "lr"], "left_anti").select("ld", "lr", F.col("ed").alias("td"), F.col("er").alias("tr"))
    others = materialize(pairs.join(failed, ["ld", "lr"]).filter("ed <> td or er <> tr").drop("td", "tr"), "others")
    more = _similar(texts, others)
    discard(nearest, others)
    return found.union(more).distinct()


def _hot_keys(classes: DataFrame, threshold: float) -> DataFrame:
    """Rows ``(w, i, j, d, r, n, p, q)`` on which classes with frequent words meet: pairs of those words, or single ones of long lines."""
    own = ["d", "r", "n", "p", "q"]
    rows = classes.select(*own, "at", "hot", F.posexplode("hot").alias("k", "u"))
    after = F.slice("hot", F.col("k") + 2, F.size("hot"))
    pairs = rows.filter(F.col("n") <= PAIR_WORDS).select(*own, (F.col("at") + F.col("k")).alias("i"), "u", F.posexplode(after).alias("l", "v"))
    pairs = pairs.select(F.xxhash64("u", "v").alias("w"), "i", (F.col("i") + 1 + F.col("l")).alias("j"), *own)
    single = rows.filter(F.col("n") >= threshold * PAIR_WORDS).withColumn("i", F.col("at") + F.col("k")).filter(F.col("i") < _prefix(F.col("n"), threshold))
    return pairs.union(single.select(F.col("u").alias("w"), "i", F.lit(-1).alias("j"), *own))


def _led(classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs of classes with frequent words and early classes of the same size and one of the ``LEAD_WORDS`` rarest of these words."""
    placed = classes.select("d", "r", "n", F.explode(F.slice("hot", 1, LEAD_WORDS)).alias("w"))
    lead = placed.groupBy("w", "n", F.pmod(F.xxhash64("d", "r"), F.lit(LEADERS)).alias("turn")).agg(F.min(F.struct("d", "r")).alias("lead"))
    lead = materialize(lead.select("w", "n", F.col("lead.d").alias("ed"), F.col("lead.r").alias("er")), "lead")
    later = _after((F.col("d"), F.col("r")), (F.col("ed"), F.col("er")))
    led = materialize(placed.join(lead, ["w", "n"]).filter(later).select("d", "r", "ed", "er").distinct(), "led")
    own = classes.select("d", "r", "n", "p", "q")
    early = own.withColumnsRenamed({"d": "ed", "r": "er"}).alias("e")
    with_early = led.join(early, ["ed", "er"]).select("d", "r", F.struct(F.col("ed").alias("d"), F.col("er").alias("r"), "n", "p", "q").alias("b"))
    both = with_early.join(own.withColumn("a", F.struct("d", "r", "n", "p", "q")).select("d", "r", "a"), ["d", "r"]).select("a", "b")
    out = materialize(both.filter(_may_match("a", "b", threshold)).select(*_pairs(threshold)), "near")
    discard(lead, led)
    return out


def later_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, th, gone``: for each document of ``docs(doc_id, th, text)`` that loses lines, their numbers in order."""
    if not 0.5 < threshold <= 1:
        raise ValueError("threshold must be above 0.5")
    spark = docs.sparkSession
    table = rarity_table(docs, _rarity_bits(docs))
    lines = materialize(_signed_lines(docs, table, _hot_level(table), threshold), "lines")
    del table
    release(spark)
    firsts = [F.first(c).alias(c) for c in ("n", "cold", "hot", "at", "p", "q")]
    classes = lines.groupBy("s1", "s2").agg(F.min(F.struct(*_place())).alias("first"), F.count("*").alias("copies"), *firsts)
    classes = materialize(classes.select("s1", "s2", "first.d", "first.r", "copies", "n", "cold", "hot", "at", "p", "q"), "classes")
    places = materialize(lines.select("doc_id", "th", "line_no", "s1", "s2"), "places")  # what the end needs of lines, so that the rest goes before the joins
    discard(lines)
    release(spark)
    # half of the hash is enough to meet on: what else meets is not verified
    rows = classes.select("d", "r", "n", (_prefix(F.col("n"), threshold) - F.size("cold")).alias("h"), "p", "q", F.posexplode("cold").alias("i", "w"))
    cold = materialize(_candidates(rows, rows, _meet("a", "b", threshold), threshold, _shared_words(threshold)), "cold")
    del rows
    release(spark)
    some_hot = materialize(classes.filter(F.size("hot") > 0).drop("cold", "s1", "s2"), "somehot")
    near = _led(some_hot, threshold)
    pairs = cold.union(near)
    ends = pairs.select(F.explode(F.array(F.struct(F.col("ld").alias("d"), F.col("lr").alias("r")), F.struct(F.col("ed").alias("d"), F.col("er").alias("r")))).alias("e")).select("e.d", "e.r")
    wanted = materialize(ends.union(some_hot.select("d", "r")).distinct(), "wanted")
    texts = _texts(docs, wanted)
    release(spark)
    decided = _decided(texts, pairs)
    discard(cold, near, wanted)
    same = lambda a, b: (a["d"] == b["ld"]) & (a["r"] == b["lr"])
    hot = materialize(_hot_keys(some_hot, threshold), "hot")
    open_ = materialize(hot.join(decided, same(hot, decided), "left_anti"), "open")
    found = []
    for small, large, late in ((open_, hot, "a"), (hot, open_, "b")):
        early = "ab".replace(late, "")
        on = _meet("a", "b", threshold, True) & _after((F.col(f"{late}.d"), F.col(f"{late}.r")), (F.col(f"{early}.d"), F.col(f"{early}.r")))
        on = on & ((F.col("a.j") >= 0) == (F.col("b.j") >= 0)) & ((F.col("a.j") >= 0) | (F.col("b.n") > PAIR_WORDS))
        found.append(_candidates(small, large, on, threshold))
    more = materialize(found[0].union(found[1]), "hotpairs")
    if not more.isEmpty():
        decided = decided.union(_decided(texts, more)).distinct()
    late = materialize(decided.select(F.col("ld").alias("d"), F.col("lr").alias("r"), F.lit(True).alias("late")), "decided")
    # classes of one line that matches nothing have nothing to remove
    firsts = classes.select("s1", "s2", "d", "r", "copies").join(late, ["d", "r"], "left").filter("late or copies > 1")
    firsts = materialize(firsts.select("s1", "s2", F.col("d").alias("fd"), F.col("r").alias("fr"), F.coalesce("late", F.lit(False)).alias("late")), "firsts")
    discard(classes, some_hot, hot, open_, more, late, texts)
    flags = places.join(firsts, ["s1", "s2"]).filter(F.col("late") | _after(_place(), (F.col("fd"), F.col("fr"))))
    out = materialize(flags.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("line_no")).alias("gone")), "gone")
    discard(places, firsts)
    release(spark)
    return out


def line_dedup(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``n_lines, n_removed, kept_text``; kept lines are joined by ``\\n``.

    Columns of ``docs`` with these three names are replaced.
    """
    docs = docs.drop("n_lines", "n_removed", "kept_text")
    gone = later_lines(keyed(docs), threshold).withColumnsRenamed({"doc_id": "_id", "th": "_th", "gone": "_gone"})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.withColumns({"_key": F.col("doc_id").cast("long"), "_hash": F.xxhash64(text)})
    both = own.join(gone, own["_key"].eqNullSafe(gone["_id"]) & (own["_hash"] == gone["_th"]), "left")
    both = both.withColumn("_lines", F.split(text, "\n"))
    size = F.size("_lines")
    none = F.array().cast("array<int>")
    # the kept stretches between removed lines, so that the work grows with their number and not its square
    gaps = F.coalesce("_gone", none)
    starts = F.concat(F.array(F.lit(0)), F.transform(gaps, lambda g: g + 1))
    stops = F.concat(gaps, F.array(size))
    kept = F.flatten(F.zip_with(starts, stops, lambda a, b: F.slice("_lines", a + 1, b - a)))
    out = both.withColumns({"n_lines": size.cast("long"), "n_removed": F.size(gaps).cast("long"), "kept_text": F.when(F.size(gaps) == 0, text).otherwise(F.array_join(kept, "\n"))})
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "n_lines", "n_removed", "kept_text")
