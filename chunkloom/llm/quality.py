"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Measures are built-in column functions.  A rule names the measures it needs and the condition on which
it rejects a text.  On a sample of ``SAMPLE`` texts (those of least hash, wherever they lie) each rule's cost and
selectivity are estimated: the steps that its measures take on the sample's characters and words (``WORK``), and
which of the texts it rejects.  The next rule is always the one with the most rejections per step among the texts
that are left, a measure that an earlier rule has computed costing nothing; both numbers come from the sample alone,
so the order is the same in every run.  A measure is only computed for texts that no earlier rule has rejected;
measures that the caller asks for are completed for the others after the cascade.  The order decides speed and which
rule is named as the one that rejected, never the verdict.

Repeated three-word windows of a text are found by sorting window hashes packed with their positions
into long integers; where two different windows share a hash (or a text exceeds 2**20 words), the text
is sorted by the windows themselves.

Defined cases: null text is an empty text (and is rejected); repeated rows get equal results; null ids
are kept; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 1000
WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
_POSITION_BITS = 20
_POSITIONS = 1 << _POSITION_BITS


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[], Column]


RULES = (
    Rule("few_words", ("n_words",), lambda: F.col("n_words") < 50),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    Rule("symbols", ("n_words", "n_symbols"), lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("exclamations", ("n_words", "n_exclamations"), lambda: 5 * F.col("n_exclamations") > F.col("n_words")),
    Rule("shouting", ("n_chars", "n_capitals"), lambda: 10 * F.col("n_capitals") > 3 * F.col("n_chars")),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("word_length", ("n_words", "word_chars"), lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
)


def _count_of(pattern: str) -> Callable[[], Column]:
    return lambda: (F.length("text") - F.length(F.regexp_replace("text", pattern, ""))).cast("long")


def _lines() -> Column:
    return F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


#: Each measure: the columns it needs first, and its expression.
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "words": ((), lambda: F.array_remove(F.split("text", WORD_GAP), "")),
    "lines": ((), _lines),
    "n_chars": ((), lambda: F.length("text").cast("long")),
    "n_words": (("words",), lambda: F.size("words").cast("long")),
    "word_chars": ((), lambda: F.length(F.regexp_replace("text", WORD_GAP, "")).cast("long")),
    "n_symbols": ((), _count_of(SYMBOLS)),
    "n_exclamations": ((), lambda: (F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))).cast("long")),
    "n_capitals": ((), _count_of(r"\p{Lu}")),
    "n_lines": (("lines",), lambda: F.size("lines").cast("long")),
    "n_dup_lines": (("lines",), lambda: (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")),
    "window_keys": (("words",), lambda: _window_keys()),
    "window_twins": (("window_keys",), lambda: _twins("window_keys")),
    "repeat_at": (("window_twins", "words"), lambda: _repeat_positions()),
    "n_repeat_words": (("repeat_at",), lambda: _covered("repeat_at")),
}


#: Steps of each measure for a character and for a word, beyond the measures it needs: fixed values, about nanoseconds.
WORK: dict[str, tuple[float, float]] = {
    "words": (3.0, 10.0), "lines": (2.0, 0.0), "n_chars": (0.2, 0.0), "n_words": (0.0, 0.0), "word_chars": (8.0, 0.0), "n_symbols": (8.0, 0.0), "n_exclamations": (0.5, 0.0),
    "n_capitals": (10.0, 0.0), "n_lines": (0.0, 0.0), "n_dup_lines": (1.0, 0.0), "window_keys": (0.0, 250.0), "window_twins": (0.0, 150.0), "repeat_at": (0.0, 20.0), "n_repeat_words": (0.0, 5.0),
}


def _window_count() -> Column:
    return F.least(F.size("words"), F.lit(_POSITIONS)) - 2


def _window_keys() -> Column:
    """Sorted ``hash << 20 | position`` of the three-word windows of a text."""
    hashed = F.transform(
        F.sequence(F.lit(0), _window_count() - 1),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).bitwiseAND(F.lit(-_POSITIONS)).bitwiseOR(i.cast("long")),
    )
    return F.when(F.size("words") >= 3, F.sort_array(hashed)).otherwise(F.array().cast("array<bigint>"))


def _twins(keys: str) -> Column:
    """Keys whose hash occurs more than once."""
    part = lambda x: F.shiftright(x, _POSITION_BITS)
    same = lambda x, i: F.coalesce(part(F.get(keys, i)) == part(x), F.lit(False))
    return F.filter(keys, lambda x, i: same(x, i - 1) | same(x, i + 1))


def _repeat_positions() -> Column:
    """Positions, in order, of windows that occur more than once; exact."""
    at = lambda x: x.bitwiseAND(F.lit(_POSITIONS - 1)).cast("int")
    word = lambda x, k: F.get("words", at(x) + k)

    def clash(x: Column, i: Column) -> Column:
        y = F.get("window_twins", i + 1)
        alike = F.shiftright(x, _POSITION_BITS) == F.shiftright(y, _POSITION_BITS)
        return F.coalesce(alike & ~((word(x, 0) == word(y, 0)) & (word(x, 1) == word(y, 1)) & (word(x, 2) == word(y, 2))), F.lit(False))

    fast = F.sort_array(F.transform("window_twins", at))
    windows = F.sort_array(
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.struct(F.concat_ws(" ", F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("s"), i.alias("i")))
    )
    groups = F.aggregate(
        windows,
        F.struct(F.lit("").alias("s"), F.lit(-1).alias("i"), F.array().cast("array<int>").alias("out")),
        lambda a, x: F.struct(
            x["s"].alias("s"),
            x["i"].alias("i"),
            F.when((a["i"] >= 0) & (a["s"] == x["s"]), F.concat(a["out"], F.array(a["i"], x["i"]))).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.sort_array(F.array_distinct(a["out"])),
    )
    doubtful = (F.size("words") > _POSITIONS) | (F.size(F.filter("window_twins", clash)) > 0)
    return F.when(doubtful, groups).otherwise(fast)


def _covered(positions: str) -> Column:
    """Number of words in the three-word windows at sorted positions."""
    gaps = F.transform(positions, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(positions, i + 1) - p, F.lit(3))))
    return F.aggregate(gaps, F.lit(0), lambda a, v: a + v).cast("long")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def with_measures(df: DataFrame, names: tuple[str, ...], alive: Column | None = None) -> DataFrame:
    """Add measures that ``df(text)`` lacks, each in a projection of its own; null where not ``alive``."""
    for name in names:
        if name in df.columns:
            continue
        needs, expression = MEASURES[name]
        df = with_measures(df, needs, alive)
        df = df.withColumn(name, expression() if alive is None else F.when(alive, expression()))
    return df


def _needed(names: tuple[str, ...]) -> set[str]:
    """Measures and all that they need."""
    return {x for n in names for x in {n, *_needed(MEASURES[n][0])}}


def greedy_order(rules: tuple[Rule, ...], texts: list[tuple[int, int, int]]) -> list[tuple[Rule, float, float]]:
    """``(rule, steps a text, share rejected of those left)`` from texts as (rejecting rules as bits, characters, words)."""
    left, known, open_, out = list(texts), set(), list(range(len(rules))), []
    while open_:
        chars, words = (sum(t[i] for t in left) for i in (1, 2))

        def steps(i: int) -> float:
            return sum(WORK[m][0] * chars + WORK[m][1] * words for m in _needed(rules[i].needs) - known) + len(left) * 1e-3

        hits = {i: sum(t[0] >> i & 1 for t in left) for i in open_}
        cost = {i: steps(i) for i in open_}
        best = min(open_, key=lambda i: (-hits[i] / cost[i] if cost[i] else 0.0, cost[i], i))
        n = max(len(left), 1)
        out.append((rules[best], cost[best] / n, hits[best] / n))
        known |= _needed(rules[best].needs)
        left = [t for t in left if not t[0] >> best & 1]
        open_.remove(best)
    return out


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> list[tuple[Rule, float, float]]:
    """The rules in order, with cost and selectivity, by at most ``sample`` texts: those of least hash of id and text.

    Only hashes travel to find the limit, and only three numbers a text leave their partition.
    """
    rows = _rows(docs).withColumn("h", F.xxhash64("doc_id", "text"))
    limit = rows.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if limit is None:
        return greedy_order(rules, [])
    some = with_measures(rows.filter(F.col("h") <= limit), tuple(dict.fromkeys(n for r in rules for n in r.needs)) + ("n_words",))
    bits = sum((F.when(r.rejects(), 1 << i).otherwise(0) for i, r in enumerate(rules)), F.lit(0))
    found = some.select("h", bits.alias("bits"), F.length("text").alias("chars"), "n_words").limit(2 * sample).collect()
    found = sorted((r.h, r.bits, r.chars, r.n_words) for r in found)[:sample]
    return greedy_order(rules, [x[1:] for x in found])


def quality(docs: DataFrame, measures: tuple[str, ...] = (), rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, the asked measures, ``rejected_by`` (null: kept) and ``kept`` of each row of ``docs(doc_id, text)``."""
    df = _rows(docs).withColumn("rejected_by", F.lit(None).cast("string"))
    for rule, _, _ in cascade_order(docs, rules, sample):
        alive = F.col("rejected_by").isNull()
        df = with_measures(df, rule.needs, alive)
        df = df.withColumn("rejected_by", F.when(alive, F.when(rule.rejects(), F.lit(rule.name))).otherwise(F.col("rejected_by")))
    df = completed(df, measures)
    return df.select("doc_id", *measures, "rejected_by", F.col("rejected_by").isNull().alias("kept"))


def completed(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Measures for the rows too that the cascade had rejected before they were computed."""
    wanted = _needed(names)
    for name in [n for n in MEASURES if n in wanted]:
        own = MEASURES[name][1]()
        df = df.withColumn(name, F.coalesce(F.col(name), own) if name in df.columns else own)
    return df
