"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Everything is built-in column functions.  Spark has no function for match offsets, so a text is cut by
a pattern into pieces that alternate with the matches (``split`` and ``regexp_extract_all`` with the
same pattern); sums of their lengths give the offsets.  Patterns use possessive quantifiers and start
only where a run of their first characters starts, so that they take linear time and no deep stack on
texts of any length, and match as the plain forms do.

Kinds: e-mail; IPv4 (parts at most 255); card (Luhn); phone; and, beyond the base kinds, IBAN
(mod-97).  Each span has a score: a prior for its kind, raised if one of the kind's context words
stands within ``CONTEXT`` characters before it.

Defined cases: null text is empty; offsets are code points, end exclusive; spans of different kinds
may overlap; repeated rows get equal results; null ids are kept; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40
BLOCK = 16
# The base kinds in order, their patterns in linear-time form, and what a text must hold for each.
KINDS = ("email", "ip", "card", "phone", "iban")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
}
HOLDS = {"email": "@", "ip": None, "card": None, "phone": "+", "iban": None}
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.9}
WORDS = {
    "email": "mail|e-mail|contact|write|correo|courriel|kontakt",
    "ip": "ip|address|host|server|adresse|client",
    "card": "card|visa|credit|debit|payment|carte|karte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|anruf|telefon|llamar",
    "iban": "iban|account|bank|konto|compte|cuenta",
}
RAISE = 0.2


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    from_right = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(
            F.filter(from_right, lambda c: c != ""),
            lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)),
        ),
        F.lit(0),
        lambda a, v: a + v,
    )
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an IBAN without spaces passes the mod-97 checksum."""
    turned = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))
    rest = F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def _confirmed(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.split(F.regexp_replace(s, r"(^|\.)0+(?=[0-9])", "$1"), r"\.")
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), luhn(_digits(s))).otherwise(False)
    if kind == "phone":
        return (n >= 8) & (n <= 15)
    code = F.replace(s, F.lit(" "), F.lit(""))
    return F.when(F.length(code).between(15, 34), mod97(code)).otherwise(False)


def _placed(kind: str, steps: Column) -> Column:
    """Confirmed spans of matches ``m`` and the pieces ``p`` before them.

    The context is taken from the piece before a match and, where that is short, from the match and piece before it,
    never from the whole text; offsets are running sums, folded over blocks of matches, so that work grows with their number.
    """
    one = lambda i: F.get(steps, i)
    block = F.lit(BLOCK)
    length = lambda x: F.length(x["p"]) + F.length(x["m"])
    sums = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + length(x))
    n = F.size(steps)
    blocks = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int"))).otherwise(F.array().cast("array<int>"))

    def bases(numbers: Column) -> Column:
        """Where each block starts in the text."""
        add = lambda a, k: F.struct((a["at"] + sums(F.slice(steps, k * block + 1, block))).alias("at"), F.array_append(a["out"], a["at"]).alias("out"))
        return F.aggregate(numbers, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), add, lambda a: a["out"])

    def near(i: Column) -> Column:
        p = one(i)["p"]
        before = F.concat(F.coalesce(one(i - 1)["p"], F.lit("")), F.coalesce(one(i - 1)["m"], F.lit("")), p)
        return F.lower(F.right(F.when(F.length(p) >= CONTEXT, p).otherwise(F.right(before, F.lit(CONTEXT))), F.lit(CONTEXT)))

    def span(i: Column, start: Column) -> Column:
        m = one(i)["m"]
        score = F.lit(SCORES[kind]) + F.when(near(i).rlike(rf"(?<![\p{{L}}])(?:{WORDS[kind]})(?![\p{{L}}])"), RAISE).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), score.alias("score"))

    def of_block(k: Column, base: Column) -> Column:
        own = F.slice(steps, k * block + 1, block)
        start = lambda x, j: base + sums(F.slice(own, F.lit(1), j)) + F.length(x["p"])
        placed = F.transform(own, lambda x, j: F.struct(_confirmed(kind, x["m"]).alias("ok"), start(x, j).alias("start"), (k * block + j).alias("i")))
        return F.transform(F.filter(placed, lambda x: x["ok"]), lambda x: span(x["i"], x["start"]))

    return F.transform(F.array(blocks), lambda ks: F.flatten(F.zip_with(ks, bases(ks), of_block)))[0]


def _spans(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind as an array of (kind, start, end, score), by start."""
    pattern = F.lit(PATTERNS[kind])
    entry = "array<struct<kind:string,start:int,end:int,score:double>>"
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, PATTERNS[kind], -1)
    steps = F.zip_with(matches, F.slice(pieces, 1, F.size(matches)), lambda m, p: F.struct(m.alias("m"), p.alias("p")))
    found = F.transform(F.array(steps), lambda own: _placed(kind, own))[0]
    none = F.array().cast(entry)
    return F.when(F.contains(text, F.lit(HOLDS[kind])), found).otherwise(none) if HOLDS[kind] else F.when(text.rlike(PATTERNS[kind]), found).otherwise(none)


def pii(docs: DataFrame) -> DataFrame:
    """``doc_id`` and, for each kind, an array of (kind, start, end, score), of each row of ``docs(doc_id, text)``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", *[_spans(F.col("text"), k).alias(k) for k in KINDS])


def span_text(*arrays: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(F.concat(*arrays), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
