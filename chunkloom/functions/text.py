"""Text predicates and clean-up as column functions (JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace and line breaks as character classes.
SPACE = r"\x09-\x0D\x1C-\x20\x85   -     　"
BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]"
FENCE = "```"
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{SPACE}]+", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"[{SPACE}]+$", "")


def is_blank(c: Column) -> Column:
    return ~c.rlike(f"[^{SPACE}]")


def is_heading(stripped: Column) -> Column:
    return stripped.startswith("#") & ~stripped.startswith("#[[")


def heading_level(stripped: Column) -> Column:
    return (F.length(stripped) - F.length(F.regexp_replace(stripped, "^#+", ""))).cast("int")


def is_table_line(stripped: Column) -> Column:
    return stripped.startswith("|")


def is_fence(stripped: Column) -> Column:
    return stripped.startswith(FENCE)


def clean_title(title: Column) -> Column:
    """A heading without its marks; null where nothing is left."""
    bare = strip(F.regexp_replace(title, "^#+", ""))
    return F.when(bare != "", bare)


def file_name(source: Column) -> Column:
    """The last part of a path with either separator."""
    return strip(F.coalesce(F.regexp_extract(source, r"[^/\\]*$", 0), F.lit("")))


def split_lines(c: Column) -> Column:
    """``array<struct<line, mark>>``: lines and their terminators; no empty last line."""
    parts, marks = F.split(c, BREAK, -1), F.regexp_extract_all(c, F.lit(BREAK), F.lit(0))
    rows = F.zip_with(parts, marks, lambda line, mark: F.struct(line.alias("line"), F.coalesce(mark, F.lit("")).alias("mark")))
    return F.filter(rows, lambda r: (r["line"] != "") | (r["mark"] != ""))


def plain_lines(c: Column) -> Column:
    """Lines without terminators."""
    return F.transform(split_lines(c), lambda r: r["line"])


def uuid5(name: Column) -> Column:
    """Name-based UUID (version 5, DNS namespace) as 32 hex digits."""
    h = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15))


def chunk_type(text: Column) -> Column:
    """code, table or text, by the first line and the share of pipe lines."""
    full = F.filter(plain_lines(text), lambda x: ~is_blank(x))
    pipes = F.size(F.filter(full, lambda x: strip(x).startswith("|")))
    return F.when(F.regexp_replace(text, f"^[{SPACE}]+", "").startswith(FENCE), "code").when((F.size(full) > 0) & (pipes * 2 >= F.size(full)), "table").otherwise("text")


def is_retryable(message: Column) -> Column:
    return F.lower(message).contains("rate") | message.rlike("429|500|503")


def route(name: Column) -> Column:
    """What a file needs before conversion, by its suffix."""
    return F.when(name.rlike(r"(doc|docx|xls|xlsx|ppt|pptx)$"), "office").when(name.endswith("pdf"), "pdf").otherwise("rename_to_pdf")
