"""Files to markdown: the converter seam and the guard before it."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions import text as T

#: Text of a file: name and content to markdown.
Converter = Callable[[str, bytes], str]


def is_encrypted(content: Column) -> Column:
    """Whether a file asks for a password: an encryption entry in a PDF, an encrypted package in an office container."""
    raw = F.hex(content)
    pdf = raw.startswith("25504446") & raw.contains("2F456E6372797074")  # %PDF, /Encrypt
    office = raw.startswith("D0CF11E0") & raw.contains("45006E006300720079007000740065006400500061006300")  # E.n.c.r.y.p.t.e.d.P.a.c.
    return F.coalesce(pdf | office, F.lit(False))


def plain_converter(name: str, content: bytes) -> str:
    """Text files as they are; the default, as converters of other kinds need their own models."""
    return content.decode("utf-8")


def converted(files: DataFrame, convert: Converter = plain_converter) -> DataFrame:
    """``files(path, content)`` with ``route, status, msg, markdown``: done, encrypted or failed.

    Files with a password are not converted; a converter's error fails its file and not the job.

    Defined cases: null content is failed; repeated files are converted each; an empty table gives an empty result.
    """
    name = F.regexp_extract("path", r"[^/\\]*$", 0)
    rows = files.select("path", "content", T.route(F.lower(name)).alias("route"), is_encrypted(F.col("content")).alias("locked"))

    def run(batches):
        for b in batches:
            out = []
            for path, content, locked in zip(b["path"], b["content"], b["locked"]):
                if locked:
                    out.append(("encrypted", "password protected", None))
                    continue
                try:
                    out.append(("done", "success", convert(path, bytes(content))))
                except Exception as error:  # noqa: BLE001  one bad file must not end the job
                    out.append(("failed", str(error)[:500], None))
            frame = pd.DataFrame(out, columns=["status", "msg", "markdown"], index=b.index, dtype=object)
            yield pd.concat([b[["path", "route"]], frame], axis=1)

    return rows.mapInPandas(run, "path string, route string, status string, msg string, markdown string")
