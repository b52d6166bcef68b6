"""A markdown corpus derived from plain documents: headings, tables (some over every small budget) and fences at fixed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def md_corpus(docs: DataFrame) -> DataFrame:
    """``user_id, doc_id, source, markdown`` from ``docs(doc_id, text, lang, source)``."""
    source, lang = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none"))

    def mark(x, i):
        number = i.cast("string")
        table = F.concat(F.lit("| key | value |\n| --- | --- |\n| line | "), number, F.lit(" |\n| size | "), F.length(x).cast("string"), F.lit(" |\n"), F.repeat(F.concat(F.lit("| row | "), number, F.lit(" |\n")), (i % 40) * 4))
        fence = F.concat(F.lit("```\n"), x, F.lit("\n\nend\n```"))
        return (
            F.when(i == 0, F.concat(F.lit("# "), source, F.lit("\n\n"), x))
            .when(i % 6 == 1, F.concat(F.lit("## "), lang, F.lit(" "), F.floor(i / 12).cast("string"), F.lit("\n"), x))
            .when(i % 6 == 3, F.concat(F.lit("#### part\n"), table))
            .when(i % 8 == 4, fence)
            .otherwise(F.concat(x, F.lit("\n")))
        )

    text = F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), mark), "\n")
    doc = F.col("doc_id").cast("string")
    # a projection of its own: inside a lambda a name means the select's own alias before the input's column
    return docs.withColumn("markdown", text).select(
        F.concat(F.lit("user-"), source).alias("user_id"), doc.alias("doc_id"), F.concat(source, F.lit("/doc"), doc, F.lit(".md")).alias("source"), "markdown"
    )
