"""Providers that ask a hosted model: prompts, permits, attempts with corrective feedback.

A provider takes windows and gives rows ``(doc_id, window_index, attempt, args_json)``, one or more attempts a
window; ``problem`` may name what went wrong with an attempt before it could be read.  A provider whose
``fixed`` attribute is true gives the same answer each time and is asked once.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions import text as T
from chunkloom.functions.tokens import TokenCounter, chars4
from chunkloom.operators import proposals
from chunkloom.operators.paragraphs import paragraphs, rendered
from chunkloom.sources.shared import stored

#: A model: chat messages to the arguments of its tool call (JSON text), or None where it made none.
Model = Callable[[list[dict]], "str | None"]
PROVIDER_ERROR, HARD_ERROR = "provider error", "hard error"
_KEY = ["doc_id", "window_index"]
_SPLIT = "Split the text into chunks of one topic each. Call the tool once, with every chunk's start and end offset, title, type and a summary of one sentence. Chunks are in order, do not overlap and leave out no text."
_GROUP = "Group the numbered paragraphs into chunks of one topic each. Call the tool once, with every chunk's first and last paragraph, title, type and a summary of one sentence. Chunks are in order and hold each paragraph once."


def feedback_of(reasons: Column) -> Column:
    """What a model is told about its last attempt; null where that had no fault."""
    return F.when(F.size(reasons) > 0, F.concat(F.lit("Your last answer could not be used: "), F.array_join(reasons, ", "), F.lit(". Answer again and mend this.")))


def _system(task: str, least: int, most: int) -> Column:
    size = f"Aim at {least} to {most} tokens a chunk where the text allows."
    return F.concat_ws("\n\n", F.lit(task), F.lit(size), F.col("feedback"))


def offset_prompts(window_rows: DataFrame, least: int, most: int) -> DataFrame:
    """``doc_id, window_index, attempt, system, user`` for proposals by offset, of windows with ``attempt`` and ``feedback``."""
    heads = F.array_join("leading_heading_path", " > ")
    user = F.concat(
        F.lit("Headings open at the start: "), F.when(heads != "", heads).otherwise("(none)"), F.lit("\nLength of the text in characters: "), F.length("text").cast("string"),
        F.lit("\nOffsets count from the first character after the next line.\n--- BEGIN ---\n"), F.col("text"), F.lit("\n--- END ---"),
    )
    return window_rows.select(*_KEY, "attempt", _system(_SPLIT, least, most).alias("system"), user.alias("user"))


def paragraph_prompts(window_rows: DataFrame, paragraph_rows: DataFrame, least: int, most: int) -> DataFrame:
    """The same for proposals by paragraph number."""
    n = paragraph_rows.groupBy(*_KEY).agg(F.count("*").alias("n"))
    rows = window_rows.join(rendered(paragraph_rows), _KEY).join(n, _KEY)
    user = F.concat(F.lit("The text has "), F.col("n").cast("string"), F.lit(" paragraphs, [P0] to [P"), (F.col("n") - 1).cast("string"), F.lit("]; first and last of a chunk are inclusive.\n--- BEGIN ---\n"), F.col("prompt"), F.lit("\n--- END ---"))
    return rows.select(*_KEY, "attempt", _system(_GROUP, least, most).alias("system"), user.alias("user"))


def asked(prompts: DataFrame, model: Model, permits: int = 32) -> DataFrame:
    """``doc_id, window_index, attempt, args_json, problem``: a model's answers; ``permits`` calls run at once at most.

    An error that shows a limit or a server fault is a problem of the attempt; any other ends its document.
    """

    def run(batches):
        for b in batches:
            out = []
            for system, user in zip(b["system"], b["user"]):
                try:
                    out.append((model([{"role": "system", "content": system}, {"role": "user", "content": user}]), None))
                except Exception as error:  # noqa: BLE001  the provider's own exception types are not known here
                    said = str(error).lower()
                    out.append((None, PROVIDER_ERROR if any(x in said for x in ("rate", "429", "500", "503")) else HARD_ERROR))
            yield pd.concat([b[[*_KEY, "attempt"]], pd.DataFrame(out, columns=["args_json", "problem"], index=b.index, dtype=object)], axis=1)

    return prompts.repartition(permits).mapInPandas(run, "doc_id string, window_index int, attempt int, args_json string, problem string")


def by_offsets(model: Model, least: int = 200, most: int = 1200, permits: int = 32) -> proposals.BoundaryProvider:
    """A provider that asks for offsets."""
    return lambda window_rows: asked(offset_prompts(window_rows, least, most), model, permits)


def by_paragraphs(model: Model, least: int = 200, most: int = 1200, permits: int = 32, shortest: int = 1600, longest: int = 4800) -> proposals.BoundaryProvider:
    """A provider that asks for ranges of numbered paragraphs and turns them into offsets."""

    def provide(window_rows: DataFrame) -> DataFrame:
        spans = stored(paragraphs(window_rows, shortest, longest))
        answers = stored(asked(paragraph_prompts(window_rows, spans, least, most), model, permits))
        return proposals.from_paragraphs(answers, spans)

    return provide


def attempted(
    window_rows: DataFrame, provider: proposals.BoundaryProvider, attempts: int = 3, max_tokens: int = 1200, slack: float = 1.1, gap: int = 3, count: TokenCounter = chars4
) -> tuple[DataFrame, DataFrame]:
    """``(chunks, attempts)`` as of ``validated``, over rounds: windows without a valid attempt are asked again, told what was wrong.

    Each round is a table, so an answer is never asked for twice.  A hard error ends its window's rounds.
    """
    open_ = window_rows.withColumn("attempt", F.lit(1)).withColumn("feedback", F.lit(None).cast("string"))
    chunks = verdicts = None
    for turn in range(1, attempts + 1):
        offered = stored(provider(open_))
        some, found = proposals.validated(offered, window_rows, max_tokens, slack, gap, count)
        found = stored(found)  # the chunks are read from a table already
        chunks = some if chunks is None else chunks.unionByName(some)
        verdicts = found if verdicts is None else verdicts.unionByName(found)
        if turn == attempts or getattr(provider, "fixed", False):
            break
        over = found.groupBy(*_KEY).agg(F.max("is_valid").alias("good"), F.max(F.array_contains("error_reasons", HARD_ERROR)).alias("hard"), F.max_by("error_reasons", "attempt").alias("reasons"))
        again = stored(over.filter(~F.col("good") & ~F.col("hard")).select(*_KEY, feedback_of(F.col("reasons")).alias("feedback")))
        if again.isEmpty():
            break
        open_ = window_rows.join(again, _KEY).withColumn("attempt", F.lit(turn + 1))
    return chunks, verdicts


def failed_documents(attempts: DataFrame) -> DataFrame:
    """``doc_id, error`` of documents that a provider's hard error ended."""
    return attempts.filter(F.array_contains("error_reasons", HARD_ERROR)).select("doc_id", F.lit(HARD_ERROR).alias("error")).distinct()
