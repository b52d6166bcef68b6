"""Chat messages and tool calls in the shapes of a hosted model's interface."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tool_spec(function: dict) -> dict:
    """A function description as a tool specification."""
    spec = function.get("function", function)
    return {"toolSpec": {"name": spec["name"], "description": spec.get("description", ""), "inputSchema": {"json": spec.get("parameters", {})}}}


def tool_config(functions: list[dict], forced: str | None = None) -> dict:
    out: dict = {"tools": [tool_spec(f) for f in functions]}
    if forced:
        out["toolChoice"] = {"tool": {"name": forced}}
    return out


def split_messages(messages: DataFrame) -> DataFrame:
    """``conv_id, system, turns``: system texts joined by a blank line, and user and assistant turns in order; other roles go."""
    held = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    rows = messages.groupBy("conv_id").agg(held.alias("m"))
    system = F.array_join(F.transform(F.filter("m", lambda r: r["role"] == "system"), lambda r: r["text"]), "\n\n")
    return rows.select("conv_id", system.alias("system"), F.filter("m", lambda r: r["role"].isin("user", "assistant")).alias("turns"))


def block_text(blocks: Column) -> Column:
    """Concatenated text blocks of a response, ``array<struct<text, reasoning, tool>>``."""
    return F.array_join(F.transform(F.filter(blocks, lambda b: b["text"].isNotNull()), lambda b: b["text"]), "")


def block_reasoning(blocks: Column) -> Column:
    return F.array_join(F.transform(F.filter(blocks, lambda b: b["reasoning"].isNotNull()), lambda b: b["reasoning"]), "\n")


def block_tool(blocks: Column) -> Column:
    """The first tool call."""
    return F.get(F.filter(blocks, lambda b: b["tool"].isNotNull()), F.lit(0))["tool"]
