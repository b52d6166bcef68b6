"""Token counts.

The default counter is the estimate of four characters per token, which stays in the JVM and which SQL can
check.  ``bpe_counter`` counts with a vocabulary file of a public tokenizer in Arrow batches; the file's
path is a parameter.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

CHARS_PER_TOKEN = 4
TokenCounter = Callable[[Column], Column]


def chars4(text: Column) -> Column:
    return chars4_of(F.length(text))


def chars4_of(length: Column) -> Column:
    """The count of a text by its length alone."""
    return F.ceil(length / CHARS_PER_TOKEN).cast("int")


#: The count by length, for counters that have one: packing then adds lengths and joins each piece once.
chars4.of_length = chars4_of


def _tokenizer(path: str):
    """The tokenizer of a file, loaded once in each Python worker."""
    if path not in _HELD:
        if path.endswith(".tiktoken"):
            import base64

            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
            _HELD[path] = tiktoken.Encoding(path, pat_str=RANK_PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            _HELD[path] = Tokenizer.from_file(path)
    return _HELD[path]


_HELD: dict[str, object] = {}
# Fixed value: how texts are cut before byte pairs are merged, for rank files.
RANK_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoded(path: str, texts: list[str]) -> list[list[int]]:
    """Token ids of texts, no special tokens."""
    held = _tokenizer(path)
    if path.endswith(".tiktoken"):
        return held.encode_ordinary_batch(texts)
    return [e.ids for e in held.encode_batch(texts, add_special_tokens=False)]


def bpe_counter(path: str) -> TokenCounter:
    """A counter on a public tokenizer's file (``tokenizer.json`` or tiktoken ranks)."""

    @F.pandas_udf("int")
    def count(text: pd.Series) -> pd.Series:
        return pd.Series([len(e) for e in encoded(path, text.fillna("").tolist())], dtype="int32")

    return count


# Which kind of vocabulary a provider's models count with.
KIND_OF_PROVIDER = {"azure": "hosted", "aws": "hosted", "ollama": "local"}


def counter_for(provider: str, paths: dict[str, str] | None = None) -> TokenCounter:
    """The counter of a provider: by the vocabulary file given for its kind (``hosted``, ``local``), else the estimate."""
    if provider not in KIND_OF_PROVIDER:
        raise ValueError(f"unknown provider: {provider}")
    path = (paths or {}).get(KIND_OF_PROVIDER[provider])
    return bpe_counter(path) if path else chars4


def truncated(texts: list[str], cap: int, path: str | None = None) -> list[str]:
    """The first ``cap`` tokens of each text: by a vocabulary file, or by the estimate of characters."""
    if path is None:
        return [t[: cap * CHARS_PER_TOKEN] for t in texts]
    held = _tokenizer(path)
    return [t if len(ids) <= cap else held.decode(ids[:cap]) for t, ids in zip(texts, encoded(path, texts))]
