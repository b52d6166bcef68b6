"""Settings of the pipeline by provider."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    max_chunk_tokens: int
    min_chunk_tokens: int
    splitter_min_tokens: int
    window_budget_tokens: int
    window_threshold_tokens: int
    vector_size: int
    token_slack: float = 1.1
    gap_snap: int = 3
    max_attempts: int = 3
    upsert_batch: int = 250
    embed_token_cap: int = 8000

    def __post_init__(self):
        for name in ("max_chunk_tokens", "min_chunk_tokens", "window_budget_tokens", "window_threshold_tokens", "vector_size", "max_attempts"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")


# Thresholds of each provider.
_HOSTED = Settings(1200, 200, 300, 8000, 6000, 3072)
_LOCAL = Settings(500, 150, 200, 4000, 3000, 4096)
_BY_PROVIDER = {"azure": _HOSTED, "aws": _HOSTED, "ollama": _LOCAL}


def settings(provider: str) -> Settings:
    if provider not in _BY_PROVIDER:
        raise ValueError(f"unknown provider: {provider}")
    return _BY_PROVIDER[provider]
