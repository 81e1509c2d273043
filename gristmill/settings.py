"""The engine's settings from the environment, checked when they are read."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

#: Seconds by which a record may seem to come from the future, at most.
MOST_SKEW = 300
PREFIX = "GRISTMILL_"


@dataclass(frozen=True)
class Settings:
    """Each field is read from ``GRISTMILL_`` and its name in capitals; a list is given with commas."""

    target_records: int = 1000
    freshness_hours: int = 24
    clock_skew_seconds: int = 60
    max_retries: int = 2
    token_budget: int = 1000
    provider_order: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not 0 <= self.clock_skew_seconds <= MOST_SKEW:
            raise ValueError(f"clock_skew_seconds must lie between 0 and {MOST_SKEW}, not {self.clock_skew_seconds}")

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        given = {f.name: env[PREFIX + f.name.upper()] for f in fields(cls) if PREFIX + f.name.upper() in env}
        lists = {name: tuple(part.strip() for part in text.split(",") if part.strip()) for name, text in given.items() if name == "provider_order"}
        return cls(**{name: int(text) for name, text in given.items() if name not in lists}, **lists)
