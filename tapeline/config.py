"""Settings, from TOML; everything has a default."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class Sync:
    chunk_size: int
    fetch_concurrency: int


@dataclass(frozen=True)
class Config:
    lake: str = "lake"
    #: Cron of the daily and minute syncs, in the market's time zone.
    daily_cron: str = "0 30 15 * * *"
    minute_cron: str = "0 10 15 * * *"
    time_zone: str = "Asia/Shanghai"
    adjust: str = "qfq"
    fallback: bool = True
    daily: Sync = field(default_factory=lambda: Sync(200, 8))
    minute: Sync = field(default_factory=lambda: Sync(100, 4))
    part_rows: int = 200_000

    @classmethod
    def load(cls, path: str | Path) -> Config:
        raw = tomllib.loads(Path(path).read_text(encoding="utf-8"))
        known = {f: raw[f] for f in cls.__dataclass_fields__ if f in raw and f not in ("daily", "minute")}
        base = cls()
        syncs = {k: Sync(**{**vars(getattr(base, k)), **raw.get(k, {})}) for k in ("daily", "minute")}
        if unknown := set(raw) - set(cls.__dataclass_fields__):
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return cls(**known, **syncs)
