"""What is asked of a source of bars."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from tapeline.functions import scalars as sc


@dataclass(frozen=True)
class Request:
    """What bars to fetch."""

    symbols: tuple[str, ...]
    start: dt.date
    end: dt.date
    period: sc.Period = sc.Period.D1
    adjust: sc.Adjust = sc.Adjust.NONE
    fill_data: bool = True
    disable_download: bool = False

    def __post_init__(self):
        if not self.symbols:
            raise ValueError("symbols are empty")
        if self.start > self.end:
            raise ValueError("start is after end")
