"""Technical indicators: window expressions where the frame is finite, one grouped pass where it is recursive."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

EPS = 1e-12


def number_text(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x).replace(".", "_")


@dataclass(frozen=True)
class Ma:
    periods: tuple[int, ...]

    def columns(self) -> list[str]:
        return [f"ma_{p}" for p in self.periods]


@dataclass(frozen=True)
class VolumeMa:
    periods: tuple[int, ...]

    def columns(self) -> list[str]:
        return [f"volume_ma_{p}" for p in self.periods]


@dataclass(frozen=True)
class Macd:
    fast: int = 12
    slow: int = 26
    signal: int = 9

    def columns(self) -> list[str]:
        f, s, g = self.fast, self.slow, self.signal
        return [f"macd_dif_{f}_{s}", f"macd_dea_{f}_{s}_{g}", f"macd_hist_{f}_{s}_{g}"]


@dataclass(frozen=True)
class Kdj:
    n: int = 9
    k: int = 3
    d: int = 3

    def columns(self) -> list[str]:
        return [f"{x}_{self.n}_{self.k}_{self.d}" for x in "kdj"]


@dataclass(frozen=True)
class Boll:
    period: int = 20
    width: float = 2.0

    def columns(self) -> list[str]:
        p, k = self.period, number_text(self.width)
        return [f"boll_mid_{p}", f"boll_upper_{p}_{k}", f"boll_lower_{p}_{k}"]


@dataclass(frozen=True)
class Rsi:
    periods: tuple[int, ...]

    def columns(self) -> list[str]:
        return [f"rsi_{p}" for p in self.periods]


@dataclass(frozen=True)
class ShortTrend:
    fast: int = 10
    smooth: int = 10

    def columns(self) -> list[str]:
        return [f"short_trend_{self.fast}_{self.smooth}"]


@dataclass(frozen=True)
class BullBear:
    periods: tuple[int, int, int, int] = (14, 28, 57, 114)

    def columns(self) -> list[str]:
        return ["bull_bear_line_" + "_".join(map(str, self.periods))]


Spec = Ma | VolumeMa | Macd | Kdj | Boll | Rsi | ShortTrend | BullBear
ORDER = [Ma, VolumeMa, Macd, Kdj, Boll, Rsi, ShortTrend, BullBear]
MERGED = (Ma, VolumeMa, Rsi)

DEFAULT_PATTERN_SET: list[Spec] = [Ma((5, 10, 20, 25, 30)), VolumeMa((5, 10, 60)), Macd(), Kdj(), Boll(), Rsi((14,)), ShortTrend(), BullBear()]


def normalize(specs: Iterable[Spec]) -> list[Spec]:
    """Each column once, in a fixed order: period lists merge, sorted and without zeros."""
    specs = list(specs)
    out: list[Spec] = []
    for kind in ORDER:
        own = [s for s in specs if isinstance(s, kind)]
        if kind in MERGED:
            periods = sorted({p for s in own for p in s.periods if p > 0})
            out += [kind(tuple(periods))] if periods else []
        else:
            out += dict.fromkeys(own)
    for s in out:
        if isinstance(s, Boll):
            sound = s.period > 0 and math.isfinite(s.width)
        else:
            sound = all(p > 0 for v in vars(s).values() for p in (v if isinstance(v, tuple) else (v,)))
        if not sound:
            raise ValueError(f"invalid parameters: {s}")
    return out


def output_columns(specs: Iterable[Spec]) -> list[str]:
    return [c for s in normalize(specs) for c in s.columns()]


def rolling_mean(x: Column | str, p: int, by: Window) -> Column:
    """Mean of the last p rows; null until there are p."""
    return F.when(F.row_number().over(by) >= p, F.avg(x).over(by.rowsBetween(1 - p, 0)))


def folded(x: pd.Series, step: Callable[[float, float], float]) -> pd.Series:
    """step(y', x) from the first value on, whose y is itself; gaps stay gaps.

    The recursions are folds with the operations of the SQL in its order: crosses compare values
    that may be a rounding apart, which other forms of the same mean round elsewhere.
    """
    known = x.dropna()
    return pd.Series([*accumulate(known.tolist(), step)], known.index, dtype=float).reindex(x.index)


def ema(x: pd.Series, span: int) -> pd.Series:
    """y = a x + (1 - a) y', a = 2 / (span + 1)."""
    new, old = 2 / (span + 1), (span - 1) / (span + 1)
    return folded(x, lambda y, v: new * v + old * y)


def smooth(x: pd.Series, m: int) -> pd.Series:
    """y = x / m + y' (m - 1) / m."""
    return folded(x, lambda y, v: v / m + y * (m - 1) / m)


def raw_stochastic(high: pd.Series, low: pd.Series, close: pd.Series, n: int) -> pd.Series:
    """Place of the close in the range of at most n rows, in percent; 50 in a flat range."""
    top, bottom = high.rolling(n, min_periods=1).max(), low.rolling(n, min_periods=1).min()
    span = top - bottom
    return ((close - bottom) / span.where(span.abs() > EPS) * 100).fillna(50.0)


def wilder_rsi(close: pd.Series, p: int) -> pd.Series:
    """Wilder's RSI: seeded at row p with the mean of p changes; null before."""
    if len(close) <= p:
        return pd.Series(float("nan"), close.index)
    change = close.diff()
    sides = []
    for side in (change.clip(lower=0), (-change).clip(lower=0)):
        seeded = side.copy()
        seeded.iloc[:p] = float("nan")
        seeded.iloc[p] = side.iloc[1 : p + 1].mean()
        sides.append(folded(seeded, lambda y, v: (y * (p - 1) + v) / p))
    gain, loss = sides
    return (100 - 100 / (1 + gain / loss.where(loss > EPS))).where(loss > EPS, 100.0).where(gain.notna())


def recursive_columns(pdf: pd.DataFrame, specs: list[Spec]) -> dict[str, pd.Series]:
    """The columns that depend on all rows before, for one symbol in order of time."""
    zero = pd.Series(0.0, pdf.index)
    close, high, low = (pdf[c].astype(float).fillna(0.0) if c in pdf else zero for c in ("close", "high", "low"))
    out: dict[str, pd.Series] = {}
    for s in specs:
        if isinstance(s, Macd):
            dif = ema(close, s.fast) - ema(close, s.slow)
            dea = ema(dif, s.signal)
            values = [dif, dea, dif - dea]
        elif isinstance(s, Kdj):
            k = smooth(raw_stochastic(high, low, close, s.n), s.k)
            d = smooth(k, s.d)
            values = [k, d, 3 * k - 2 * d]
        elif isinstance(s, Rsi):
            values = [wilder_rsi(close, p) for p in s.periods]
        elif isinstance(s, ShortTrend):
            values = [ema(ema(close, s.fast), s.smooth)]
        else:
            continue
        out |= dict(zip(s.columns(), values, strict=True))
    return out


@dataclass(frozen=True)
class Keys:
    """How a frame is divided into series and ordered within them."""

    series: tuple[str, ...] = ("symbol",)
    time: str = "time"
    window: Window = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "window", Window.partitionBy(*self.series).orderBy(self.time))


def compute(frame: DataFrame, specs: Iterable[Spec], keys: Keys | None = None) -> DataFrame:
    """frame with the indicators' columns appended, doubles that are null while they warm up.

    One shuffle by series serves both the grouped pass of the recursive indicators and the windows
    of the others. Null or missing inputs count as 0. A series is one symbol's bars in the frame,
    so filter the time range first: recursive values depend on where it starts.
    """
    keys = keys or Keys()
    specs = normalize(specs)
    recursive = [s for s in specs if isinstance(s, (Macd, Kdj, Rsi, ShortTrend))]
    if recursive:
        names = [c for s in recursive for c in s.columns()]
        schema = T.StructType([*frame.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
        order = keys.time

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
            return pdf.assign(**recursive_columns(pdf, recursive))

        frame = frame.groupBy(*keys.series).applyInPandas(run, schema)
    w = keys.window
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in frame.columns else F.lit(0.0)
    close, volume = value("close"), value("volume")
    made: dict[str, Column] = {}
    for s in specs:
        if isinstance(s, Ma):
            made |= {c: rolling_mean(close, p, w) for c, p in zip(s.columns(), s.periods, strict=True)}
        elif isinstance(s, VolumeMa):
            made |= {c: rolling_mean(volume, p, w) for c, p in zip(s.columns(), s.periods, strict=True)}
        elif isinstance(s, Boll):
            mid = rolling_mean(close, s.period, w)
            dev = F.when(F.row_number().over(w) >= s.period, F.stddev_pop(close).over(w.rowsBetween(1 - s.period, 0)))
            made |= dict(zip(s.columns(), (mid, mid + s.width * dev, mid - s.width * dev), strict=True))
        elif isinstance(s, BullBear):
            means = [rolling_mean(close, p, w) for p in s.periods]
            made[s.columns()[0]] = sum(means[1:], means[0]) / len(means)
    frame = frame.withColumns(made) if made else frame
    own = [c for c in frame.columns if c not in set(output_columns(specs))]
    return frame.select(*own, *output_columns(specs))
