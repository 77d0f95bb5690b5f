"""Fourteen chart patterns as Column expressions over one ordered window for each symbol.

A detector says, for a bar taken as the latest, whether its pattern holds, at which date, and what
speaks for it. Loops over candidate bars become one expression for each offset from the latest
bar, and the first that holds is taken in the detector's own order; every expression shares one
window specification, so a scan sorts each symbol once, whatever detectors it runs. An unknown
value is no match.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TINY = 1e-6


def div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def over_tiny(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(TINY))


def by_symbol():
    return Window.partitionBy("symbol").orderBy("time")


def lag(name: str, rows: int) -> Column:
    return F.lag(name, rows).over(by_symbol())


def run(fn, x: Column | str, first: int, last: int = 0) -> Column:
    """fn of x over the rows from `first` to `last` rows back (first >= last)."""
    return fn(x).over(by_symbol().rowsBetween(-first, -last))


def _sum(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x))


#: Aggregations over rows as functions of the array of their values (without nulls).
FOLDS = {"max": F.array_max, "min": F.array_min, "sum": _sum, "avg": lambda v: _sum(v) / F.size(v), "collect_list": lambda v: v}


class Bars(threading.local):
    """What detectors read besides the prepared columns: values some rows back and runs of rows.

    Each is asked for by name and becomes one column, however many conditions and detectors use
    it; apply() adds the columns that the expressions built within it asked for. Each thread has
    its own, so scans with different detectors may run side by side.
    """

    def __init__(self):
        self.made: dict[str, Column] = {}
        #: What was asked for, by name: the column, and for runs the function, its rows and what it is of.
        self.asked: dict[str, tuple] = {}

    def named(self, name: str, x: Column) -> Column:
        self.made[name] = x
        return F.col(f"`{name}`")

    def back(self, name: str, rows: int) -> Column:
        if not rows:
            return F.col(name)
        self.asked[f"{name}@{rows}"] = (name, rows)
        return self.named(f"{name}@{rows}", lag(name, rows))

    def run(self, fn, name: str, first: int, last: int = 0, of: Column | None = None) -> Column:
        """fn over rows of the column name, or of an expression that name names."""
        key = f"{fn.__name__} {name}@{first}:{last}"
        self.asked[key] = (name, fn.__name__, first, last, of)
        return self.named(key, run(fn, F.col(name) if of is None else of, first, last))

    def since(self, fn, name: str, rows: int) -> Column:
        """fn over the rows behind the bar `rows` back, up to the latest."""
        return self.run(fn, name, rows - 1)

    def apply(self, df: DataFrame, detectors: Sequence[Detector]) -> tuple[DataFrame, list[Column]]:
        """df with all columns asked for, and each detector's evidence on them."""
        self.made, self.asked = {}, {}
        found = [d.found() for d in detectors]
        return (df.withColumns(self.made) if self.made else df), found

    def latest(self, df: DataFrame, detectors: Sequence[Detector]) -> tuple[DataFrame, list[Column]]:
        """apply() for the latest bar of each symbol alone, of a frame that holds no more bars than detectors look
        back: these lie in one array for each symbol, and what is asked for is read from it, once, instead of being a
        window column at every bar."""
        self.made, self.asked = {}, {}
        found = [d.found() for d in detectors]
        if set(self.made) != set(self.asked) or any(len(a) > 2 and a[1] not in FOLDS for a in self.asked.values()):
            ready = df.withColumns(self.made) if self.made else df  # something of a detector's own
            return ready.where("latest"), found
        own = {f"of {k}": a[4] for k, a in self.asked.items() if len(a) > 2 and a[4] is not None}
        used = sorted({a[0] for k, a in self.asked.items() if f"of {k}" not in own} | set(own))
        bars = F.sort_array(F.collect_list(F.struct("time", *[F.col(f"`{c}`") for c in used if c != "time"])))
        last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.col("time"))
        rows = df.withColumns(own).groupBy(F.col("symbol").alias("_symbol")).agg(bars.alias("_bars"), last.alias("_last")).select("_last.*", "_bars")
        n = F.size("_bars")

        def read(key: str, a: tuple) -> Column:
            if len(a) == 2:
                return F.get("_bars", n - 1 - a[1])[a[0]]
            start = F.greatest(n - a[2], F.lit(1))
            part = F.slice("_bars", start, F.greatest(n - a[3] - start + 1, F.lit(0)))
            field = f"of {key}" if f"of {key}" in own else a[0]
            return FOLDS[a[1]](F.filter(F.transform(part, lambda b: b[field]), lambda x: x.isNotNull()))

        return (rows.withColumns({k: read(k, a) for k, a in self.asked.items()}) if self.asked else rows).drop("_bars"), found


B = Bars()


def cross(x: str, y: str) -> Column:
    """x rises above y at this bar."""
    return (F.col(x) > F.col(y)) & (lag(x, 1) <= lag(y, 1))


def fit(name: str, m: int) -> tuple[Column, Column]:
    """Slope and r squared of the last m values on their numbers, by exact sums of products.

    r squared is 1 where the values do not vary and never below 0.
    """
    n, x, y = F.lit(float(m)), F.col("rn").cast("double"), F.coalesce(F.col(name), F.lit(0.0))
    first = x - (m - 1)
    sy, syy, sxy = run(F.sum, y, m - 1), run(F.sum, y * y, m - 1), run(F.sum, x * y, m - 1)
    sx, sxx = m * (m - 1) / 2, (m - 1) * m * (2 * m - 1) / 6
    num, den = n * (sxy - first * sy) - sx * sy, m * sxx - sx * sx
    total = n * syy - sy * sy
    r2 = F.when(total <= 1e-9, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.try_divide(num * num, F.lit(den) * total)))
    ready = F.col("rn") >= m
    return F.when(ready, num / den), F.when(ready, r2)


def prepare(frame: DataFrame, before: Column | int = 0) -> DataFrame:
    """The frame with indicators, plus what detectors read at several bars. before: how many bars of
    each symbol came before those of the frame."""
    price = lambda x: F.col(x).cast("double")
    df = frame.withColumns({c: price(c) for c in ("open", "high", "low", "close", "volume")})
    df = df.withColumns({"rn": F.row_number().over(by_symbol()) + before, "prev": lag("close", 1), "latest": F.lead("time").over(by_symbol()).isNull()})
    df = df.withColumns(
        {
            "chg": F.when(F.col("prev") > 0, (F.col("close") - F.col("prev")) / F.col("prev")),
            "bull": F.col("close") > F.col("open"),
            "bear": F.col("close") < F.col("open"),
            "body": F.when(F.abs("open") < 1e-12, F.lit(0.0)).otherwise(div(F.abs(F.col("close") - F.col("open")), F.col("open"))),
            "base5": run(F.avg, "volume", 5, 1),
            "top60": run(F.max, F.struct("high", (-F.col("rn")).alias("k")), 60, 1),
            "top120": run(F.max, F.struct("high", (-F.col("rn")).alias("k")), 119),
            "low120": run(F.min, "low", 119),
            "low41": run(F.min, "low", 40),
            "rsi_low5": run(F.min, "rsi_14", 5, 1),
            "ma_cross": cross("ma_5", "ma_20"),
            "kdj_cross": cross("k_9_3_3", "d_9_3_3"),
            "volume_cross": cross("volume_ma_5", "volume_ma_60"),
            "macd_cross": cross("macd_dif_12_26", "macd_dea_12_26_9"),
            "dip": (F.col("low") <= lag("low", 1)) & (F.col("low") <= lag("low", 2)) & (F.col("low") <= F.lead("low", 1).over(by_symbol())) & (F.col("low") <= F.lead("low", 2).over(by_symbol())),
        }
    )
    slope, r2 = fit("close", 20)
    return df.withColumns({"slope20": slope, "r2_20": r2, "low_slope20": fit("low", 20)[0], "macd_slope20": fit("macd_hist_12_26_9", 20)[0]})


def first_of(options: Sequence[tuple[Column, dict[str, Column]]]) -> Column:
    """The struct of the first option whose condition is true; null if none is."""
    return F.coalesce(*[F.when(c, F.struct(*[v.alias(k) for k, v in e.items()])) for c, e in options])


class Detector(Protocol):
    """What user code supplies: an id, a score, tags, a text, and found() on the prepared columns.

    found() gives a struct of evidence with a field `signal_date`, null where there is no signal.
    """

    id: str
    score: float
    tags: Sequence[str]
    explanation: str

    def found(self) -> Column: ...


@dataclass(frozen=True)
class BottomTrendInflection:
    id = "bottom_trend_inflection"
    score, tags = 0.78, ("bottom", "reversal")
    explanation = "A volume-backed surge near the low of a deep half-year decline while momentum no longer falls with price."
    decline: float = 0.45
    surge: float = 0.08
    volume_ratio: float = 2.5
    distance: float = 0.15
    search_days: int = 10

    def found(self) -> Column:
        highest = F.col("top120")["high"]
        lows = B.run(F.collect_list, "low", 119)
        # Lows from the first highest bar to the latest.
        age = F.col("rn") + F.col("top120")["k"]
        after = F.array_min(F.slice(lows, -(age + 1), age + 1))
        fall = over_tiny(highest - after, highest)
        ready = (F.col("rn") >= 120) & (fall >= self.decline) & (F.col("low_slope20") < 0) & (F.col("macd_slope20") > F.col("low_slope20"))
        options = []
        for o in range(self.search_days):
            held = B.since(F.min, "low", o) >= B.back("open", o) if o else F.lit(True)
            near = over_tiny(B.back("close", o) - F.col("low120"), F.col("low120"))
            ratio = div(B.back("volume", o), B.back("volume_ma_10", o))
            hit = (B.back("chg", o) > self.surge) & (B.back("volume", o) >= self.volume_ratio * B.back("volume_ma_10", o)) & (near <= self.distance) & held
            options.append(
                (ready & hit, {
                    "signal_date": F.col("time"), "decline_ratio": fall, "surge_date": B.back("time", o), "surge_change_pct": B.back("chg", o),
                    "volume_ratio": ratio, "distance_from_low": near, "support_price": B.back("open", o),
                    "price_slope": F.col("low_slope20"), "macd_slope": F.col("macd_slope20"),
                })
            )
        return first_of(options)


@dataclass(frozen=True)
class LimitUpPullback:
    id = "limit_up_pullback"
    score, tags = 0.82, ("price-action", "volume-confirmed")
    explanation = "A limit-up day on high volume, a shallow pullback on shrinking volume that holds support, and a rising latest bar."
    lookback_days: int = 6
    limit_up_threshold: float = 0.095
    volume_ratio_threshold: float = 2.2
    min_pullback_days: int = 1
    max_pullback_days: int = 9
    support_ratio: float = 0.95
    resistance_ratio: float = 1.05
    volume_shrinkage_ratio: float = 0.5
    max_range: float = 0.15

    def found(self) -> Column:
        options = []
        for o in range(max(1, self.min_pullback_days), min(self.max_pullback_days, self.lookback_days + self.max_pullback_days) + 1):
            c, v, base = B.back("close", o), B.back("volume", o), B.back("base5", o)
            low, high = B.since(F.min, "low", o), B.since(F.max, "high", o)
            least, most, thin = B.since(F.min, "close", o), B.since(F.max, "close", o), B.since(F.min, "volume", o)
            width = over_tiny(high - low, high)
            hit = (
                (B.back("chg", o) >= self.limit_up_threshold) & (base > 0) & (div(v, base) >= self.volume_ratio_threshold)
                & (low >= c * self.support_ratio) & (width <= self.max_range) & (least >= c * self.support_ratio)
                & (most <= c * self.resistance_ratio) & (least < c) & (thin <= v * self.volume_shrinkage_ratio) & F.col("bull")
            )
            options.append(
                (hit, {
                    "signal_date": F.col("time"), "key_date": B.back("time", o), "pullback_days": F.lit(o), "pullback_range": width, "volume_ratio": div(v, base),
                    "support_price": c * self.support_ratio, "resistance_price": c * self.resistance_ratio, "has_lower_close": least < c,
                    "has_volume_shrinkage": thin <= v * self.volume_shrinkage_ratio,
                    "latest_volume_ratio": F.coalesce(over_tiny(F.col("volume"), F.col("volume_ma_5")), F.lit(0.0)),
                })
            )
        return first_of(options)


@dataclass(frozen=True)
class LimitUpSideways:
    id = "limit_up_sideways"
    score, tags = 0.76, ("limit-up", "sideways")
    explanation = "A limit-up day on high volume, closes that hold beside it, and a latest bar that turns up by KDJ or MACD."
    limit_up_lookback_days: int = 10
    limit_up_threshold: float = 0.095
    volume_ratio_threshold: float = 1.8
    sideways_days_min: int = 1
    sideways_days_max: int = 10
    sideways_high_limit: float = 0.08
    sideways_low_limit: float = -0.05
    volume_shrinkage_ratio: float = 0.7
    support_drop_limit: float = -0.01
    kdj_gold_cross_threshold: float = 20.0
    volume_increase_ratio: float = 1.3

    def found(self) -> Column:
        increase, change = over_tiny(F.col("volume"), B.back("volume", 1)), over_tiny(F.col("close") - F.col("prev"), F.col("prev"))
        kdj = F.col("kdj_cross") & (F.col("k_9_3_3") < self.kdj_gold_cross_threshold)
        turned = (F.col("close") > F.col("prev")) & (increase >= self.volume_increase_ratio) & F.col("bull") & (kdj | F.col("macd_cross"))
        options = []
        for o in range(max(1, self.sideways_days_min), min(self.limit_up_lookback_days, self.sideways_days_max) + 1):
            c, v = B.back("close", o), B.back("volume", o)
            low, high = B.since(F.min, "low", o), B.since(F.max, "high", o)
            floor = c * (1 + self.support_drop_limit)
            hit = (
                (B.back("chg", o) >= self.limit_up_threshold) & (v >= self.volume_ratio_threshold * B.back("volume_ma_5", o))
                & (high <= c * (1 + self.sideways_high_limit)) & (low >= c * (1 + self.sideways_low_limit))
                & (B.since(F.min, "close", o) >= floor) & (B.since(F.min, "volume", o) <= v * self.volume_shrinkage_ratio) & turned
            )
            options.append(
                (hit, {
                    "signal_date": F.col("time"), "key_date": B.back("time", o), "support_level": c, "sideways_days": F.lit(o), "sideways_highest": high,
                    "sideways_lowest": low, "sideways_volume_ratio": over_tiny(B.since(F.sum, "volume", o) / o, v), "support_lower_limit": floor,
                    "volume_increase": increase, "price_change": change, "kdj_cross": kdj, "macd_cross": F.col("macd_cross"),
                })
            )
        return first_of(options)


@dataclass(frozen=True)
class MorningStar:
    id = "morning_star"
    score, tags = 0.74, ("reversal", "candlestick")
    explanation = "A long falling bar, a small body, then a long rising bar above the five-day mean on more volume."
    first_body_threshold: float = 0.03
    small_body_ratio: float = 0.3
    volume_ratio: float = 1.5
    confirm_change: float = 0.05

    def found(self) -> Column:
        change, ratio = over_tiny(F.col("close") - F.col("open"), F.col("open")), over_tiny(F.col("volume"), B.back("volume", 1))
        first, second = B.back("body", 2), B.back("body", 1)
        hit = (
            F.col("bull") & (change > self.confirm_change) & (F.col("close") > F.col("ma_5")) & B.back("bear", 2)
            & (first >= self.first_body_threshold) & (second <= first * self.small_body_ratio) & (ratio >= self.volume_ratio)
        )
        return first_of([
            (hit, {
                "signal_date": F.col("time"), "first_candle_date": B.back("time", 2), "first_candle_open": B.back("open", 2), "first_candle_close": B.back("close", 2),
                "second_candle_date": B.back("time", 1), "second_candle_open": B.back("open", 1), "second_candle_close": B.back("close", 1),
                "third_candle_open": F.col("open"), "third_candle_close": F.col("close"), "first_bear_body": first, "middle_body": second,
                "confirm_change_pct": change, "ma5": F.col("ma_5"), "volume_ratio": ratio,
            })
        ])


@dataclass(frozen=True)
class MultiGoldenCross:
    id = "multi_golden_cross"
    score, tags = 0.81, ("golden-cross", "resonance")
    explanation = "Moving averages, KDJ and MACD cross upward within a few bars of each other."
    lookback_days: int = 10
    resonance_days: int = 3
    min_volume_ratio: float = 1.0

    def found(self) -> Column:
        last = lambda c: B.run(F.max, c, self.lookback_days - 1, of=F.when(F.col(c), F.struct("rn", "time")))
        days = [last(c) for c in ("ma_cross", "kdj_cross", "macd_cross")]
        gap = F.greatest(*[d["rn"] for d in days]) - F.least(*[d["rn"] for d in days])
        ratio = over_tiny(F.col("volume"), F.col("volume_ma_5"))
        there = days[0].isNotNull() & days[1].isNotNull() & days[2].isNotNull() & F.col("bull_bear_line_14_28_57_114").isNotNull()
        hit = there & (gap <= self.resonance_days) & (F.col("close") > F.col("ma_5")) & (F.col("close") > F.col("ma_20")) & (ratio >= self.min_volume_ratio)
        return first_of([
            (hit, {
                "signal_date": F.col("time"), "key_date": F.least(*[d["time"] for d in days]), "ma_cross_date": days[0]["time"], "kdj_cross_date": days[1]["time"],
                "macd_cross_date": days[2]["time"], "max_gap_days": gap, "ma5": F.col("ma_5"), "ma20": F.col("ma_20"), "k": F.col("k_9_3_3"), "d": F.col("d_9_3_3"),
                "j": F.col("j_9_3_3"), "dif": F.col("macd_dif_12_26"), "dea": F.col("macd_dea_12_26_9"), "macd": F.col("macd_hist_12_26_9"), "volume_ratio": ratio,
                "short_term_trend": F.col("short_trend_10_10"), "bull_bear_line": F.col("bull_bear_line_14_28_57_114"),
            })
        ])


@dataclass(frozen=True)
class MultiPartyCannon:
    id = "multi_party_cannon"
    score, tags = 0.73, ("candlestick", "breakout")
    explanation = "Two rising bars around a small falling one on little volume; the third breaks above the first on more."
    first_candle_rise: float = 0.03
    second_candle_body_ratio: float = 0.5
    second_candle_fallback_ratio: float = 0.5
    third_candle_rise: float = 0.03
    third_candle_breakthrough: bool = True
    second_volume_shrink_ratio: float = 0.8
    third_volume_expand_ratio: float = 1.0
    third_volume_ma_ratio: float = 1.5
    enable_ma_filter: bool = True
    enable_macd_filter: bool = False
    macd_above_zero: bool = True
    enable_kdj_filter: bool = False
    kdj_j_max: float = 80.0

    def found(self) -> Column:
        o1, c1, v1 = (B.back(x, 2) for x in ("open", "close", "volume"))
        c2, v2 = B.back("close", 1), B.back("volume", 1)
        c3, v3, mean = F.col("close"), F.col("volume"), F.col("volume_ma_5")
        rise1, rise3 = over_tiny(c1 - o1, o1), over_tiny(c3 - F.col("open"), F.col("open"))
        body1, body2 = B.back("body", 2), B.back("body", 1)
        fallback = over_tiny(F.greatest(c1 - c2, F.lit(0.0)), F.abs(c1 - o1))
        hit = (
            B.back("bull", 2) & (rise1 >= self.first_candle_rise) & B.back("bear", 1) & (body2 <= body1 * self.second_candle_body_ratio)
            & (fallback <= self.second_candle_fallback_ratio) & F.col("bull") & (rise3 >= self.third_candle_rise)
            & (v2 <= v1 * self.second_volume_shrink_ratio) & (v3 > v1 * self.third_volume_expand_ratio)
            & F.coalesce(v3 >= mean * self.third_volume_ma_ratio, F.lit(True))
        )
        if self.third_candle_breakthrough:
            hit = hit & (c3 > c1)
        if self.enable_ma_filter:
            hit = hit & (c3 >= F.col("ma_20"))
        if self.enable_macd_filter:
            hit = hit & (F.col("macd_hist_12_26_9") > 0 if self.macd_above_zero else F.col("macd_hist_12_26_9").isNotNull())
        if self.enable_kdj_filter:
            hit = hit & (F.col("j_9_3_3") < self.kdj_j_max)
        both = lambda low, high: (rise1 >= low) & (rise1 < high) & (rise3 >= low) & (rise3 < high)
        category = F.when((rise1 >= 0.07) & (rise3 >= 0.07), "strong").when(both(0.03, 0.07), "standard").when(both(0.01, 0.03), "weak").otherwise("standard")
        return first_of([
            (hit, {
                "signal_date": F.col("time"), "pattern_category": category, "first_rise_pct": rise1, "second_body_ratio": over_tiny(body2, body1), "fallback_ratio": fallback,
                "third_rise_pct": rise3, "third_volume_ratio": over_tiny(v3, v1), "third_vs_ma5_volume": F.coalesce(div(v3, mean), F.lit(0.0)),
                "ma20": F.col("ma_20"), "macd_hist": F.col("macd_hist_12_26_9"), "j": F.col("j_9_3_3"),
            })
        ])


@dataclass(frozen=True)
class ResistanceBreakout:
    id = "resistance_breakout"
    score, tags = 0.80, ("breakout", "trend")
    explanation = "A long rising bar on high volume closes above an old high and what follows holds there."
    breakout_ratio: float = 0.0
    min_change_pct: float = 0.09
    volume_ratio: float = 2.2
    volume_ma_period: int = 5
    max_search_days: int = 3
    min_resistance_gap: int = 30
    hold: float = 0.98

    def found(self) -> Column:
        mean = f"volume_ma_{self.volume_ma_period if self.volume_ma_period in (5, 10, 60) else 5}"
        ready = (F.col("rn") > 61) & (F.col("ma_5") > F.col("ma_10")) & (F.col("ma_10") > F.col("ma_20")) & (F.col("close") > F.col("ma_5"))
        options = []
        for o in range(self.max_search_days + 1):
            c, p, v, m = B.back("close", o), B.back("prev", o), B.back("volume", o), B.back(mean, o)
            top = B.back("top60", o)
            wall = top["high"]
            change = over_tiny(c - p, p)
            age = B.back("rn", o) + top["k"]
            hit = (
                ready & (change >= self.min_change_pct) & (c >= wall * (1 + self.breakout_ratio)) & (v >= self.volume_ratio * m)
                & (age >= self.min_resistance_gap) & (B.since(F.min, "low", o) >= self.hold * wall if o else F.lit(True)) & B.back("bull", o)
            )
            options.append(
                (hit, {
                    "signal_date": F.col("time"), "breakout_date": B.back("time", o), "price": F.col("close"), "resistance": wall, "support": self.hold * wall,
                    "breakout_change_pct": change, "breakout_ratio": over_tiny(c - wall, wall), "days_since_breakout": F.lit(o), "volume_ratio": over_tiny(v, m),
                    "ma5": F.col("ma_5"), "ma10": F.col("ma_10"), "ma20": F.col("ma_20"),
                })
            )
        return first_of(options)


@dataclass(frozen=True)
class StrongWashWeakToStrong:
    id = "strong_wash_weak_to_strong"
    score, tags = 0.77, ("wash", "reversal")
    explanation = "A big rising bar, a falling bar on more volume, and a rising bar whose closes stay above the first."
    surge: float = 0.08
    surge_volume: float = 1.5
    wash_volume: float = 1.2

    def found(self) -> Column:
        options = []
        for o in (2, 3, 4, 5):
            c, v, m = B.back("close", o), B.back("volume", o), B.back("volume_ma_5", o)
            wash = (B.back("chg", o) >= self.surge) & B.back("bull", o) & (v >= self.surge_volume * m) & B.back("bear", o - 1) & (B.back("volume", o - 1) >= self.wash_volume * v)
            for r in range(o - 2, max(o - 5, -1), -1):
                hit = wash & B.back("bull", r) & ((B.back("close", r) > c) | (B.back("close", r) > B.back("open", o - 1))) & (B.since(F.min, "close", r + 1) > c)
                options.append(
                    (hit, {
                        "signal_date": F.col("time"), "big_candle_date": B.back("time", o), "wash_date": B.back("time", o - 1), "reversal_date": B.back("time", r),
                        "big_candle_volume_ratio": over_tiny(v, m), "wash_volume_ratio": over_tiny(B.back("volume", o - 1), v), "days_after_reversal": F.lit(r),
                    })
                )
        return first_of(options)


@dataclass(frozen=True)
class TrendAccelerationInflection:
    id = "trend_acceleration_inflection"
    score, tags = 0.80, ("trend", "acceleration")
    explanation = "In a clear uptrend a long rising bar on high volume starts near the low and keeps its opening price."
    r2: float = 0.5
    surge: float = 0.08
    volume_ratio: float = 2.0
    distance: float = 0.15

    def found(self) -> Column:
        ready = (F.col("rn") >= 50) & (F.col("slope20") > 0) & (F.col("r2_20") >= self.r2)
        options = []
        for o in range(5):
            low, v, m = B.back("low41", o), B.back("volume", o), B.back("volume_ma_5", o)
            near = over_tiny(B.back("prev", o) - low, low)
            hit = ready & (B.back("chg", o) >= self.surge) & (v >= self.volume_ratio * m) & (near <= self.distance) & (B.since(F.min, "low", o + 1) >= B.back("open", o))
            options.append(
                (hit, {
                    "signal_date": F.col("time"), "trend_slope": F.col("slope20"), "trend_r2": F.col("r2_20"), "surge_date": B.back("time", o),
                    "distance_from_low": near, "support_price": B.back("open", o), "volume_ratio": div(v, m),
                })
            )
        return first_of(options)


@dataclass(frozen=True)
class TrendStart:
    id = "trend_start"
    score, tags = 0.79, ("trend", "macd", "boll")
    explanation = "MACD crosses upward above zero as the close crosses the Bollinger middle on more volume."
    volume_ratio: float = 1.2

    def found(self) -> Column:
        ratio = over_tiny(F.col("volume"), F.col("volume_ma_5"))
        hit = (
            (F.col("macd_dif_12_26") > 0) & F.col("macd_cross") & (F.col("prev") < B.back("boll_mid_20", 1)) & (F.col("close") > F.col("boll_mid_20"))
            & F.col("bull") & (F.col("close") > F.col("ma_5")) & (ratio > self.volume_ratio)
        )
        return first_of([
            (hit, {
                "signal_date": F.col("time"), "dif": F.col("macd_dif_12_26"), "dea": F.col("macd_dea_12_26_9"), "boll_mid": F.col("boll_mid_20"),
                "ma5": F.col("ma_5"), "close": F.col("close"), "volume_ratio": ratio,
            })
        ])


@dataclass(frozen=True)
class ImmortalGuidance:
    """By default the latest close must both reach the confirming price and stay below it, so there
    is never a signal; with exclude_latest only the bars between must stay below."""

    id = "immortal_guidance"
    score, tags = 0.75, ("upper-shadow", "trend")
    explanation = "After a spike with a long upper shadow in an uptrend the close retakes half of the shadow within days."
    surge_threshold: float = 0.08
    upper_shadow_ratio: float = 0.04
    volume_ratio_min: float = 1.5
    trend_r_squared_threshold: float = 0.5
    anti_body_ratio: float = 0.5
    lookback_days: int = 3
    exclude_latest: bool = False

    def found(self) -> Column:
        ready = (F.col("close") >= F.col("ma_5")) & (F.col("volume") > 0) & (F.col("slope20") > 0) & (F.col("r2_20") >= self.trend_r_squared_threshold)
        options = []
        for o in range(1, min(self.lookback_days, 3) + 1):
            high, top = B.back("high", o), F.greatest(B.back("open", o), B.back("close", o))
            surge, shadow = over_tiny(high - B.back("prev", o), B.back("prev", o)), over_tiny(high - top, high)
            ratio = over_tiny(B.back("volume", o), B.back("volume_ma_5", o))
            retake = top + (high - top) * self.anti_body_ratio
            if self.exclude_latest:
                below = B.run(F.max, "close", o - 1, 1) < retake if o > 1 else F.lit(True)
            else:
                below = B.since(F.max, "close", o) < retake
            hit = (
                ready & (surge >= self.surge_threshold) & (shadow >= self.upper_shadow_ratio) & (ratio >= self.volume_ratio_min)
                & (B.back("ma_5", o) > B.back("ma_10", o)) & (B.back("ma_10", o) > B.back("ma_20", o)) & (F.col("close") >= retake) & below
            )
            options.append(
                (hit, {
                    "signal_date": F.col("time"), "key_date": B.back("time", o), "price": F.col("close"), "volume_ratio": over_tiny(F.col("volume"), F.col("volume_ma_5")),
                    "surge_pct": surge, "upper_shadow_ratio": shadow, "anti_body_price": retake, "support_level": B.back("open", o), "key_day_close": B.back("close", o),
                    "key_day_high": high, "signal_volume_ratio": ratio, "days_to_confirm": F.lit(o), "trend_slope": F.col("slope20"), "trend_r2": F.col("r2_20"),
                    "ma5": B.back("ma_5", o), "ma10": B.back("ma_10", o), "ma20": B.back("ma_20", o), "close_above_ma5": F.col("close") > F.col("ma_5"),
                })
            )
        return first_of(options)


@dataclass(frozen=True)
class TrendResonanceReversal:
    id = "trend_resonance_reversal"
    score, tags = 0.80, ("resonance", "reversal", "rsi")
    explanation = "RSI leaves the oversold zone while moving averages and MACD cross upward within a few bars."
    rsi_oversold: float = 30.0
    rsi_breakout: float = 50.0
    signal_days: int = 3

    def found(self) -> Column:
        rsi_days = []
        for o in range(self.signal_days - 1, -1, -1):
            rose = (B.back("rsi_14", o) >= self.rsi_breakout) & (B.back("rsi_14", o + 1) < self.rsi_breakout) & (B.back("rsi_low5", o) <= self.rsi_oversold)
            rsi_days.append((rose, {"rn": B.back("rn", o), "time": B.back("time", o), "close": B.back("close", o), "rsi": B.back("rsi_14", o)}))
        rsi = first_of(rsi_days)
        own = lambda *names: F.struct("rn", "time", *names)
        first = lambda c, *names: B.run(F.min, c, 2 * self.signal_days, of=F.when(F.col(c), own(*names)))
        ma, macd = first("ma_cross", "ma_5", "ma_20"), first("macd_cross", "macd_dif_12_26", "macd_dea_12_26_9")
        days = [rsi["rn"], ma["rn"], macd["rn"]]
        span = F.greatest(*days) - F.least(*days)
        hit = (F.col("rn") >= 31) & rsi.isNotNull() & ma.isNotNull() & macd.isNotNull() & (span <= self.signal_days)
        return first_of([
            (hit, {
                "signal_date": rsi["time"], "ma_cross_day": ma["time"], "macd_cross_day": macd["time"], "rsi_value": rsi["rsi"], "ma_short": ma["ma_5"], "ma_long": ma["ma_20"],
                "macd_dif": macd["macd_dif_12_26"], "macd_dea": macd["macd_dea_12_26_9"], "close": rsi["close"], "max_time_diff": span,
            })
        ])


@dataclass(frozen=True)
class WBottom:
    id = "w_bottom"
    score, tags = 0.79, ("double-bottom", "breakout")
    explanation = "Two lows of about one price, then a bar on high volume that closes above the neckline, which holds."
    pattern_days: int = 40
    min_gap: int = 10
    bottom_diff_threshold: float = 0.03
    breakout_ratio: float = 0.01
    volume_expand_ratio: float = 1.2
    support_ratio: float = 0.98
    support_days: int = 20
    volume_shrink_ratio: float = 0.8
    neck_ratio: float = 1.1
    rise_ratio: float = 1.2
    surge: float = 0.08

    def found(self) -> Column:
        n, m = F.col("rn"), self.pattern_days
        lows = B.run(F.collect_list, "dip", m - 3, 6, of=F.when(F.col("dip"), F.struct("rn", "low", "volume", "time")))
        left, right = F.get(lows, F.size(lows) - 2), F.get(lows, F.size(lows) - 1)
        highs = B.run(F.collect_list, "high", m - 1)  # of rows n - m + 1 to n
        place = lambda rn: rn - n + F.size(highs)
        part = lambda a, b: F.array_max(F.slice(highs, place(a), b - a + 1))
        neck = part(left["rn"], right["rn"])
        ahead = part(left["rn"] + 1, F.least(left["rn"] + 30, n))
        diff = over_tiny(F.abs(left["low"] - right["low"]), left["low"])
        shape = (
            (n >= m) & (F.size(lows) >= 2) & (right["rn"] - left["rn"] > self.min_gap) & (diff <= self.bottom_diff_threshold) & (neck >= left["low"] * self.neck_ratio)
            & (F.col("ma_10") > F.col("ma_30")) & (ahead > left["low"] * self.rise_ratio)
        )
        breaks = []
        for o in (4, 3, 2, 1, 0):  # the oldest counts
            over = (B.back("chg", o) > self.surge) & (B.back("volume", o) >= self.volume_expand_ratio * B.back("volume_ma_5", o)) & (B.back("close", o) >= neck * (1 + self.breakout_ratio)) & (B.back("prev", o) < neck)
            last = max(0, o - self.support_days)
            kept = B.run(F.min, "close", o - 1, last) if o > last else F.lit(float("inf"))
            breaks.append((over, {"date": B.back("time", o), "kept": kept, "ratio": over_tiny(B.back("volume", o), B.back("volume_ma_5", o))}))
        broke = first_of(breaks)
        shrink = F.when(left["volume"] > 0, right["volume"] / left["volume"]).otherwise(F.lit(0.0))
        return first_of([
            (shape & broke.isNotNull() & (broke["kept"] >= neck * self.support_ratio), {
                "signal_date": F.col("time"), "key_date": broke["date"], "left_bottom_date": left["time"], "right_bottom_date": right["time"], "neckline": neck,
                "bottom_diff_ratio": diff, "break_volume_ratio": broke["ratio"], "support_price": neck * self.support_ratio,
                "volume_shrink": (left["volume"] > 0) & (right["volume"] < left["volume"] * self.volume_shrink_ratio), "volume_shrink_ratio": shrink,
            })
        ])


@dataclass(frozen=True)
class Strategy2560Selection:
    id = "strategy_2560_selection"
    score, tags = 0.74, ("ma-break", "volume-cross")
    explanation = "The close crosses its 25-day mean as the five-day volume mean crosses the sixty-day one."
    min_change: float = 0.05
    volume_ratio: float = 1.2

    def found(self) -> Column:
        change, ratio = over_tiny(F.col("close") - F.col("prev"), F.col("prev")), over_tiny(F.col("volume"), F.col("volume_ma_5"))
        hit = (
            (F.col("close") > F.col("ma_25")) & (F.col("prev") <= B.back("ma_25", 1)) & F.col("volume_cross")
            & (F.col("close") > F.col("ma_10")) & (change >= self.min_change) & (ratio >= self.volume_ratio)
        )
        return first_of([
            (hit, {
                "signal_date": F.col("time"), "ma25": F.col("ma_25"), "ma10": F.col("ma_10"), "price_change_pct": change, "close": F.col("close"), "prev_close": F.col("prev"),
                "volume_ratio": ratio, "vol_ma5": F.col("volume_ma_5"), "vol_ma60": F.col("volume_ma_60"),
            })
        ])


REGISTRY: dict[str, Detector] = {
    d.id: d
    for d in (
        BottomTrendInflection(), LimitUpPullback(), LimitUpSideways(), MorningStar(), MultiGoldenCross(), MultiPartyCannon(), ResistanceBreakout(),
        StrongWashWeakToStrong(), TrendAccelerationInflection(), TrendStart(), ImmortalGuidance(), TrendResonanceReversal(), WBottom(), Strategy2560Selection(),
    )
}


def lookup(pattern_id: str) -> Detector:
    if pattern_id not in REGISTRY:
        raise ValueError(f"unknown pattern {pattern_id}; available: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[pattern_id]
