"""The detectors in DuckDB SQL over the derived bars: what the queries are held against."""

from __future__ import annotations

from tapeline.operators import detectors as det
from tapeline.sources.bars import DAILY_SQL

ORDER = "partition by symbol order by time"


def back(x: str, o: int) -> str:
    return f"lag({x}, {o}) over ({ORDER})" if o else x


def run(fn: str, x: str, first: int, last: int = 0) -> str:
    end = f"{last} preceding" if last else "current row"
    return f"{fn}({x}) over ({ORDER} rows between {first} preceding and {end})"


def since(fn: str, x: str, o: int) -> str:
    return run(fn, x, o - 1)


def tiny(a: str, b: str) -> str:
    return f"(({a}) / greatest({b}, 0.000001))"


def mean(x: str, p: int) -> str:
    return f"case when rn >= {p} then {run('avg', x, p - 1)} end"


BARS = f"b as materialized (select *, row_number() over ({ORDER}) as rn from ({DAILY_SQL}))"

#: rsv and the changes, row by row.
RAW = f"""{BARS},
raw as materialized (
    select *, lag(close) over ({ORDER}) as prev,
           case when abs({run("max", "high", 8)} - {run("min", "low", 8)}) <= 1e-12 then 50.0
                else (close - {run("min", "low", 8)}) / ({run("max", "high", 8)} - {run("min", "low", 8)}) * 100 end as rsv,
           greatest(close - lag(close) over ({ORDER}), 0.0) as up, greatest(lag(close) over ({ORDER}) - close, 0.0) as down
    from b),
seeded as materialized (select *, {run("avg", "up", 13)} as up14, {run("avg", "down", 13)} as down14 from raw)"""

#: Folds over each symbol's rows.
FOLDED = f"""with recursive {RAW},
fold as (
    select symbol, rn, close as e12, close as e26, cast(0 as double) as dea, close as e10, close as short_trend, rsv as k, rsv as d,
           cast(null as double) as gain, cast(null as double) as loss
    from seeded where rn = 1
    union all
    select s.symbol, s.rn, 2.0 / 13 * s.close + 11.0 / 13 * f.e12, 2.0 / 27 * s.close + 25.0 / 27 * f.e26,
           0.2 * ((2.0 / 13 * s.close + 11.0 / 13 * f.e12) - (2.0 / 27 * s.close + 25.0 / 27 * f.e26)) + 0.8 * f.dea,
           2.0 / 11 * s.close + 9.0 / 11 * f.e10, 2.0 / 11 * (2.0 / 11 * s.close + 9.0 / 11 * f.e10) + 9.0 / 11 * f.short_trend,
           s.rsv / 3 + f.k * 2 / 3, (s.rsv / 3 + f.k * 2 / 3) / 3 + f.d * 2 / 3,
           case when s.rn < 15 then null when s.rn = 15 then s.up14 else (f.gain * 13 + s.up) / 14 end,
           case when s.rn < 15 then null when s.rn = 15 then s.down14 else (f.loss * 13 + s.down) / 14 end
    from fold f join seeded s on s.symbol = f.symbol and s.rn = f.rn + 1)"""

INDICATORS = f"""{FOLDED},
ind as materialized (
    select s.symbol, s.exchange, s.time, s.rn, s.open, s.high, s.low, s.close, s.volume, s.prev,
           {", ".join(f"{mean('s.close', p).replace('symbol', 's.symbol').replace('by time', 'by s.time').replace('rn >=', 's.rn >=')} as ma_{p}" for p in (5, 10, 20, 25, 30))},
           {", ".join(f"{mean('s.volume', p).replace('symbol', 's.symbol').replace('by time', 'by s.time').replace('rn >=', 's.rn >=')} as volume_ma_{p}" for p in (5, 10, 60))},
           f.e12 - f.e26 as dif, f.dea, f.e12 - f.e26 - f.dea as hist, f.k, f.d, 3 * f.k - 2 * f.d as j, f.short_trend,
           case when f.gain is null then null when f.loss <= 1e-12 then 100.0 else 100 - 100 / (1 + f.gain / f.loss) end as rsi,
           case when s.rn >= 114 then ({" + ".join(run("avg", "s.close", p - 1).replace("symbol", "s.symbol").replace("by time", "by s.time") for p in (14, 28, 57, 114))}) / 4 end as bull_bear
    from seeded s join fold f on s.symbol = f.symbol and s.rn = f.rn)"""


def fit_sql(y: str, m: int) -> tuple[str, str]:
    x = f"(rn - {m - 1})"  # the first row's number
    sy, syy, sxy = run("sum", y, m - 1), run("sum", f"{y} * {y}", m - 1), run("sum", f"rn * {y}", m - 1)
    sx, sxx = m * (m - 1) // 2, (m - 1) * m * (2 * m - 1) // 6
    num = f"({m} * ({sxy} - {x} * {sy}) - {sx} * {sy})"
    den, total = m * sxx - sx * sx, f"({m} * {syy} - {sy} * {sy})"
    return (
        f"case when rn >= {m} then {num} / {float(den)} end",
        f"case when rn >= {m} then case when {total} <= 1e-9 then 1.0 else greatest(0.0, {num} * {num} / ({float(den)} * {total})) end end",
    )


PREPARED = f"""{INDICATORS},
p as materialized (
    select *, case when prev > 0 then (close - prev) / prev end as chg, close > open as bull, close < open as bear,
           case when abs(open) < 1e-12 then 0.0 else abs(close - open) / open end as body,
           {run("avg", "volume", 5, 1)} as base5, {run("max", "high", 60, 1)} as top60, {run("list", "high", 60, 1)} as highs60,
           {run("list", "high", 119)} as highs120, {run("list", "low", 119)} as lows120, {run("min", "low", 40)} as low41, {run("min", "rsi", 5, 1)} as rsi_low5,
           coalesce(ma_5 > ma_20 and lag(ma_5) over ({ORDER}) <= lag(ma_20) over ({ORDER}), false) as ma_cross,
           coalesce(k > d and lag(k) over ({ORDER}) <= lag(d) over ({ORDER}), false) as kdj_cross,
           coalesce(dif > dea and lag(dif) over ({ORDER}) <= lag(dea) over ({ORDER}), false) as macd_cross,
           low <= {back("low", 1)} and low <= {back("low", 2)} and low <= lead(low, 1) over ({ORDER}) and low <= lead(low, 2) over ({ORDER}) as dip,
           {fit_sql("close", 20)[0]} as slope20, {fit_sql("close", 20)[1]} as r2_20, {fit_sql("low", 20)[0]} as low_slope20, {fit_sql("coalesce(hist, 0.0)", 20)[0]} as macd_slope20
    from ind)"""


#: Digits of the values that r() gives; None gives them as they are.
_digits: list[int | None] = [6]


def r(x: str) -> str:
    return f"({x}) + 0.0" if _digits[-1] is None else f"round({x}, {_digits[-1]}) + 0.0"


def exact(d: det.Detector) -> str:
    """A detector's SQL with unrounded values, for texts that are printed from them."""
    _digits.append(None)
    try:
        return BUILDERS[d.id](d)
    finally:
        _digits.pop()


def first_of(options: list[tuple[str, dict[str, str]]]) -> str:
    rows = [f"when {c} then struct_pack({', '.join(f'{k} := {v}' for k, v in e.items())})" for c, e in options]
    return "case " + "\n".join(rows) + " end"


def statement(e: str, extra: str = "") -> str:
    return f"{PREPARED}{extra}, q as (select symbol, exchange, time, rn, {e} as e from p) select symbol, exchange, time, unnest(e) from q where rn >= 20 and e is not null"


def bottom_trend_inflection(d: det.BottomTrendInflection) -> str:
    top = "list_max(highs120)"
    low = f"list_min(lows120[list_position(highs120, {top}):])"
    fall = tiny(f"{top} - {low}", top)
    lowest = "list_min(lows120)"
    options = []
    for o in range(d.search_days):
        near = tiny(f"{back('close', o)} - {lowest}", lowest)
        held = f"{since('min', 'low', o)} >= {back('open', o)}" if o else "true"
        cond = (
            f"rn >= 120 and {fall} >= {d.decline} and low_slope20 < 0 and macd_slope20 > low_slope20 and {back('chg', o)} > {d.surge} "
            f"and {back('volume', o)} >= {d.volume_ratio} * {back('volume_ma_10', o)} and {near} <= {d.distance} and {held}"
        )
        options.append((cond, {
            "signal_date": "time", "decline_ratio": r(fall), "surge_date": back("time", o), "surge_change_pct": r(back("chg", o)),
            "volume_ratio": r(f"{back('volume', o)} / {back('volume_ma_10', o)}"), "distance_from_low": r(near), "support_price": r(back("open", o)),
            "price_slope": r("low_slope20"), "macd_slope": r("macd_slope20"),
        }))
    return statement(first_of(options))


def limit_up_pullback(d: det.LimitUpPullback) -> str:
    options = []
    for o in range(1, d.max_pullback_days + 1):
        c, v, base = back("close", o), back("volume", o), back("base5", o)
        low, high, least, most, thin = since("min", "low", o), since("max", "high", o), since("min", "close", o), since("max", "close", o), since("min", "volume", o)
        width = tiny(f"{high} - {low}", high)
        cond = (
            f"{back('chg', o)} >= {d.limit_up_threshold} and {base} > 0 and {v} / {base} >= {d.volume_ratio_threshold} and {low} >= {c} * {d.support_ratio} "
            f"and {width} <= {d.max_range} and {least} >= {c} * {d.support_ratio} and {most} <= {c} * {d.resistance_ratio} and {least} < {c} "
            f"and {thin} <= {v} * {d.volume_shrinkage_ratio} and bull"
        )
        options.append((cond, {
            "signal_date": "time", "key_date": back("time", o), "pullback_days": str(o), "pullback_range": r(width), "volume_ratio": r(f"{v} / {base}"),
            "support_price": r(f"{c} * {d.support_ratio}"), "resistance_price": r(f"{c} * {d.resistance_ratio}"), "has_lower_close": f"{least} < {c}",
            "has_volume_shrinkage": f"{thin} <= {v} * {d.volume_shrinkage_ratio}", "latest_volume_ratio": r(f"coalesce({tiny('volume', 'volume_ma_5')}, 0.0)"),
        }))
    return statement(first_of(options))


def limit_up_sideways(d: det.LimitUpSideways) -> str:
    increase, change = tiny("volume", back("volume", 1)), tiny("close - prev", "prev")
    kdj = f"(kdj_cross and k < {d.kdj_gold_cross_threshold})"
    options = []
    for o in range(1, d.sideways_days_max + 1):
        c, v = back("close", o), back("volume", o)
        low, high = since("min", "low", o), since("max", "high", o)
        floor = f"{c} * {1 + d.support_drop_limit!r}"
        cond = (
            f"{back('chg', o)} >= {d.limit_up_threshold} and {v} >= {d.volume_ratio_threshold} * {back('volume_ma_5', o)} and {high} <= {c} * {1 + d.sideways_high_limit!r} "
            f"and {low} >= {c} * {1 + d.sideways_low_limit!r} and {since('min', 'close', o)} >= {floor} and {since('min', 'volume', o)} <= {v} * {d.volume_shrinkage_ratio} "
            f"and close > prev and {increase} >= {d.volume_increase_ratio} and bull and ({kdj} or macd_cross)"
        )
        options.append((cond, {
            "signal_date": "time", "key_date": back("time", o), "support_level": r(c), "sideways_days": str(o), "sideways_highest": r(high), "sideways_lowest": r(low),
            "sideways_volume_ratio": r(tiny(f"{since('sum', 'volume', o)} / {o}", v)), "support_lower_limit": r(floor), "volume_increase": r(increase),
            "price_change": r(change), "kdj_cross": kdj, "macd_cross": "macd_cross",
        }))
    return statement(first_of(options))


def morning_star(d: det.MorningStar) -> str:
    change, ratio, first, second = tiny("close - open", "open"), tiny("volume", back("volume", 1)), back("body", 2), back("body", 1)
    cond = (
        f"bull and {change} > {d.confirm_change} and close > ma_5 and {back('bear', 2)} and {first} >= {d.first_body_threshold} "
        f"and {second} <= {first} * {d.small_body_ratio} and {ratio} >= {d.volume_ratio}"
    )
    return statement(first_of([(cond, {
        "signal_date": "time", "first_candle_date": back("time", 2), "first_candle_open": r(back("open", 2)), "first_candle_close": r(back("close", 2)),
        "second_candle_date": back("time", 1), "second_candle_open": r(back("open", 1)), "second_candle_close": r(back("close", 1)), "third_candle_open": r("open"),
        "third_candle_close": r("close"), "first_bear_body": r(first), "middle_body": r(second), "confirm_change_pct": r(change), "ma5": r("ma_5"), "volume_ratio": r(ratio),
    })]))


def multi_golden_cross(d: det.MultiGoldenCross) -> str:
    at = {c: run("max", f"case when {c} then rn end", d.lookback_days - 1) for c in ("ma_cross", "kdj_cross", "macd_cross")}
    day = {c: run("max", f"case when {c} then time end", d.lookback_days - 1) for c in at}
    a, b, c = at.values()
    ratio = tiny("volume", "volume_ma_5")
    gap = f"(greatest({a}, {b}, {c}) - least({a}, {b}, {c}))"
    cond = f"{a} is not null and {b} is not null and {c} is not null and bull_bear is not null and {gap} <= {d.resonance_days} and close > ma_5 and close > ma_20 and {ratio} >= {d.min_volume_ratio}"
    return statement(first_of([(cond, {
        "signal_date": "time", "key_date": f"least({', '.join(day.values())})", "ma_cross_date": day["ma_cross"], "kdj_cross_date": day["kdj_cross"], "macd_cross_date": day["macd_cross"],
        "max_gap_days": gap, "ma5": r("ma_5"), "ma20": r("ma_20"), "k": r("k"), "d": r("d"), "j": r("j"), "dif": r("dif"), "dea": r("dea"), "macd": r("hist"),
        "volume_ratio": r(ratio), "short_term_trend": r("short_trend"), "bull_bear_line": r("bull_bear"),
    })]))


def multi_party_cannon(d: det.MultiPartyCannon) -> str:
    o1, c1, v1, c2, v2 = back("open", 2), back("close", 2), back("volume", 2), back("close", 1), back("volume", 1)
    rise1, rise3, body1, body2 = tiny(f"{c1} - {o1}", o1), tiny("close - open", "open"), back("body", 2), back("body", 1)
    fallback = tiny(f"greatest({c1} - {c2}, 0.0)", f"abs({c1} - {o1})")
    cond = (
        f"{back('bull', 2)} and {rise1} >= {d.first_candle_rise} and {back('bear', 1)} and {body2} <= {body1} * {d.second_candle_body_ratio} and {fallback} <= {d.second_candle_fallback_ratio} "
        f"and bull and {rise3} >= {d.third_candle_rise} and close > {c1} and {v2} <= {v1} * {d.second_volume_shrink_ratio} and volume > {v1} * {d.third_volume_expand_ratio} "
        f"and coalesce(volume >= volume_ma_5 * {d.third_volume_ma_ratio}, true) and close >= ma_20"
    )
    both = lambda a, b: f"({rise1} >= {a} and {rise1} < {b} and {rise3} >= {a} and {rise3} < {b})"
    return statement(first_of([(cond, {
        "signal_date": "time", "pattern_category": f"case when {rise1} >= 0.07 and {rise3} >= 0.07 then 'strong' when {both(0.03, 0.07)} then 'standard' when {both(0.01, 0.03)} then 'weak' else 'standard' end",
        "first_rise_pct": r(rise1), "second_body_ratio": r(tiny(body2, body1)), "fallback_ratio": r(fallback), "third_rise_pct": r(rise3), "third_volume_ratio": r(tiny("volume", v1)),
        "third_vs_ma5_volume": r("coalesce(volume / volume_ma_5, 0.0)"), "ma20": r("ma_20"), "macd_hist": r("hist"), "j": r("j"),
    })]))


def resistance_breakout(d: det.ResistanceBreakout) -> str:
    options = []
    for o in range(d.max_search_days + 1):
        c, p, v, m, wall = back("close", o), back("prev", o), back("volume", o), back("volume_ma_5", o), back("top60", o)
        change = tiny(f"{c} - {p}", p)
        # The list holds the 60 bars before; its first highest bar's age follows from its place.
        age = f"(len({back('highs60', o)}) + 1 - list_position({back('highs60', o)}, {wall}))"
        held = f"{since('min', 'low', o)} >= {d.hold} * {wall}" if o else "true"
        cond = (
            f"rn > 61 and ma_5 > ma_10 and ma_10 > ma_20 and close > ma_5 and {change} >= {d.min_change_pct} and {c} >= {wall} * {1 + d.breakout_ratio!r} "
            f"and {v} >= {d.volume_ratio} * {m} and {age} >= {d.min_resistance_gap} and {held} and {back('bull', o)}"
        )
        options.append((cond, {
            "signal_date": "time", "breakout_date": back("time", o), "price": r("close"), "resistance": r(wall), "support": r(f"{d.hold} * {wall}"), "breakout_change_pct": r(change),
            "breakout_ratio": r(tiny(f"{c} - {wall}", wall)), "days_since_breakout": str(o), "volume_ratio": r(tiny(v, m)), "ma5": r("ma_5"), "ma10": r("ma_10"), "ma20": r("ma_20"),
        }))
    return statement(first_of(options))


def strong_wash_weak_to_strong(d: det.StrongWashWeakToStrong) -> str:
    options = []
    for o in (2, 3, 4, 5):
        c, v, m, w = back("close", o), back("volume", o), back("volume_ma_5", o), back("volume", o - 1)
        for k in range(o - 2, max(o - 5, -1), -1):
            cond = (
                f"{back('chg', o)} >= {d.surge} and {back('bull', o)} and {v} >= {d.surge_volume} * {m} and {back('bear', o - 1)} and {w} >= {d.wash_volume} * {v} "
                f"and {back('bull', k)} and ({back('close', k)} > {c} or {back('close', k)} > {back('open', o - 1)}) and {run('min', 'close', k)} > {c}"
            )
            options.append((cond, {
                "signal_date": "time", "big_candle_date": back("time", o), "wash_date": back("time", o - 1), "reversal_date": back("time", k),
                "big_candle_volume_ratio": r(tiny(v, m)), "wash_volume_ratio": r(tiny(w, v)), "days_after_reversal": str(k),
            }))
    return statement(first_of(options))


def trend_acceleration_inflection(d: det.TrendAccelerationInflection) -> str:
    options = []
    for o in range(5):
        low, v, m = back("low41", o), back("volume", o), back("volume_ma_5", o)
        near = tiny(f"{back('prev', o)} - {low}", low)
        cond = (
            f"rn >= 50 and slope20 > 0 and r2_20 >= {d.r2} and {back('chg', o)} >= {d.surge} and {v} >= {d.volume_ratio} * {m} and {near} <= {d.distance} "
            f"and {run('min', 'low', o)} >= {back('open', o)}"
        )
        options.append((cond, {
            "signal_date": "time", "trend_slope": r("slope20"), "trend_r2": r("r2_20"), "surge_date": back("time", o), "distance_from_low": r(near),
            "support_price": r(back("open", o)), "volume_ratio": r(f"{v} / {m}"),
        }))
    return statement(first_of(options))


def trend_start(d: det.TrendStart) -> str:
    ratio = tiny("volume", "volume_ma_5")
    cond = f"dif > 0 and macd_cross and prev < {back('ma_20', 1)} and close > ma_20 and bull and close > ma_5 and {ratio} > {d.volume_ratio}"
    return statement(first_of([(cond, {"signal_date": "time", "dif": r("dif"), "dea": r("dea"), "boll_mid": r("ma_20"), "ma5": r("ma_5"), "close": r("close"), "volume_ratio": r(ratio)})]))


def immortal_guidance(d: det.ImmortalGuidance) -> str:
    options = []
    for o in range(1, 4):
        high, top, p = back("high", o), f"greatest({back('open', o)}, {back('close', o)})", back("prev", o)
        surge, shadow, ratio = tiny(f"{high} - {p}", p), tiny(f"{high} - {top}", high), tiny(back("volume", o), back("volume_ma_5", o))
        retake = f"({top} + ({high} - {top}) * {d.anti_body_ratio})"
        if d.exclude_latest:
            below = f"{run('max', 'close', o - 1, 1)} < {retake}" if o > 1 else "true"
        else:
            below = f"{since('max', 'close', o)} < {retake}"
        cond = (
            f"close >= ma_5 and volume > 0 and slope20 > 0 and r2_20 >= {d.trend_r_squared_threshold} and {surge} >= {d.surge_threshold} and {shadow} >= {d.upper_shadow_ratio} "
            f"and {ratio} >= {d.volume_ratio_min} and {back('ma_5', o)} > {back('ma_10', o)} and {back('ma_10', o)} > {back('ma_20', o)} and close >= {retake} and {below}"
        )
        options.append((cond, {
            "signal_date": "time", "key_date": back("time", o), "price": r("close"), "volume_ratio": r(tiny("volume", "volume_ma_5")), "surge_pct": r(surge), "upper_shadow_ratio": r(shadow),
            "anti_body_price": r(retake), "support_level": r(back("open", o)), "key_day_close": r(back("close", o)), "key_day_high": r(high), "signal_volume_ratio": r(ratio),
            "days_to_confirm": str(o), "trend_slope": r("slope20"), "trend_r2": r("r2_20"),
            "ma5": r(back("ma_5", o)), "ma10": r(back("ma_10", o)), "ma20": r(back("ma_20", o)), "close_above_ma5": "close > ma_5",
        }))
    return statement(first_of(options))


def trend_resonance_reversal(d: det.TrendResonanceReversal) -> str:
    rose = lambda o: f"{back('rsi', o)} >= {d.rsi_breakout} and {back('rsi', o + 1)} < {d.rsi_breakout} and {back('rsi_low5', o)} <= {d.rsi_oversold}"
    rsi = first_of([(rose(o), {"rn": back("rn", o), "time": back("time", o), "close": back("close", o), "rsi": back("rsi", o)}) for o in range(d.signal_days - 1, -1, -1)])
    seen = lambda c, *cols: run("min", f"case when {c} then struct_pack(rn := rn, time := time, {', '.join(f'{x} := {x}' for x in cols)}) end", 2 * d.signal_days)
    extra = f""", days as (
        select symbol, exchange, time, rn, {rsi} as x, {seen("ma_cross", "ma_5", "ma_20")} as m, {seen("macd_cross", "dif", "dea")} as c from p),
    spans as (select *, greatest(x.rn, m.rn, c.rn) - least(x.rn, m.rn, c.rn) as span from days where x is not null and m is not null and c is not null)"""
    return (
        f"{PREPARED}{extra} select symbol, exchange, time, x.time as signal_date, m.time as ma_cross_day, c.time as macd_cross_day, {r('x.rsi')} as rsi_value, {r('m.ma_5')} as ma_short, "
        f"{r('m.ma_20')} as ma_long, {r('c.dif')} as macd_dif, {r('c.dea')} as macd_dea, {r('x.close')} as close, span as max_time_diff from spans where rn >= 31 and span <= {d.signal_days}"
    )


def w_bottom(d: det.WBottom) -> str:
    n = d.pattern_days
    extra = f""", lows as (
        select *, list_filter({run("list", "case when dip then struct_pack(rn := rn, low := low, volume := volume, time := time) end", n - 3, 6)}, lambda x: x is not null) as dips,
               {run("list", "high", n - 1)} as highs from p),
    pairs as (select *, dips[-2] as a, dips[-1] as b from lows where rn >= {n} and len(dips) >= 2),
    necks as (select *, list_max(highs[a.rn - rn + len(highs) : b.rn - rn + len(highs)]) as neck,
                     list_max(highs[a.rn + 1 - rn + len(highs) : least(a.rn + 30, rn) - rn + len(highs)]) as ahead, {tiny("abs(a.low - b.low)", "a.low")} as diff from pairs)"""
    # Bars around the latest come from p, by number.
    options = []
    for o in (4, 3, 2, 1, 0):
        cond = f"c[{o + 1}].chg > {d.surge} and c[{o + 1}].volume >= {d.volume_expand_ratio} * c[{o + 1}].mean and c[{o + 1}].close >= neck * {1 + d.breakout_ratio!r} and c[{o + 1}].prev < neck"
        kept = f"list_min(list_transform(c[{max(0, o - d.support_days) + 1}:{o}], lambda x: x.close))" if o else "cast('inf' as double)"
        options.append((cond, {"time": f"c[{o + 1}].time", "kept": kept, "ratio": f"c[{o + 1}].volume / greatest(c[{o + 1}].mean, 0.000001)"}))
    extra += f""", recent as (
        select symbol, rn, [{", ".join(f"struct_pack(time := {back('time', o)}, chg := {back('chg', o)}, volume := {back('volume', o)}, mean := {back('volume_ma_5', o)}, close := {back('close', o)}, prev := {back('prev', o)})" for o in range(5))}] as c from p),
    broke as (select n.*, {first_of(options)} as hit from necks n join recent using (symbol, rn))"""
    return f"""{PREPARED}{extra}
    select symbol, exchange, time, time as signal_date, hit.time as key_date, a.time as left_bottom_date, b.time as right_bottom_date, {r("neck")} as neckline, {r("diff")} as bottom_diff_ratio,
           {r("hit.ratio")} as break_volume_ratio, {r(f"neck * {d.support_ratio}")} as support_price, a.volume > 0 and b.volume < a.volume * {d.volume_shrink_ratio} as volume_shrink,
           {r("case when a.volume > 0 then b.volume / a.volume else 0.0 end")} as volume_shrink_ratio
    from broke where hit is not null and b.rn - a.rn > {d.min_gap} and diff <= {d.bottom_diff_threshold} and neck >= a.low * {d.neck_ratio} and ma_10 > ma_30 and ahead > a.low * {d.rise_ratio}
      and hit.kept >= neck * {d.support_ratio}"""


def strategy_2560_selection(d: det.Strategy2560Selection) -> str:
    change, ratio = tiny("close - prev", "prev"), tiny("volume", "volume_ma_5")
    cond = (
        f"close > ma_25 and prev <= {back('ma_25', 1)} and volume_ma_5 > volume_ma_60 and {back('volume_ma_5', 1)} <= {back('volume_ma_60', 1)} and close > ma_10 "
        f"and {change} >= {d.min_change} and {ratio} >= {d.volume_ratio}"
    )
    return statement(first_of([(cond, {
        "signal_date": "time", "ma25": r("ma_25"), "ma10": r("ma_10"), "price_change_pct": r(change), "close": r("close"), "prev_close": r("prev"), "volume_ratio": r(ratio),
        "vol_ma5": r("volume_ma_5"), "vol_ma60": r("volume_ma_60"),
    })]))


BUILDERS = {
    f.__name__: f
    for f in (
        bottom_trend_inflection, limit_up_pullback, limit_up_sideways, morning_star, multi_golden_cross, multi_party_cannon, resistance_breakout, strong_wash_weak_to_strong,
        trend_acceleration_inflection, trend_start, immortal_guidance, trend_resonance_reversal, w_bottom, strategy_2560_selection,
    )
}
