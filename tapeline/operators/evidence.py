"""What a signal's evidence says beside a detector's own values: dates under their other names, kinds and reasons."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The kinds of key dates.
KINDS = {
    "limit_up_pullback": "涨停日",
    "limit_up_sideways": "涨停日",
    "multi_golden_cross": "多金叉共振日",
    "resistance_breakout": "阻力位突破日",
    "immortal_guidance": "仙人指路信号日",
    "trend_resonance_reversal": "RSI突破日",
    "w_bottom": "颈线突破日",
}
#: Other names of a detector's dates and values.
ALSO: dict[str, dict[str, str]] = {
    "limit_up_pullback": {"limit_up_date": "key_date"},
    "limit_up_sideways": {"limit_up_date": "key_date"},
    "morning_star": {"key_date": "signal_date", "third_candle_date": "signal_date"},
    "multi_party_cannon": {"key_date": "signal_date"},
    "resistance_breakout": {"key_date": "breakout_date"},
    "trend_start": {"key_date": "signal_date"},
    "immortal_guidance": {"signal_day": "key_date", "key_day_open": "support_level"},
    "trend_resonance_reversal": {"key_date": "signal_date", "rsi_breakout_day": "signal_date"},
    "w_bottom": {"break_date": "key_date"},
}


def percent(x: Column) -> Column:
    return x * 100


#: A text for each reason, and the values in it.
REASONS: dict[str, Callable[[Column], list[tuple]]] = {
    "limit_up_pullback": lambda e: [
        ("volume ratio of the limit-up day %.2f", e["volume_ratio"]),
        ("pullback of %d days within a range of %.2f%%", e["pullback_days"], percent(e["pullback_range"])),
        ("support at %.2f held, on shrinking volume at least once", e["support_price"]),
    ],
    "limit_up_sideways": lambda e: [
        ("a limit-up day on high volume, support at %.2f", e["support_level"]),
        ("%d days sideways within [%.2f, %.2f], above %.2f", e["sideways_days"], e["sideways_lowest"], e["sideways_highest"], e["support_lower_limit"]),
        ("volume %.2f times the day before, %s", e["volume_increase"], F.when(e["kdj_cross"], "KDJ crosses upward").otherwise("MACD crosses upward")),
    ],
    "morning_star": lambda e: [
        ("first long falling body %.2f%%", percent(e["first_bear_body"])),
        ("second body %.1f%% of the first", percent(e["middle_body"] / F.greatest(e["first_bear_body"], F.lit(1e-6)))),
        ("third bar rises %.2f%% and stands above MA5 %.2f", percent(e["confirm_change_pct"]), e["ma5"]),
        ("third volume %.2f times the second", e["volume_ratio"]),
    ],
    "multi_golden_cross": lambda e: [("moving averages cross",), ("KDJ crosses",), ("MACD crosses",), ("several indicators agree",)],
    "multi_party_cannon": lambda e: [
        ("first bar rises %.2f%%", percent(e["first_rise_pct"])),
        ("second bar falls back %.2f%%, its body %.1f%% of the first", percent(e["fallback_ratio"]), percent(e["second_body_ratio"])),
        ("third bar rises %.2f%%", percent(e["third_rise_pct"])),
        ("third volume %.2f times the first", e["third_volume_ratio"]),
    ],
    "resistance_breakout": lambda e: [
        ("breaks the resistance at %.2f on high volume, up %.1f%%", e["resistance"], percent(e["breakout_change_pct"])),
        ("volume %.1f times its mean", e["volume_ratio"]),
        ("%d days since the breakout, above the support at %.2f", e["days_since_breakout"], e["support"]),
    ],
    "trend_start": lambda e: [("MACD crosses upward, the close crosses the Bollinger middle, a rising bar above MA5 on more volume",)],
    "immortal_guidance": lambda e: [
        ("a long upper shadow that is retaken",),
        ("surge of %.2f%%, shadow of %.2f%%", percent(e["surge_pct"]), percent(e["upper_shadow_ratio"])),
        ("volume ratio %.2f, moving averages in rising order", e["signal_volume_ratio"]),
        ("%.2f, half of the shadow, retaken within %d days", e["anti_body_price"], e["days_to_confirm"]),
    ],
    "trend_resonance_reversal": lambda e: [("RSI rises from the oversold zone to %.0f", e["rsi_value"]), ("MA5 crosses above MA20",), ("MACD crosses upward",)],
    "w_bottom": lambda e: [
        ("two lows %.2f%% apart", percent(e["bottom_diff_ratio"])),
        ("neckline %.2f, broken on %.2f times the mean volume", e["neckline"], e["break_volume_ratio"]),
        ("support at %.2f holds", e["support_price"]),
    ],
}


#: What stands for a value in a reason.
PLACE = re.compile(r"%(?:%|d|s|\.(\d)f)")


def fixed(x: Column, digits: int) -> Column:
    """A number with so many digits, rounded by its exact binary value as printed numbers usually are
    (format_string rounds the shortest decimal form instead: 2.675 would become 2.68)."""
    return F.replace(F.format_number(x, digits), F.lit(","), F.lit(""))


def reason(template: str, values: list[Column]) -> Column:
    """The template with its values; a null one makes it null."""
    rest, shown = iter(values), []
    for m in PLACE.finditer(template):
        if m[0] != "%%":
            value = next(rest)
            shown.append(fixed(value, int(m[1])) if m[1] else value)
    text = PLACE.sub(lambda m: "%s" if m[1] else m[0], template)
    return F.format_string(text, *shown) if shown else F.lit(text.replace("%%", "%"))


def whole(pattern_id: str, e: Column, names: list[str]) -> Column:
    """The evidence struct e (with fields names) of a built-in pattern with all that belongs to it; others as they are."""
    fields = {n: e[n] for n in names}
    fields |= {n: e[of] for n, of in ALSO.get(pattern_id, {}).items()}
    if pattern_id in KINDS:
        fields["key_date_type"] = F.lit(KINDS[pattern_id])
    if pattern_id == "trend_start":
        fields["pattern_type"] = F.lit("today_macd_today_boll")
    if pattern_id == "w_bottom":
        fields["trend_reversal"] = F.lit(True)
    if pattern_id == "immortal_guidance":
        above = fields.pop("close_above_ma5")
        fields["confirmation_details"] = F.struct(
            F.lit(True).alias("confirmed"), e["signal_date"].alias("confirmed_date"), e["days_to_confirm"].alias("days_to_confirm"),
            e["price"].alias("anti_body_price"), above.alias("close_above_ma5"), F.lit(True).alias("post_confirmation_stable"),
        )
    if pattern_id in REASONS:
        fields["reasons"] = F.array(*[reason(text, values) for text, *values in REASONS[pattern_id](e)])
    return F.struct(*[x.alias(n) for n, x in fields.items()])
