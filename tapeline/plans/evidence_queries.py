"""The evidence of every detector as JSON, read back field by field, with its reasons in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.operators import detectors as det
from tapeline.operators import scan
from tapeline.plans import detector_sql as ds
from tapeline.plans.queries import RELAXED, _ready, query


def _field(name: str, kind: str = "string"):
    return F.get_json_object("evidence", f"$.{name}").cast(kind).alias(name)


@query(f"""
    select symbol, strftime(time, '%Y-%m-%d') as time, strftime(key_date, '%Y-%m-%d') as key_date, '涨停日' as key_date_type, strftime(key_date, '%Y-%m-%d') as limit_up_date,
           pullback_days, round(volume_ratio, 6) as volume_ratio, has_lower_close, 3 as reasons, concat('pullback of ', pullback_days, ' days within a range of ', printf('%.2f', pullback_range * 100), '%') as reason
    from ({ds.exact(det.LimitUpPullback())})""")
def evidence_of_pullbacks(spark, sf_dir):
    found = scan.signals(_ready(spark, sf_dir), [det.LimitUpPullback()], latest_only=False)
    return found.select(
        "symbol", F.col("time").cast("string").alias("time"), _field("key_date"), _field("key_date_type"), _field("limit_up_date"), _field("pullback_days", "int"),
        F.round(_field("volume_ratio", "double"), 6).alias("volume_ratio"), _field("has_lower_close", "boolean"), F.json_array_length(F.get_json_object("evidence", "$.reasons")).alias("reasons"),
        F.get_json_object("evidence", "$.reasons[1]").alias("reason"),
    )


@query(f"""
    select symbol, strftime(time, '%Y-%m-%d') as time, strftime(signal_date, '%Y-%m-%d') as key_date, 'today_macd_today_boll' as pattern_type, dif, ma5, 1 as reasons
    from ({ds.trend_start(det.TrendStart())})""")
def evidence_of_trend_starts(spark, sf_dir):
    found = scan.signals(_ready(spark, sf_dir), [det.TrendStart()], latest_only=False)
    return found.select(
        "symbol", F.col("time").cast("string").alias("time"), _field("key_date"), _field("pattern_type"), F.round(_field("dif", "double"), 6).alias("dif"),
        F.round(_field("ma5", "double"), 6).alias("ma5"), F.json_array_length(F.get_json_object("evidence", "$.reasons")).alias("reasons"),
    )


#: For each detector that gives reasons: its dates under other names, the kind of its key date, and the reasons in SQL
#: over its unrounded values.
TEXTS: dict[str, tuple[dict[str, str], str | None, list[str]]] = {
    "limit_up_pullback": ({"limit_up_date": "key_date"}, "涨停日", [
        "printf('volume ratio of the limit-up day %.2f', volume_ratio)",
        "printf('pullback of %d days within a range of %.2f%%', pullback_days, pullback_range * 100)",
        "printf('support at %.2f held, on shrinking volume at least once', support_price)",
    ]),
    "limit_up_sideways": ({"limit_up_date": "key_date"}, "涨停日", [
        "printf('a limit-up day on high volume, support at %.2f', support_level)",
        "printf('%d days sideways within [%.2f, %.2f], above %.2f', sideways_days, sideways_lowest, sideways_highest, support_lower_limit)",
        "printf('volume %.2f times the day before, %s', volume_increase, case when kdj_cross then 'KDJ crosses upward' else 'MACD crosses upward' end)",
    ]),
    "morning_star": ({"key_date": "signal_date", "third_candle_date": "signal_date"}, None, [
        "printf('first long falling body %.2f%%', first_bear_body * 100)",
        "printf('second body %.1f%% of the first', middle_body / greatest(first_bear_body, 0.000001) * 100)",
        "printf('third bar rises %.2f%% and stands above MA5 %.2f', confirm_change_pct * 100, ma5)",
        "printf('third volume %.2f times the second', volume_ratio)",
    ]),
    "multi_golden_cross": ({}, "多金叉共振日", ["'moving averages cross'", "'KDJ crosses'", "'MACD crosses'", "'several indicators agree'"]),
    "multi_party_cannon": ({"key_date": "signal_date"}, None, [
        "printf('first bar rises %.2f%%', first_rise_pct * 100)",
        "printf('second bar falls back %.2f%%, its body %.1f%% of the first', fallback_ratio * 100, second_body_ratio * 100)",
        "printf('third bar rises %.2f%%', third_rise_pct * 100)",
        "printf('third volume %.2f times the first', third_volume_ratio)",
    ]),
    "resistance_breakout": ({"key_date": "breakout_date"}, "阻力位突破日", [
        "printf('breaks the resistance at %.2f on high volume, up %.1f%%', resistance, breakout_change_pct * 100)",
        "printf('volume %.1f times its mean', volume_ratio)",
        "printf('%d days since the breakout, above the support at %.2f', days_since_breakout, support)",
    ]),
    "trend_start": ({"key_date": "signal_date"}, None, ["'MACD crosses upward, the close crosses the Bollinger middle, a rising bar above MA5 on more volume'"]),
    "immortal_guidance": ({"signal_day": "key_date"}, "仙人指路信号日", [
        "'a long upper shadow that is retaken'",
        "printf('surge of %.2f%%, shadow of %.2f%%', surge_pct * 100, upper_shadow_ratio * 100)",
        "printf('volume ratio %.2f, moving averages in rising order', signal_volume_ratio)",
        "printf('%.2f, half of the shadow, retaken within %d days', anti_body_price, days_to_confirm)",
    ]),
    "trend_resonance_reversal": ({"key_date": "signal_date", "rsi_breakout_day": "signal_date"}, "RSI突破日", [
        "printf('RSI rises from the oversold zone to %.0f', rsi_value)", "'MA5 crosses above MA20'", "'MACD crosses upward'",
    ]),
    "w_bottom": ({"break_date": "key_date"}, "颈线突破日", [
        "printf('two lows %.2f%% apart', bottom_diff_ratio * 100)",
        "printf('neckline %.2f, broken on %.2f times the mean volume', neckline, break_volume_ratio)",
        "printf('support at %.2f holds', support_price)",
    ]),
}


def _evidence(d: det.Detector) -> None:
    also, kind, reasons = TEXTS[d.id]

    def run(spark, sf_dir):
        found = scan.signals(_ready(spark, sf_dir), [d], latest_only=False)
        texts = F.from_json(F.get_json_object("evidence", "$.reasons"), "array<string>")
        return found.select("symbol", F.col("time").cast("string").alias("time"), *[_field(n) for n in also], _field("key_date_type"), F.array_join(texts, " | ").alias("reasons"))

    run.__name__ = f"evidence_{d.id}"
    dates = "".join(f"strftime({of}, '%Y-%m-%d') as {n}, " for n, of in also.items())
    shown = f"'{kind}'" if kind else "cast(null as varchar)"
    query(f"select symbol, strftime(time, '%Y-%m-%d') as time, {dates}{shown} as key_date_type, concat_ws(' | ', {', '.join(reasons)}) as reasons from ({ds.exact(d)})", run.__name__)(run)


for _id in TEXTS:
    _evidence(RELAXED.get(_id, det.REGISTRY[_id]))


def _plain(d: det.Detector) -> None:
    """Detectors without reasons: every member of the evidence, as the JSON has it."""

    def run(spark, sf_dir):
        made = scan.evidence_frame(_ready(spark, sf_dir), d)
        kinds = {c: k for c, k in made.dtypes if c not in ("symbol", "exchange", "time")}
        found = scan.signals(_ready(spark, sf_dir), [d], latest_only=False)
        value = lambda c, k: F.round(_field(c, k), 6).alias(c) if k == "double" else _field(c, "string" if k in ("date", "timestamp") else k)
        return found.select("symbol", F.col("time").cast("string").alias("time"), *[value(c, k) for c, k in kinds.items()])

    run.__name__ = f"evidence_{d.id}"
    dates = {"signal_date", "surge_date", "big_candle_date", "wash_date", "reversal_date"}
    sql = ds.BUILDERS[d.id](d)
    texts = ", ".join(f"strftime({c}, '%Y-%m-%d') as {c}" for c in sorted(dates) if f" as {c}" in sql or f"{c} := " in sql)
    query(f"select * exclude (exchange) replace (strftime(time, '%Y-%m-%d') as time, {texts}) from ({sql})", run.__name__)(run)


for _id in det.REGISTRY:
    if _id not in TEXTS:
        _plain(RELAXED.get(_id, det.REGISTRY[_id]))
