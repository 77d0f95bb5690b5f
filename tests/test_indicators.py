import datetime as dt
import math
import random

import pytest

from tapeline.operators import indicators as ind


def bars(spark, closes, volume=True):
    rows = [("000001.SZ", "SZ", dt.date(2025, 1, 1) + dt.timedelta(days=k), c, c + 0.5, c - 0.5, c, 1000.0 + k) for k, c in enumerate(closes)]
    df = spark.createDataFrame(rows, "symbol string, exchange string, time date, open double, high double, low double, close double, volume double")
    return df if volume else df.drop("volume")


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("time").collect()]


def test_default_set(spark):
    out = ind.compute(bars(spark, [10.0 + k for k in range(30)]), ind.DEFAULT_PATTERN_SET)
    assert out.columns[8:] == ind.output_columns(ind.DEFAULT_PATTERN_SET)
    got = values(out, "ma_20", "boll_upper_20_2")
    assert len(got) == 30 and got[18] == (None, None) and None not in got[19]


def test_missing_volume_counts_as_zero(spark):
    out = ind.compute(bars(spark, [1.0, 2.0, 3.0, 4.0, 5.0], volume=False), [ind.VolumeMa((5,))])
    assert values(out, "volume_ma_5")[-1] == (0.0,)


def test_only_what_is_asked_for(spark):
    out = ind.compute(bars(spark, [10.0 + k for k in range(30)]), [ind.Ma((3, 5, 3)), ind.VolumeMa((2,)), ind.Macd(), ind.Kdj()])
    assert values(out, "ma_3")[2] == (11.0,)
    assert "ma_10" not in out.columns and out.columns[8:11] == ["ma_3", "ma_5", "volume_ma_2"]


def test_normalize_merges_sorts_and_drops_zero():
    got = ind.normalize([ind.Rsi((14, 0, 6)), ind.Ma((20, 5)), ind.Ma((5, 10)), ind.Macd(), ind.Macd()])
    assert got == [ind.Ma((5, 10, 20)), ind.Macd(), ind.Rsi((6, 14))]
    assert ind.Boll(20, 2.5).columns()[1] == "boll_upper_20_2_5"


@pytest.mark.parametrize("bad", [ind.Macd(0, 26, 9), ind.Kdj(9, 0, 3), ind.Boll(0), ind.Boll(20, math.inf), ind.ShortTrend(10, 0), ind.BullBear((14, 0, 57, 114))])
def test_parameters_are_checked(bad):
    with pytest.raises(ValueError):
        ind.normalize([bad])


def slow(closes, highs, lows):
    """The definitions, one row after another."""
    n = len(closes)

    def ema(x, span):
        a, out = 2 / (span + 1), []
        for v in x:
            out.append(v if not out else a * v + (1 - a) * out[-1])
        return out

    dif = [a - b for a, b in zip(ema(closes, 12), ema(closes, 26), strict=True)]
    dea = ema(dif, 9)
    k, d = [], []
    for i in range(n):
        hi, lo = max(highs[max(0, i - 8) : i + 1]), min(lows[max(0, i - 8) : i + 1])
        rsv = 50.0 if hi == lo else (closes[i] - lo) / (hi - lo) * 100
        k.append(rsv if not k else k[-1] * 2 / 3 + rsv / 3)
        d.append(k[-1] if not d else d[-1] * 2 / 3 + k[-1] / 3)
    rsi, g, s = [None] * n, 0.0, 0.0
    for i in range(1, n):
        up, down = max(closes[i] - closes[i - 1], 0), max(closes[i - 1] - closes[i], 0)
        g, s = (g + up / 14, s + down / 14) if i <= 14 else ((g * 13 + up) / 14, (s * 13 + down) / 14)
        if i >= 14:
            rsi[i] = 100.0 if s <= 1e-12 else 100 - 100 / (1 + g / s)
    return list(zip(dif, dea, k, d, rsi, ema(ema(closes, 10), 10), strict=True))


def test_recursive_indicators_by_definition(spark):
    r = random.Random(3)
    closes = [100.0]
    for _ in range(199):
        closes.append(max(1.0, closes[-1] + r.uniform(-3, 3)))
    closes[60:70] = [closes[60]] * 10
    out = ind.compute(bars(spark, closes), [ind.Macd(), ind.Kdj(), ind.Rsi((14,)), ind.ShortTrend()])
    got = values(out, "macd_dif_12_26", "macd_dea_12_26_9", "k_9_3_3", "d_9_3_3", "rsi_14", "short_trend_10_10")
    for a, b in zip(got, slow(closes, [c + 0.5 for c in closes], [c - 0.5 for c in closes]), strict=True):
        assert all((x is None) == (y is None) and (x is None or abs(x - y) < 1e-8) for x, y in zip(a, b, strict=True))


def test_short_and_flat_series(spark):
    out = ind.compute(bars(spark, [5.0, 5.0]), ind.DEFAULT_PATTERN_SET)
    got = values(out, "rsi_14", "ma_5", "macd_dif_12_26")
    assert got == [(None, None, 0.0)] * 2
    flat = ind.compute(bars(spark, [5.0] * 30), [ind.Rsi((14,))])
    assert values(flat, "rsi_14")[-1] == (100.0,)
