"""The engine's queries over the generic test tables, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions import scalars as sc
from tapeline.operators import detectors as det
from tapeline.operators import frame as fr
from tapeline.operators import indicators as ind
from tapeline.operators import scan
from tapeline.operators.numbering import chunk_numbers, worker_numbers
from tapeline.plans import detector_sql as ds
from tapeline.sources.bars import DAILY_SQL, INTRADAY_SQL, daily_bars, intraday_bars
from tapeline.streaming.quotes import publish_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BARS = f"bars as ({DAILY_SQL})"


def query(sql: str | None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = sql
        return f

    return add


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, as the SQL has them."""
    return df.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(DAILY_SQL)
def bars_daily(spark, sf_dir):
    return daily_bars(spark, sf_dir)


@query(f"select symbol, time, round(open, 6) as open, round(high, 6) as high, round(low, 6) as low, round(close, 6) as close, volume from ({INTRADAY_SQL})")
def bars_intraday(spark, sf_dir):
    return rounded(intraday_bars(spark, sf_dir))


RAW_BARS_SQL = "select concat(lpad(cast(l_suppkey as string), 6, '0'), '.SZ') as symbol, cast(l_shipdate as date) as time, l_orderkey, l_linenumber, l_partkey, l_extendedprice as close from lineitem"


def _raw(spark, sf_dir):
    """Trades as bars with many duplicates of a key, and an order that leaves no ties in what is kept."""
    df = _read(spark, sf_dir, "lineitem")
    symbol = F.concat(F.lpad(F.col("l_suppkey").cast("string"), 6, "0"), F.lit(".SZ"))
    return df.select(symbol.alias("symbol"), F.col("l_shipdate").cast("date").alias("time"), "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("close"))


def _kept(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in ("l_orderkey", "l_linenumber", "l_partkey", "close"))
    return f"select * from ({RAW_BARS_SQL}) qualify row_number() over (partition by symbol, time order by {order}) = 1"


_SEQ = ["l_orderkey", "l_linenumber", "l_partkey", "close"]


@query(_kept("desc"))
def dedup_keep_last(spark, sf_dir):
    return fr.dedup(_raw(spark, sf_dir), [F.col(c) for c in _SEQ])


@query(_kept("asc"))
def dedup_keep_first(spark, sf_dir):
    return fr.dedup(_raw(spark, sf_dir), [F.col(c) for c in _SEQ], keep="first")


@query(f"with {BARS} select symbol, time, close, volume from bars where exchange = 'SZ' union all select symbol, time, close, volume from bars where exchange = 'SH'")
def union_normalized(spark, sf_dir):
    bars = daily_bars(spark, sf_dir).select("symbol", "time", "close", "volume", "exchange")
    whole = bars.where("exchange = 'SZ'").drop("exchange").withColumn("volume", F.col("volume").cast("long"))
    return fr.union_frames(spark, [whole, bars.where("exchange = 'SH'").drop("exchange")])


@query(f"with {BARS} select distinct symbol from bars")
def symbols_distinct(spark, sf_dir):
    return fr.symbols(daily_bars(spark, sf_dir))


_SYMBOLS_SQL = "select concat(lpad(cast(c_custkey * 397 % 700000 as string), 6, '0'), case c_custkey % 4 when 0 then '.SH' when 1 then '.SZ' when 2 then '.BJ' else '' end) as symbol from customer"


def _symbols(spark, sf_dir):
    k = F.col("c_custkey")
    tail = F.when(k % 4 == 0, ".SH").when(k % 4 == 1, ".SZ").when(k % 4 == 2, ".BJ").otherwise("")
    return _read(spark, sf_dir, "customer").select(F.concat(F.lpad((k * 397 % 700000).cast("string"), 6, "0"), tail).alias("symbol"))


@query(f"""
    select symbol, case when symbol like '%.SH' then substr(symbol, 1, 3) in ('600', '601', '603', '605', '688', '689')
                        when symbol like '%.SZ' then substr(symbol, 1, 3) in ('000', '001', '002', '003', '300', '301')
                        when symbol like '%.BJ' then false
                        else substr(symbol, 1, 3) in ('600', '601', '603', '605', '688', '689', '000', '001', '002', '003', '300', '301') end as a_share
    from ({_SYMBOLS_SQL})""")
def a_share_filter(spark, sf_dir):
    return _symbols(spark, sf_dir).select("symbol", sc.is_a_share(F.col("symbol")).alias("a_share"))


@query(f"""
    select symbol, case when position('.' in symbol) > 0 then split_part(symbol, '.', 2) end as exchange,
           case when position('.' in symbol) > 0 then split_part(symbol, '.', 1) end as code,
           case when position('.' in symbol) > 0 then symbol end as normalized
    from ({_SYMBOLS_SQL})""")
def symbol_parse(spark, sf_dir):
    s = F.col("symbol")
    return _symbols(spark, sf_dir).select("symbol", sc.exchange_of(s).alias("exchange"), sc.split_symbol(F.lower(s))["code"].alias("code"), sc.normalize_symbol(F.lower(s)).alias("normalized"))


_DIRTY_SQL = f"""select symbol, time, open, high, low, case when volume % 7 = 0 then null when volume % 11 = 0 then cast('nan' as double) when volume % 13 = 0 then cast('inf' as double) else close end as close,
    case when volume % 17 = 0 then -volume else volume end as volume from ({DAILY_SQL})"""


def _dirty(spark, sf_dir):
    v, special = F.col("volume"), lambda x: F.lit(x).cast("double")
    close = F.when(v % 7 == 0, F.lit(None)).when(v % 11 == 0, special("NaN")).when(v % 13 == 0, special("Infinity")).otherwise(F.col("close"))
    return daily_bars(spark, sf_dir).select("symbol", "time", "open", "high", "low", close.alias("close"), F.when(v % 17 == 0, -v).otherwise(v).alias("volume"))


@query(f"select * from ({_DIRTY_SQL}) where close is not null and isfinite(close) and volume >= 0")
def valid_bar_filter(spark, sf_dir):
    return _dirty(spark, sf_dir).where(sc.is_valid_bar(*[F.col(c) for c in ("open", "high", "low", "close", "volume")]))


@query(f"with {BARS} select * from bars where time between date '1995-03-01' and date '1995-05-31' and symbol in ('000001.SH', '000002.SZ', '000007.SH')")
def date_range_filter(spark, sf_dir):
    import datetime as dt

    bars = fr.between_dates(daily_bars(spark, sf_dir), dt.date(1995, 3, 1), dt.date(1995, 5, 31))
    return bars.where(F.col("symbol").isin("000001.SH", "000002.SZ", "000007.SH"))


@query(f"select symbol, time, close from (select case when volume % 5 = 0 then null else symbol end as symbol, case when volume % 9 = 0 then null else time end as time, close from ({DAILY_SQL})) where symbol is not null and time is not null")
def null_key_drop(spark, sf_dir):
    v = F.col("volume")
    bars = daily_bars(spark, sf_dir)
    return fr.drop_null_keys(bars.select(F.when(v % 5 != 0, F.col("symbol")).alias("symbol"), F.when(v % 9 != 0, F.col("time")).alias("time"), "close"))


_USER_DAYS_SQL = "select cast(user_id as string) as symbol, cast(ts as date) as time, count(*) as n from events group by user_id, cast(ts as date)"


@query(f"select symbol, count(*) as bars, count(*) >= 20 as long_enough from ({_USER_DAYS_SQL}) group by symbol")
def min_history_gate(spark, sf_dir):
    days = _read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("symbol"), F.col("ts").cast("date").alias("time")).distinct()
    return days.groupBy("symbol").agg(F.count("*").alias("bars")).withColumn("long_enough", F.col("bars") >= scan.MIN_BARS)


_WANTED_SQL = "select concat(lpad(cast(s_suppkey as string), 6, '0'), case when s_suppkey % 2 = 0 then '.SZ' else '.SH' end) as symbol from supplier"


def _wanted(spark, sf_dir):
    k = F.col("s_suppkey")
    return _read(spark, sf_dir, "supplier").select(F.concat(F.lpad(k.cast("string"), 6, "0"), F.when(k % 2 == 0, ".SZ").otherwise(".SH")).alias("symbol"))


@query(f"with {BARS} select distinct symbol from ({_WANTED_SQL}) where symbol not in (select symbol from bars)")
def missing_symbols_anti(spark, sf_dir):
    return fr.missing(_wanted(spark, sf_dir), daily_bars(spark, sf_dir))


@query(f"""with {BARS} select symbol, time, close, true as adjusted from bars where exchange = 'SZ'
    union all select symbol, time, close + 1 as close, false as adjusted from bars where symbol not in (select symbol from bars where exchange = 'SZ')""")
def fallback_merge(spark, sf_dir):
    bars = daily_bars(spark, sf_dir)
    return fr.with_fallback(bars.where("exchange = 'SZ'").select("symbol", "time", "close"), bars.select("symbol", "time", (F.col("close") + 1).alias("close")))


@query(f"with {BARS} select distinct symbol from bars union select distinct symbol from ({_WANTED_SQL})")
def union_distinct_codes(spark, sf_dir):
    return fr.union_distinct([fr.symbols(daily_bars(spark, sf_dir)), _wanted(spark, sf_dir)])


@query(f"with {BARS} select exchange, strftime(time, '%Y') as year, strftime(time, '%m') as month, count(*) as bars from bars group by all")
def partition_counts_daily(spark, sf_dir):
    return fr.month_keys(daily_bars(spark, sf_dir)).groupBy("exchange", "year", "month").agg(F.count("*").alias("bars"))


@query(f"select strftime(time, '%Y-%m-%d') as trade_date, symbol as exchange, count(*) as bars from ({INTRADAY_SQL}) group by all")
def partition_counts_minute(spark, sf_dir):
    return fr.day_keys(intraday_bars(spark, sf_dir)).groupBy("trade_date", F.col("symbol").alias("exchange")).agg(F.count("*").alias("bars"))


@query("""
    with ranges as (select distinct cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e from orders group by o_custkey % 20),
    months as (select s, e, unnest(generate_series(date_trunc('month', s), e, interval 1 month)) as m from ranges)
    select greatest(s, cast(m as date)) as window_start, least(e, last_day(cast(m as date))) as window_end from months""")
def month_windows(spark, sf_dir):
    spans = _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey") % 20).agg(F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end"))
    return fr.month_windows(spans.select("start", "end").distinct())


@query("""
    select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as dashed, strftime(o_orderdate, '%Y%m%d') as compact, cast(null as varchar) as bad,
           strftime(cast(o_orderdate as date) + interval '9 hours 30 minutes', '%Y%m%d%H%M%S') as stamp, concat(strftime(o_orderdate, '%Y-%m-%d'), ' 09:15:00') as opens
    from orders""")
def date_normalize(spark, sf_dir):
    d = F.col("o_orderdate")
    compact, dashed = F.date_format(d, "yyyyMMdd"), F.date_format(d, "yyyy-MM-dd")
    return _read(spark, sf_dir, "orders").select(
        "o_orderkey", sc.dashed_date(compact).alias("dashed"), sc.compact_date(dashed).alias("compact"), sc.dashed_date(F.concat(dashed, F.lit("x"))).alias("bad"),
        sc.compact_datetime(F.concat(dashed, F.lit(" 09:30:00"))).alias("stamp"), sc.session_bounds(compact)[0].alias("opens"),
    )


@query("""
    select event_id, strftime(date_trunc('second', ts) + interval '8 hours', '%Y-%m-%d %H:%M:%S') as minute_time, strftime(ts + interval '8 hours', '%Y-%m-%d') as daily_time,
           strftime(ts, '%Y-%m-%d') as trade_date from events""")
def time_ms_format(spark, sf_dir):
    ms = sc.wall_millis(F.col("ts"))
    return _read(spark, sf_dir, "events").select(
        "event_id", sc.time_from_millis(ms, sc.Period.M1).alias("minute_time"), sc.time_from_millis(ms, sc.Period.D1).alias("daily_time"), sc.trade_date_of(F.col("ts")).alias("trade_date")
    )


@query("""
    select event_id, case event_id % 5 when 0 then null when 1 then round(value, 6) when 2 then null when 3 then null else round(value, 6) end as parsed from events""")
def parse_opt_f64(spark, sf_dir):
    k, v = F.col("event_id") % 5, F.col("value").cast("string")
    text = F.when(k == 0, "").when(k == 1, F.concat(F.lit("  "), v, F.lit(" "))).when(k == 2, F.concat(v, F.lit("x"))).when(k == 3, "NaN").otherwise(v)
    return _read(spark, sf_dir, "events").select("event_id", F.round(sc.number_from_text(text), 6).alias("parsed"))


_TICKS_SQL = """select event_id, concat(lpad(cast(user_id as string), 6, '0'), case when user_id % 2 = 0 then '.SZ' else '.SH' end) as symbol, ts, value from events"""


@query(f"""
    select event_id, symbol, split_part(symbol, '.', 2) as exchange, cast(epoch_us(ts) // 1000 as varchar) as time, round(value, 6) as last_price, case when event_id % 3 = 0 then null else round(value * 2, 6) end as open_interest
    from ({_TICKS_SQL}) where event_id % 7 <> 0""")
def tick_json_normalize(spark, sf_dir):
    from tapeline.streaming.quotes import normalize_ticks

    u, e = F.col("user_id"), F.col("event_id")
    symbol = F.concat(F.lpad(u.cast("string"), 6, "0"), F.when(u % 2 == 0, ".SZ").otherwise(".SH"))
    body = F.to_json(
        F.struct(
            sc.wall_millis(F.col("ts")).alias("timestamp"), F.round("value", 6).cast("string").alias("lastPrice"), F.when(e % 3 != 0, F.round(F.col("value") * 2, 6)).alias("openInterest")
        )
    )
    nested = F.when(e % 2 == 0, F.concat(F.lit('{"tick":'), body, F.lit("}"))).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    key = F.when(e % 7 == 0, "nothing").otherwise(symbol)
    payload = F.concat(F.lit('{"data":{"'), key, F.lit('":'), nested, F.lit("}}"))
    rows = _read(spark, sf_dir, "events").select("event_id", payload.alias("payload"))
    return rounded(normalize_ticks(rows, keep=["event_id"]).select("event_id", "symbol", "exchange", "time", "last_price", "open_interest"))


@query(f"""
    select event_id, concat('stock.tick.', replace(symbol, '.', '.')) as subject,
           concat('{{"code":"', symbol, '","tick":{{"time_ms":', cast(epoch_us(ts) // 1000 as varchar), ',"ask_price":[1.0,2.0],"volume":', cast(event_id as varchar), '}}}}') as payload
    from ({_TICKS_SQL}) where event_id % 5 <> 0""")
def tick_publish_payload(spark, sf_dir):
    u = F.col("user_id")
    symbol = F.concat(F.when(u % 2 == 0, "sz.").otherwise("sh."), F.lpad(u.cast("string"), 6, "0"))
    tick = F.struct(sc.wall_millis(F.col("ts")).alias("time_ms"), F.array(F.lit(1.0), F.lit(2.0)).alias("ask_price"), F.col("event_id").alias("volume"))
    rows = _read(spark, sf_dir, "events").select("event_id", symbol.alias("symbol"), F.when(F.col("event_id") % 5 != 0, tick).alias("tick"))
    return publish_rows(rows, keep=["event_id"])


def _indicator(name: str, specs: list[ind.Spec], sql: str) -> None:
    def run(spark, sf_dir):
        cols = ind.output_columns(specs)
        return rounded(ind.compute(daily_bars(spark, sf_dir), specs).select("symbol", "time", *cols))

    run.__name__ = name
    query(sql, name)(run)


def _mean(x: str, p: int) -> str:
    return f"round({ds.mean(x, p)}, 6)"


def _over(expr: str) -> str:
    return f"with {ds.BARS} select symbol, time, {expr} from b"


_indicator("ma", [ind.Ma((5, 10, 20, 25, 30))], _over(", ".join(f"{_mean('close', p)} as ma_{p}" for p in (5, 10, 20, 25, 30))))
_indicator("volume_ma", [ind.VolumeMa((60, 5, 10, 5))], _over(", ".join(f"{_mean('volume', p)} as volume_ma_{p}" for p in (5, 10, 60))))
_band = lambda sign: f"round(case when rn >= 20 then {ds.run('avg', 'close', 19)} {sign} 2 * {ds.run('stddev_pop', 'close', 19)} end, 6)"
_indicator("boll", [ind.Boll()], _over(f"{_mean('close', 20)} as boll_mid_20, {_band('+')} as boll_upper_20_2, {_band('-')} as boll_lower_20_2"))
_line = " + ".join(ds.run("avg", "close", p - 1) for p in (14, 28, 57, 114))
_indicator("bull_bear_line", [ind.BullBear()], _over(f"round(case when rn >= 114 then ({_line}) / 4 end, 6) as bull_bear_line_14_28_57_114"))


def _folded(cols: str) -> str:
    return f"{ds.INDICATORS} select symbol, time, {cols} from ind"


_indicator("macd", [ind.Macd()], _folded("round(dif, 6) + 0.0 as macd_dif_12_26, round(dea, 6) + 0.0 as macd_dea_12_26_9, round(hist, 6) + 0.0 as macd_hist_12_26_9"))
_indicator("kdj", [ind.Kdj()], _folded("round(k, 6) as k_9_3_3, round(d, 6) as d_9_3_3, round(j, 6) + 0.0 as j_9_3_3"))
_indicator("rsi", [ind.Rsi((14,))], _folded("round(rsi, 6) as rsi_14"))
_indicator("short_trend", [ind.ShortTrend()], _folded("round(short_trend, 6) as short_trend_10_10"))


@query(f"{ds.FOLDED} select s.symbol, s.time, round(f.e12, 6) as ema_12 from fold f join seeded s on s.symbol = f.symbol and s.rn = f.rn")
def ema(spark, sf_dir):
    def run(pdf):
        pdf = pdf.sort_values("time")
        return pdf[["symbol", "time"]].assign(ema_12=ind.ema(pdf["close"], 12))

    bars = daily_bars(spark, sf_dir).select("symbol", "time", "close")
    return rounded(bars.groupBy("symbol").applyInPandas(run, "symbol string, time date, ema_12 double"))


@query(f"with {ds.RAW} select symbol, time, round(rsv, 6) as rsv_9 from raw")
def rsv(spark, sf_dir):
    top, low = det.run(F.max, "high", 8), det.run(F.min, "low", 8)
    value = F.when(F.abs(top - low) <= ind.EPS, F.lit(50.0)).otherwise(F.try_divide(F.col("close") - low, top - low) * 100)
    return rounded(daily_bars(spark, sf_dir).select("symbol", "time", value.alias("rsv_9")))


@query(_over(f"case when lag(close) over ({ds.ORDER}) > 0 then round((close - lag(close) over ({ds.ORDER})) / lag(close) over ({ds.ORDER}), 6) + 0.0 end as pct_change"))
def pct_change(spark, sf_dir):
    prev = det.lag("close", 1)
    return rounded(daily_bars(spark, sf_dir).select("symbol", "time", F.when(prev > 0, (F.col("close") - prev) / prev).alias("pct_change")))


@query(f"""with {BARS} select symbol, time, round(abs(close - open) / open, 6) as body_ratio, close > open as bullish, close < open as bearish,
    round((high - greatest(open, close)) / high, 6) as upper_shadow from bars""")
def candle_shape(spark, sf_dir):
    o, h, c = F.col("open"), F.col("high"), F.col("close")
    return rounded(daily_bars(spark, sf_dir).select("symbol", "time", (F.abs(c - o) / o).alias("body_ratio"), (c > o).alias("bullish"), (c < o).alias("bearish"), ((h - F.greatest(o, c)) / h).alias("upper_shadow")))


def _ready(spark, sf_dir):
    return scan.prepared(daily_bars(spark, sf_dir))


@query(f"{ds.PREPARED} select symbol, time, ma_cross, kdj_cross, macd_cross from p where ma_cross or kdj_cross or macd_cross")
def cross_up_events(spark, sf_dir):
    flags = ["ma_cross", "kdj_cross", "macd_cross"]
    return _ready(spark, sf_dir).select("symbol", "time", *[F.coalesce(c, F.lit(False)).alias(c) for c in flags]).where("ma_cross or kdj_cross or macd_cross")


@query(f"with {ds.BARS}, f as (select symbol, time, {ds.fit_sql('close', 20)[0]} as slope, {ds.fit_sql('close', 20)[1]} as r2 from b) select symbol, time, round(slope, 6) + 0.0 as slope, round(r2, 6) as r2 from f where slope is not null")
def linreg_20(spark, sf_dir):
    bars = daily_bars(spark, sf_dir).withColumn("rn", F.row_number().over(det.by_symbol()))
    slope, r2 = det.fit("close", 20)
    return rounded(bars.select("symbol", "time", slope.alias("slope"), r2.alias("r2")).where("slope is not null"))


@query(f"""with {ds.BARS}, l as (select *, {", ".join(f"lag(low, {k}) over ({ds.ORDER}) as b{k}, lead(low, {k}) over ({ds.ORDER}) as f{k}" for k in (1, 2))} from b)
    select symbol, time, low from l where low <= b1 and low <= b2 and low <= f1 and low <= f2""")
def local_lows(spark, sf_dir):
    df = daily_bars(spark, sf_dir)
    near = {f"b{k}": det.lag("low", k) for k in (1, 2)} | {f"f{k}": F.lead("low", k).over(det.by_symbol()) for k in (1, 2)}
    return df.withColumns(near).where("low <= b1 and low <= b2 and low <= f1 and low <= f2").select("symbol", "time", "low")


@query(_over(f"{ds.run('max', 'high', 59)} as high_60, {ds.run('min', 'low', 59)} as low_60, round({ds.run('avg', 'volume', 5, 1)}, 6) as base_volume_5"))
def window_high_low(spark, sf_dir):
    cols = [det.run(F.max, "high", 59).alias("high_60"), det.run(F.min, "low", 59).alias("low_60"), det.run(F.avg, "volume", 5, 1).alias("base_volume_5")]
    return rounded(daily_bars(spark, sf_dir).select("symbol", "time", *cols))


@query(f"with {BARS} select symbol, max(high) as high, arg_max(time, (high, -epoch(cast(time as timestamp)))) as time from bars group by symbol")
def argmax_first(spark, sf_dir):
    days = F.datediff("time", F.lit("1970-01-01"))
    return daily_bars(spark, sf_dir).groupBy("symbol").agg(F.max("high").alias("high"), F.max_by("time", F.struct("high", -days)).alias("time"))


def _events_bars(spark, sf_dir):
    bars = intraday_bars(spark, sf_dir)
    return bars.withColumn("exchange", F.lit("EV"))


RELAXED: dict[str, det.Detector] = {
    "bottom_trend_inflection": det.BottomTrendInflection(decline=0.3, surge=0.03, volume_ratio=0.9, distance=0.6),
    "limit_up_sideways": det.LimitUpSideways(limit_up_threshold=0.05, volume_ratio_threshold=1.0, sideways_low_limit=-0.3, support_drop_limit=-0.3, sideways_high_limit=0.4, kdj_gold_cross_threshold=100.0, volume_increase_ratio=0.8, volume_shrinkage_ratio=1.1),
    "morning_star": det.MorningStar(confirm_change=0.01, volume_ratio=0.8, first_body_threshold=0.01),
    "multi_party_cannon": det.MultiPartyCannon(first_candle_rise=0.01, third_candle_rise=0.01, second_volume_shrink_ratio=1.1, third_volume_ma_ratio=0.9, third_volume_expand_ratio=0.8),
    "strong_wash_weak_to_strong": det.StrongWashWeakToStrong(surge=0.01, surge_volume=0.8, wash_volume=0.8),
    "immortal_guidance": det.ImmortalGuidance(surge_threshold=0.005, upper_shadow_ratio=0.001, volume_ratio_min=0.5, exclude_latest=True),
    "trend_resonance_reversal": det.TrendResonanceReversal(rsi_oversold=40.0, signal_days=5),
    "w_bottom": det.WBottom(bottom_diff_threshold=0.3, volume_expand_ratio=0.8, breakout_ratio=0.0, neck_ratio=1.01, rise_ratio=1.01, surge=0.02, support_ratio=0.9),
}


def _detector(key: str, d: det.Detector) -> None:
    def run(spark, sf_dir):
        return rounded(scan.evidence_frame(_ready(spark, sf_dir), d))

    run.__name__ = key
    query(ds.BUILDERS[d.id](d), key)(run)


for _d in det.REGISTRY.values():
    _detector(f"det_{_d.id}", _d)
for _k, _d in RELAXED.items():
    _detector(f"det_{_k}_relaxed", _d)

#: The flagship: every detector at every bar, and its SQL as a union of the detectors' own.
_ALL_SQL = " union all ".join(
    f"select symbol, exchange, time, '{d.id}' as pattern_id, cast(signal_date as date) as signal_date, cast({d.score} as double) as score, '{','.join(d.tags)}' as tags from ({ds.BUILDERS[d.id](d)})"
    for d in det.REGISTRY.values()
)


def _history(spark, sf_dir):
    return scan.signals(_ready(spark, sf_dir), latest_only=False)


@query(_ALL_SQL)
def scan_market_all(spark, sf_dir):
    return _history(spark, sf_dir).select("symbol", "exchange", "time", "pattern_id", "signal_date", "score", F.array_join("tags", ",").alias("tags"))


#: As of a date: what the last bar of each symbol up to it says, over the year before.
AS_OF = "1996-06-28"


def _as_of(spark, sf_dir):
    import datetime as dt

    start, end = scan.history_window(dt.date.fromisoformat(AS_OF))
    return fr.between_dates(daily_bars(spark, sf_dir), start, end)


_YEAR = f"select * from ({DAILY_SQL}) where time between date '{AS_OF}' - 365 and date '{AS_OF}'"


def _year_sql(sql: str) -> str:
    return sql.replace(DAILY_SQL, _YEAR)


_LATEST = {d.id: f"select * from ({_year_sql(ds.BUILDERS[d.id](d))}) where (symbol, time) in (select symbol, max(time) from ({_YEAR}) group by symbol)" for d in det.REGISTRY.values()}
_LATEST_SQL = " union all ".join(f"select symbol, '{k}' as pattern_id from ({v})" for k, v in _LATEST.items())


@query(f"select * from ({_LATEST_SQL})")
def scan_market_as_of(spark, sf_dir):
    return scan.latest_signals(_as_of(spark, sf_dir)).select("symbol", "pattern_id")


@query(f"""
    with found as ({_LATEST_SQL}), y as ({_YEAR}), sizes as (select symbol, count(*) as n from y group by symbol),
    per as (select w.symbol, coalesce(n, 0) as n, (select count(*) from found f where f.symbol = w.symbol) as hits from (select distinct symbol from ({_WANTED_SQL})) w left join sizes s on s.symbol = w.symbol)
    select count(*) as requested, count(*) as completed, count(*) filter (n > 0) as series_loaded, count(*) filter (n > 0 and n < 20) as skipped_short,
           cast(sum(hits) as bigint) as signals, count(*) filter (n = 0) as failed from per""")
def scan_counters(spark, sf_dir):
    bars = _as_of(spark, sf_dir)
    return scan.counters(_wanted(spark, sf_dir), bars, scan.latest_signals(bars))


_HITS_SQL = "select symbol, time, pattern_id from (select symbol, time, case when ma_cross then 'ma' end as a, case when kdj_cross then 'kdj' end as b, case when macd_cross then 'macd' end as c from p) unpivot (pattern_id for k in (a, b, c))"


def _hits(spark, sf_dir):
    kinds = F.explode(F.array_compact(F.array(*[F.when(F.col(f"{k}_cross"), F.lit(k)) for k in ("ma", "kdj", "macd")])))
    return _ready(spark, sf_dir).select("symbol", "time", kinds.alias("pattern_id"))


@query(f"{ds.PREPARED} select pattern_id, count(*) as hits from ({_HITS_SQL}) group by pattern_id")
def pattern_summary(spark, sf_dir):
    return scan.pattern_summary(_hits(spark, sf_dir))


@query(f"""{ds.PREPARED}, found as ({_HITS_SQL}), known as (select unnest(['kdj', 'ma', 'macd', 'never']) as pattern_id)
    select k.pattern_id, count(f.symbol) as hits, coalesce(string_agg(distinct f.symbol, ',' order by f.symbol), '') as symbols from known k left join found f using (pattern_id) group by k.pattern_id""")
def grouped_pattern_results(spark, sf_dir):
    return scan.by_pattern(_hits(spark, sf_dir), ["ma", "kdj", "macd", "never"]).select("pattern_id", "hits", F.array_join("symbols", ",").alias("symbols"))


@query(f"{ds.PREPARED} select symbol, time, pattern_id, (select count(*) from ({_HITS_SQL})) - 30 as omitted from ({_HITS_SQL}) order by time desc, symbol, pattern_id limit 30")
def topn_signals(spark, sf_dir):
    hits = _hits(spark, sf_dir)
    first = hits.orderBy(F.desc("time"), "symbol", "pattern_id").limit(30)
    return first.withColumn("omitted", hits.groupBy().agg((F.count("*") - 30).alias("n")).scalar())


@query("""
    select o_orderkey as job_id, o_orderdate as finished_at from orders where o_orderdate >= (select max(o_orderdate) from orders) - interval 24 hours
    order by o_orderdate desc, o_orderkey desc limit 200""")
def job_retention(spark, sf_dir):
    from tapeline.plans.jobs import retained

    jobs = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").alias("finished_at"))
    return retained(jobs)


@query(f"with {BARS} select symbol, year(time) as year, month(time) as month, day(time) as day, 0 as hour, 0 as minute, strftime(time, '%Y-%m-%d') as datetime, close from bars")
def raw_bar_parts(spark, sf_dir):
    bars = daily_bars(spark, sf_dir)
    parts = sc.datetime_parts(F.col("time").cast("timestamp"))
    return bars.select("symbol", parts.alias("p"), sc.trade_date_of(F.col("time")).alias("datetime"), "close").select("symbol", "p.*", "datetime", "close")


@query(f"select symbol, cast(floor((row_number() over (order by symbol) - 1) / 7) as integer) as chunk from (select distinct symbol from ({_WANTED_SQL}))")
def chunk_symbols(spark, sf_dir):
    return chunk_numbers(_wanted(spark, sf_dir).distinct(), 7)


@query(f"select symbol, cast(floor((row_number() over (order by symbol) - 1) / ceil(count(*) over () / 10.0)) as integer) as worker from (select distinct symbol from ({_WANTED_SQL}))")
def worker_split(spark, sf_dir):
    return worker_numbers(_wanted(spark, sf_dir).distinct(), 10)


@query(f"with {ds.BARS}, m as (select *, {ds.mean('close', 5)} as ma_5, {ds.mean('close', 20)} as ma_20 from b), x as (select symbol, time, ma_5, ma_20, lag(ma_5) over ({ds.ORDER}) as p5, lag(ma_20) over ({ds.ORDER}) as p20 from m) select symbol, time, round(ma_5, 6) as ma_5, round(ma_20, 6) as ma_20 from x where ma_5 > ma_20 and p5 <= p20")
def ma_cross_signals(spark, sf_dir):
    df = ind.compute(daily_bars(spark, sf_dir), [ind.Ma((5, 20))])
    return rounded(df.withColumn("hit", det.cross("ma_5", "ma_20")).where("hit").select("symbol", "time", "ma_5", "ma_20"))


entry = partial(scan_market_all)


from tapeline.plans import evidence_queries, service_queries, store_queries  # noqa: E402, F401  they add their queries to the registry above
