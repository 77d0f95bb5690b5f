"""Queries that go through sources and sinks: files read back, the lake merged, manifest and mark, evidence as JSON."""

from __future__ import annotations

import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F

from tapeline.config import Config
from tapeline.engine import Engine
from tapeline.functions import scalars as sc
from tapeline.operators import frame as fr
from tapeline.plans.queries import _SYMBOLS_SQL, _symbols, query
from tapeline.sources import readers
from tapeline.sources.bars import DAILY_SQL, INTRADAY_SQL, daily_bars, intraday_bars
from tapeline.sources.lake import Lake
from tapeline.sources.scratch import scratch

BARS = f"bars as ({DAILY_SQL})"
#: Two overlapping syncs: the second's bars of the days in both are dearer by one and stay.
FIRST, BOTH, LAST = "1995-03-31", "1995-02-15", "1995-06-30"
START = "1995-01-01"


def _dated(spark, sf_dir):
    return daily_bars(spark, sf_dir).select("symbol", "exchange", F.col("time").cast("string").alias("time"), "open", "high", "low", "close", "volume")


def _lake(spark, sf_dir) -> Lake:
    lake = Lake(spark, scratch(spark, "lake"))
    bars = _dated(spark, sf_dir)
    lake.write("daily_bars", fr.between_dates(bars, START, FIRST).withColumn("adjusted", F.lit(True)))
    lake.write("daily_bars", fr.between_dates(bars, BOTH, LAST).withColumn("close", F.col("close") + 1))
    return lake


_MERGED = f"""with {BARS} select symbol, exchange, strftime(time, '%Y-%m-%d') as time, close + case when time >= date '{BOTH}' then 1 else 0 end as close, volume,
    strftime(time, '%Y') as year, strftime(time, '%m') as month, case when time < date '{BOTH}' then 'true' end as adjusted
    from bars where time between date '{START}' and date '{LAST}'"""


@query(f"select symbol, exchange, time, round(close, 6) as close, volume, year, month, adjusted from ({_MERGED})")
def lake_merge(spark, sf_dir):
    return _lake(spark, sf_dir).read("daily_bars").select("symbol", "exchange", "time", F.round("close", 6).alias("close"), "volume", "year", "month", F.col("adjusted").cast("string").alias("adjusted"))


@query(f"select symbol, time, round(close, 6) as close from ({_MERGED}) where symbol = '000001.SH' and time between '1995-02-01' and '1995-04-30'")
def lake_range_of_symbol(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    bars = Engine(spark, Config(lake=lake.root)).daily_bars("000001.sh", dt.date(1995, 2, 1), dt.date(1995, 4, 30))
    return bars.select("symbol", "time", F.round("close", 6).alias("close"))


@query(f"select date '{LAST}' as marked, date '{LAST}' + 1 as next_start, (select count(distinct symbol) from ({DAILY_SQL}) where time between date '{START}' and date '{LAST}') as symbols")
def sync_watermark(spark, sf_dir):
    """A sync through the engine, month by month, then the mark it left."""
    source = scratch(spark, "source")
    _dated(spark, sf_dir).write.parquet(source)
    engine = Engine(spark, Config(lake=scratch(spark, "lake")), readers.ParquetSource(source))
    wanted = [r["symbol"] for r in fr.symbols(spark.read.parquet(source)).collect()]
    engine.sync_months(wanted, dt.date.fromisoformat(START), dt.date.fromisoformat(LAST))
    mark = engine.lake.watermark("daily_bars")
    found = engine.lake.read("daily_bars").agg(F.countDistinct("symbol").alias("symbols"))
    return found.select(F.lit(mark).alias("marked"), F.lit(engine.lake.next_start("daily_bars", mark)).alias("next_start"), "symbols")


_MINUTES_SQL = f"select concat(upper(symbol), '.SZ') as symbol, strftime(time, '%Y-%m-%d %H:%M:%S') as time, close, volume from ({INTRADAY_SQL})"


@query(f"""
    with m as ({_MINUTES_SQL}), d as (select symbol, min(substr(time, 1, 10)) as day from m group by symbol order by symbol limit 1)
    select m.symbol, m.time, round(m.close, 6) as close from m join d on m.symbol = d.symbol and substr(m.time, 1, 10) = d.day and substr(m.time, 12) between '09:30:00' and '15:00:00'""")
def lake_minutes_of_session(spark, sf_dir):
    """One symbol's session of one day out of a minute lake."""
    bars = intraday_bars(spark, sf_dir).select(F.concat(F.upper("symbol"), F.lit(".SZ")).alias("symbol"), F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "open", "high", "low", "close", "volume")
    lake = Lake(spark, scratch(spark, "lake"))
    lake.write("minute_bars_1m", bars)
    symbol, day = bars.groupBy("symbol").agg(F.min(F.substring("time", 1, 10))).orderBy("symbol").first()
    found = Engine(spark, Config(lake=lake.root)).minute_bars(symbol, dt.date.fromisoformat(day))
    return found.select("symbol", "time", F.round("close", 6).alias("close"))


def _texts(spark, sf_dir):
    """Bars as the columns of a daily CSV file, some numbers and symbols bad."""
    b = _dated(spark, sf_dir)
    b = fr.between_dates(b, "1995-01-01", "1995-12-31")
    bad = F.col("volume") % 5 == 0
    own = {"symbol": F.when(F.col("volume") % 7 == 0, F.substring("symbol", 1, 6)).otherwise(F.concat(F.lit(" "), "symbol")), "time": F.concat("time", F.lit(" 00:00:00")), "close": F.when(bad, "n/a").otherwise(F.col("close").cast("string"))}
    number = lambda c: F.col(c).cast("string") if c in b.columns else F.lit("1.5")
    return b.select(*[own.get(c, number(c)).alias(c) for c in readers.DAILY_CSV])


_CSV_SQL = f"""select symbol, split_part(symbol, '.', 2) as exchange, strftime(time, '%Y-%m-%d') as time, round(open, 6) as open, round(case when volume % 5 <> 0 then close end, 6) as close,
    cast(volume as double) as volume, 1.5::double as turnover from ({DAILY_SQL}) where time between date '1995-01-01' and date '1995-12-31' and volume % 7 <> 0"""


def _read_back(df):
    return df.select("symbol", "exchange", "time", F.round("open", 6).alias("open"), F.round("close", 6).alias("close"), "volume", "turnover")


@query(_CSV_SQL)
def csv_read(spark, sf_dir):
    folder = scratch(spark, "csv")
    _texts(spark, sf_dir).write.csv(folder, header=True)
    return _read_back(readers.read_csv(spark, folder, "daily"))


@query(_CSV_SQL)
def zip_read(spark, sf_dir):
    """The same from archives, one for each month, written by tasks as binary files would lie in a store."""
    folder = scratch(spark, "zip")
    head = ",".join(readers.DAILY_CSV)
    months = _texts(spark, sf_dir).groupBy(F.substring("time", 1, 7).alias("month")).agg(F.collect_list(F.concat_ws(",", *readers.DAILY_CSV)).alias("lines"))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for r in months.toLocalIterator():  # a year's months: twelve at most
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"{r['month']}.csv", "\n".join([head, *r["lines"]]))
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{r['month']}.zip")
        out = path.getFileSystem(conf).create(path)
        out.write(buffer.getvalue())
        out.close()
    return _read_back(readers.read_zip(spark, folder, "daily"))


@query(f"with {BARS}, m as (select distinct strftime(time, '%Y-%m') as month from bars) select count(*) as files, count(*) filter (month >= '1995-07') as new_files, 0 as new_after from m where month like '1995%'")
def manifest_new(spark, sf_dir):
    """Files of a folder that a manifest has not, before and after they are added."""
    folder, months = scratch(spark, "files"), F.date_format("time", "yyyy-MM")
    bars = daily_bars(spark, sf_dir).select("symbol", months.alias("month")).where("month like '1995%'").distinct()
    bars.repartition(1, "month").write.partitionBy("month").csv(folder)
    found = readers.files(spark, folder, "*.csv")
    manifest = readers.Manifest(spark, scratch(spark, "manifest"))
    manifest.add(found.where(F.regexp_extract("path", "month=([0-9-]+)", 1) < "1995-07"))
    new = manifest.new(found)
    n = new.count()
    manifest.add(spark.createDataFrame(new.collect(), new.schema))
    return found.agg(F.count("*").alias("files"), F.lit(n).cast("long").alias("new_files"), F.lit(manifest.new(found).count()).cast("int").alias("new_after"))


@query(f"""
    select distinct symbol from ({_SYMBOLS_SQL}) where position('.' in symbol) = 0 and substr(symbol, 1, 3) in ('600', '601', '603', '605', '688', '689', '000', '001', '002', '003', '300', '301')
        or symbol like '%.SH' and substr(symbol, 1, 3) in ('600', '601', '603', '605', '688', '689') or symbol like '%.SZ' and substr(symbol, 1, 3) in ('000', '001', '002', '003', '300', '301')""")
def universe_of_shares(spark, sf_dir):
    return readers.universe(_symbols(spark, sf_dir))


@query("""
    select o_orderkey, case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%Y-%m-%d') when o_orderkey % 3 = 1 then strftime(o_orderdate, '%Y-%m-%d') end as day,
           concat('src-', lpad(cast(o_orderkey % 1000 as varchar), 5, '0'), '-in_', o_orderstatus, '_', cast(o_orderkey as varchar)) as output from orders""")
def texts_to_dates_and_names(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    raw = F.when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd HH:mm")).when(k % 3 == 1, F.date_format(d, "yyyyMMdd")).otherwise(F.date_format(d, "dd/MM/yyyy"))
    path = F.concat(F.lit("in/"), "o_orderstatus", F.lit("."), k.cast("string"), F.lit(".csv"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", sc.date_from_text(raw).alias("day"), sc.output_id(path, k % 1000).alias("output"))


@query(f"""
    select symbol, exchange, strftime(time, '%Y-%m-%d') as time, round(open, 6) as open, round(close, 6) as close, volume, cast(null as double) as amount, 1.0::double as adj_factor,
           cast(null as double) as settle, 'derived' as source from ({DAILY_SQL})""")
def frame_to_daily_rows(spark, sf_dir):
    bars = daily_bars(spark, sf_dir).withColumns({"factor": F.lit(1.0), "source": F.lit("derived")})
    return fr.daily_rows(bars).select("symbol", "exchange", "time", F.round("open", 6).alias("open"), F.round("close", 6).alias("close"), "volume", "amount", "adj_factor", "settle", "source")


@query(f"""
    select round(close, 6) as close, cast(year(time) as int) as year, cast(month(time) as int) as month, cast(day(time) as int) as day, cast(hour(time) as int) as hour, cast(minute(time) as int) as minute,
           strftime(time, '%Y-%m-%d %H:%M') as datetime from ({INTRADAY_SQL})""")
def frame_to_raw_rows(spark, sf_dir):
    bars = intraday_bars(spark, sf_dir).withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    return fr.raw_rows(bars).select(F.round("close", 6).alias("close"), "year", "month", "day", "hour", "minute", "datetime")


@query(f"""
    select concat(symbol, '.SZ') as symbol, 'SZ' as exchange, strftime(time, '%Y-%m-%d') as trade_date, strftime(time, '%Y-%m-%d %H:%M:%S') as time, round(close, 6) as close, cast(null as double) as turn_over
    from ({INTRADAY_SQL})""")
def frame_to_minute_rows(spark, sf_dir):
    bars = intraday_bars(spark, sf_dir).select(F.concat("symbol", F.lit(".SZ")).alias("symbol"), F.lit("SZ").alias("exchange"), F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "close")
    return fr.minute_rows(bars).select("symbol", "exchange", "trade_date", "time", F.round("close", 6).alias("close"), "turn_over")


@query(f"""
    select symbol, exchange, strftime(time, '%Y-%m-%d') as time, round(open, 6) as open, round(close, 6) as close, volume, 0.0::double as amount, 1.0::double as factor
    from ({DAILY_SQL}) where time between date '{START}' and date '{LAST}'""")
def response_to_frame(spark, sf_dir):
    """Bars as a service nests them, a list for each symbol, exploded again."""
    bars = fr.between_dates(daily_bars(spark, sf_dir), dt.date.fromisoformat(START), dt.date.fromisoformat(LAST))
    ms = F.unix_date("time").cast("long") * 86_400_000 - 8 * 3_600_000  # the day's start where the exchange is
    one = F.struct(ms.alias("time_ms"), "open", "high", "low", "close", F.col("volume").cast("long").alias("volume"), F.lit(None).cast("double").alias("amount"))
    items = bars.groupBy("symbol").agg(F.collect_list(one).alias("bars"))
    found = readers.bars_from_response(items, sc.Period.D1)
    return found.select("symbol", "exchange", "time", F.round("open", 6).alias("open"), F.round("close", 6).alias("close"), "volume", "amount", "factor")
