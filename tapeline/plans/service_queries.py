"""Queries that ask services for bars: failing symbols, a second source, syncs that lose nothing, files as they come."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import functions as F

from tapeline.config import Config, Sync
from tapeline.engine import Engine
from tapeline.operators import detectors as det
from tapeline.operators import frame as fr
from tapeline.operators import scan
from tapeline.plans import detector_sql as ds
from tapeline.plans.queries import query
from tapeline.plans.store_queries import LAST, START
from tapeline.sources import readers
from tapeline.sources.bars import DAILY_SQL, INTRADAY_SQL, daily_bars, intraday_bars
from tapeline.sources.lake import Lake
from tapeline.sources.request import Request
from tapeline.sources.scratch import scratch
from tapeline.sources.service import RemoteSource

FROM, TO = dt.date.fromisoformat(START), dt.date.fromisoformat(LAST)


@dataclass(frozen=True)
class Shelf:
    """A service over a folder of bars that fails for symbols with some last digits and has no bars for others."""

    folder: str
    failing: tuple[int, ...] = ()
    without: tuple[int, ...] = ()

    def __call__(self, request: Request) -> dict:
        import pyarrow.dataset as pds

        digit = lambda s: int(s[5])
        if bad := [s for s in request.symbols if digit(s) in self.failing]:
            return {"status": 5, "message": f"no answer for {bad[0]}"}
        wanted = pds.field("symbol").isin([s for s in request.symbols if digit(s) not in self.without])
        rows = pds.dataset(self.folder).to_table(filter=wanted & (pds.field("day") >= request.start) & (pds.field("day") <= request.end))
        items: dict[str, list[dict]] = {}
        for r in rows.to_pylist():
            items.setdefault(r["symbol"], []).append(r)
        return {"status": 0, "items": [{"symbol": s, "bars": b} for s, b in items.items()]}


def _shelf(spark, sf_dir) -> tuple[str, tuple[str, ...]]:
    """A folder of bars as services have them, and the symbols."""
    folder = scratch(spark, "shelf")
    ms = F.unix_date("time").cast("long") * 86_400_000 - 8 * 3_600_000
    bars = daily_bars(spark, sf_dir)
    bars.select("symbol", F.col("time").alias("day"), ms.alias("time_ms"), "open", "high", "low", "close", "volume", F.lit(0.0).alias("amount")).write.parquet(folder)
    symbols = tuple(sorted(r["symbol"] for r in fr.symbols(bars).collect()))
    return folder.removeprefix("file:"), symbols


def _services(folder: str) -> tuple[Shelf, Shelf]:
    return Shelf(folder, failing=(3, 9), without=(5,)), Shelf(folder, failing=(9,))


_RANGE_SQL = f"select *, cast(substr(symbol, 6, 1) as int) as digit from ({DAILY_SQL}) where time between date '{START}' and date '{LAST}'"
_WHY = "concat('{0}: OSError: the source answered 5: no answer for ', symbol)"


@query(f"""
    select symbol, exchange, strftime(time, '%Y-%m-%d') as time, round(close, 6) as close, volume, case when digit in (3, 5) then 'secondary' else 'primary' end as source, digit not in (3, 5) as adjusted
    from ({_RANGE_SQL}) where digit <> 9""")
def service_bars(spark, sf_dir):
    """Executors ask in chunks of seven symbols and months; the second service only for what the first has not."""
    folder, symbols = _shelf(spark, sf_dir)
    got = RemoteSource(*_services(folder), size=7, tasks=4).answer(spark, Request(symbols, FROM, TO))
    return got.bars.select("symbol", "exchange", "time", F.round("close", 6).alias("close"), "volume", "source", "adjusted")


@query(f"select distinct symbol, concat({_WHY.format('primary')}, '; ', {_WHY.format('secondary')}) as reason from ({DAILY_SQL}) where substr(symbol, 6, 1) = '9'")
def service_failures(spark, sf_dir):
    folder, symbols = _shelf(spark, sf_dir)
    got = RemoteSource(*_services(folder), size=7, tasks=4).answer(spark, Request(symbols, FROM, FROM + dt.timedelta(days=20)))
    return got.failures


@query(f"select symbol, time_ms, round(close, 6) as close from (select symbol, (time - date '1970-01-01') * 86400000 - 28800000 as time_ms, close, time from ({DAILY_SQL})) where symbol in ('000002.SZ', '000007.SH') and time between date '1995-03-01' and date '1995-04-15'")
def service_by_format(spark, sf_dir):
    """spark.read.format with filters that the source uses: fewer symbols and days are asked for."""
    from tapeline.sources.service import BarService, packed

    folder, symbols = _shelf(spark, sf_dir)
    spark.dataSource.register(BarService)
    asked = packed([("primary", Shelf(folder, failing=(1, 3)))], Request(symbols, FROM, TO), 50, 4)
    ms = lambda y, m, d: (dt.date(y, m, d) - dt.date(1970, 1, 1)).days * 86_400_000 - 28_800_000
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("bar_service").options(asked=asked, pushdown="true").load()
    rows = rows.where(F.col("symbol").isin("000002.SZ", "000007.SH") & F.col("time_ms").between(ms(1995, 3, 1), ms(1995, 4, 15)))
    return rows.select("symbol", "time_ms", F.round("close", 6).alias("close"))


@query(f"""
    select symbol, strftime(time, '%Y-%m-%d') as time, round(close, 6) as close, digit < 4 as adjusted from ({_RANGE_SQL}) where digit <> 9
    union all select distinct symbol, 'failed', cast(null as double), cast(null as boolean) from ({DAILY_SQL}) where substr(symbol, 6, 1) = '9'""")
def fallback_missing_only(spark, sf_dir):
    """A table that has some symbols, and a service for the others that fails for some of these."""
    folder, symbols = _shelf(spark, sf_dir)
    table = scratch(spark, "primary")
    bars = daily_bars(spark, sf_dir).where(F.substring("symbol", 6, 1).cast("int") < 4)
    bars.select("symbol", "exchange", F.col("time").cast("string").alias("time"), "open", "high", "low", "close", "volume").write.parquet(table)
    # Were it asked for what the table has, it would fail for these too.
    source = readers.FallbackSource(readers.ParquetSource(table), RemoteSource(Shelf(folder, failing=(0, 1, 2, 3, 9)), size=3))
    got = source.answer(spark, Request(symbols, FROM, TO))
    failed = got.failures.select("symbol", F.lit("failed").alias("time"), F.lit(None).cast("double").alias("close"), F.lit(None).cast("boolean").alias("adjusted"))
    return got.bars.select("symbol", "time", F.round("close", 6).alias("close"), "adjusted").union(failed)


@query(f"""
    select symbol, strftime(time, '%Y-%m-%d') as time, round(close, 6) as close, date '{LAST}' as marked, (select count(distinct symbol) from ({_RANGE_SQL}) where digit in (3, 9)) as missed_first, 0 as missed_last
    from ({_RANGE_SQL})""")
def sync_after_failures(spark, sf_dir):
    """A sync whose service fails for some symbols, and the next one, which gets them: the lake has all."""
    folder, symbols = _shelf(spark, sf_dir)
    lake = scratch(spark, "lake")
    engine = Engine(spark, Config(lake=lake, daily=Sync(8, 4)), RemoteSource(Shelf(folder, failing=(3, 9))))
    engine.sync_daily(symbols, FROM, TO - dt.timedelta(days=30))
    missed = len(engine.lake.missed("daily_bars"))
    engine.source = RemoteSource(Shelf(folder))
    engine.sync_daily(symbols, end=TO, incremental=True)
    bars = engine.lake.read("daily_bars").select("symbol", "time", F.round("close", 6).alias("close"))
    return bars.withColumns({"marked": F.lit(engine.lake.watermark("daily_bars")), "missed_first": F.lit(missed).cast("long"), "missed_last": F.lit(len(engine.lake.missed("daily_bars"))).cast("int")})


def _csv(df, columns: list[str], folder: str) -> None:
    """CSV files of a layout, one for each month."""
    own = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit("1.5").alias(c) for c in columns]
    df.select(*own, F.substring("time", 1, 7).alias("month")).repartition("month").write.partitionBy("month").option("header", True).mode("append").csv(folder)


@query(f"""
    with b as (select symbol, strftime(time, '%Y-%m') as month, round(close, 6) as close from ({_RANGE_SQL}))
    select month, count(*) as rows, sum(close) as closes, 2 as files_of_drop from b group by month""")
def import_in_drops(spark, sf_dir):
    """Three drops of two months' files into one folder, each taken by a stream of its own from the same checkpoint."""
    folder, lake = scratch(spark, "drops"), Lake(spark, scratch(spark, "lake"))
    bars = fr.between_dates(daily_bars(spark, sf_dir), FROM, TO).withColumn("time", F.col("time").cast("string"))
    counts = []
    for months in (("1995-01", "1995-02"), ("1995-03", "1995-04"), ("1995-05", "1995-06")):
        _csv(bars.where(F.substring("time", 1, 7).isin(*months)), readers.DAILY_CSV, folder)
        counts.append(lake.import_stream("daily", folder)["files"])
    again = lake.import_stream("daily", folder)["files"]
    files = F.when(F.lit(again) != 0, F.lit(-1)).when(F.col("month") < "1995-03", counts[0]).when(F.col("month") < "1995-05", counts[1]).otherwise(counts[2])
    rows = lake.read("daily_bars").select(F.concat_ws("-", "year", "month").alias("month"), F.round("close", 6).alias("close"))
    rows = rows.groupBy("month").agg(F.count("*").alias("rows"), F.sum("close").alias("closes"))
    return rows.withColumn("files_of_drop", files.cast("int"))


@query(f"select symbol, exchange, strftime(time, '%Y-%m-%d') as time, round(close, 6) as close, 1.5::double as amount, 1.5::double as prev_close, strftime(time, '%Y') as year, strftime(time, '%m') as month from ({_RANGE_SQL})")
def import_index_daily(spark, sf_dir):
    folder, lake = scratch(spark, "index"), Lake(spark, scratch(spark, "lake"))
    _csv(fr.between_dates(daily_bars(spark, sf_dir), FROM, TO).withColumn("time", F.col("time").cast("string")), readers.INDEX_CSV, folder)
    lake.import_files("index-daily", folder)
    return lake.read("index_daily_bars").select("symbol", "exchange", "time", F.round("close", 6).alias("close"), "amount", "prev_close", "year", "month")


@query(f"""
    select concat(upper(symbol), '.SZ') as symbol, 'SZ' as exchange, strftime(time, '%Y-%m-%d') as trade_date, strftime(time, '%Y-%m-%d %H:%M:%S') as time, round(close, 6) as close, volume, 1.5::double as amount,
           true as small_files from ({INTRADAY_SQL})""")
def import_minutes(spark, sf_dir):
    """Minute bars by way of CSV files, in files of at most 50 rows."""
    folder, lake = scratch(spark, "minutes"), Lake(spark, scratch(spark, "lake"), part_rows=50)
    bars = intraday_bars(spark, sf_dir).withColumns({"symbol": F.concat(F.upper("symbol"), F.lit(".SZ")), "time": F.date_format("time", "yyyy-MM-dd HH:mm:ss")})
    _csv(bars, readers.MINUTE_CSV, folder)
    lake.import_files("minute", folder)
    found = lake.read("minute_bars_1m").withColumn("file", F.input_file_name())
    most = found.groupBy("file").count().agg(F.max("count")).first()[0]
    return found.select("symbol", "exchange", "trade_date", "time", F.round("close", 6).alias("close"), "volume", "amount", F.lit(most <= 50).alias("small_files"))


@dataclass(frozen=True)
class LastBars:
    """A snapshot service: each symbol's last bar as a tick, none for symbols that end in 4. The clock stands still,
    so one cycle is taken."""

    folder: str

    def __call__(self, symbols: list[str]) -> dict[str, str | None]:
        import json

        import pyarrow.dataset as pds

        rows = pds.dataset(self.folder).to_table(filter=pds.field("symbol").isin(symbols)).to_pylist()
        return {r["symbol"]: None if r["symbol"][5] == "4" else json.dumps({"time": str(r["time"]), "lastPrice": r["close"]}) for r in rows}

    def clock(self) -> float:
        return 1_000.0


@query(f"""
    select 'stock.tick.' || symbol as subject, symbol as code, max(strftime(time, '%Y-%m-%d')) as time, round(arg_max(close, time), 6) as last_price, 100 as cycle, 1 as published
    from ({DAILY_SQL}) where substr(symbol, 6, 1) <> '4' group by symbol""")
def snapshots_published(spark, sf_dir):
    """A cycle of ten workers' snapshots, published on a bus; a second start from the checkpoint has nothing to add."""
    from tapeline.streaming.bus import FolderBus, to_bus
    from tapeline.streaming.quotes import publish_rows
    from tapeline.streaming.snapshots import snapshot_stream

    folder, bus, checkpoint = scratch(spark, "last"), FolderBus(scratch(spark, "bus")), scratch(spark, "checkpoint")
    bars = daily_bars(spark, sf_dir).groupBy("symbol").agg(F.max("time").alias("time"), F.max_by("close", "time").alias("close"))
    bars.write.parquet(folder)
    symbols = sorted(r["symbol"] for r in fr.symbols(bars).collect())
    market = LastBars(folder.removeprefix("file:"))
    for _ in range(2):
        ticks = snapshot_stream(spark, market, symbols, 10.0, 10, market.clock).withColumn("tick", F.parse_json("tick"))
        stream = to_bus(publish_rows(ticks), bus, checkpoint).trigger(processingTime="100 milliseconds").start()
        try:
            stream.processAllAvailable()
        finally:
            stream.stop()
    sent = spark.createDataFrame(bus.messages(), "batch long, subject string, payload string")
    value = lambda path: F.get_json_object("payload", path)
    rows = sent.select("subject", value("$.code").alias("code"), value("$.tick.time").alias("time"), F.round(value("$.tick.lastPrice").cast("double"), 6).alias("last_price"))
    return rows.groupBy("subject", "code", "time", "last_price").agg(F.lit(100).alias("cycle"), F.count("*").cast("int").alias("published"))


_CHECKED = ("limit_up_pullback", "morning_star", "multi_party_cannon", "resistance_breakout", "strategy_2560_selection")
_DATES_SQL = f"select distinct symbol, cast(time as date) as as_of from ({DAILY_SQL}) where time >= date '1997-01-01' and (cast(substr(symbol, 5, 2) as int) + datediff('day', date '1997-01-01', time)) % 11 = 0"
_HITS_SQL = " union all ".join(f"select symbol, time, '{p}' as pattern_id from ({ds.BUILDERS[p](det.REGISTRY[p])})" for p in _CHECKED)


@query(f"""
    with d as ({_DATES_SQL}), p as (select unnest({list(_CHECKED)}) as pattern_id), h as ({_HITS_SQL})
    select d.symbol, d.as_of, p.pattern_id, h.symbol is not null as matched from d cross join p left join h on h.symbol = d.symbol and cast(h.time as date) = d.as_of and h.pattern_id = p.pattern_id""")
def check_in_bulk(spark, sf_dir):
    """Five patterns for every symbol on every eleventh day or so, each over the year before it, in one plan."""
    bars = daily_bars(spark, sf_dir)
    k = F.substring("symbol", 5, 2).cast("int") + F.datediff("time", F.lit("1997-01-01").cast("date"))
    dates = bars.where((F.col("time") >= F.lit("1997-01-01").cast("date")) & (k % 11 == 0)).select("symbol", F.col("time").alias("as_of")).distinct()
    asked = dates.select("*", F.explode(F.array(*map(F.lit, _CHECKED))).alias("pattern_id"))
    return scan.checks(asked, bars)
