"""Services as a Spark data source, syncs with failures, files as they come, snapshots and the bus."""

import datetime as dt
import json
import os
from dataclasses import dataclass

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapeline.config import Config, Sync
from tapeline.engine import Engine
from tapeline.sources import readers, service
from tapeline.sources.lake import Lake
from tapeline.sources.request import Request
from tapeline.streaming.bus import FolderBus, to_bus
from tapeline.streaming.quotes import QuoteLoop, publish_rows
from tapeline.streaming.snapshots import snapshot_stream

DAY = dt.date(2026, 5, 20)


def ms(day):
    return (day - dt.date(1970, 1, 1)).days * 86_400_000 - 28_800_000


@dataclass(frozen=True)
class Logged:
    """Answers every day of the range and notes what it was asked in files; fails for some symbols."""

    log: str
    bad: tuple = ()
    none: tuple = ()

    def __call__(self, request):
        path = f"{self.log}/{os.getpid()}-{len(os.listdir(self.log))}-{request.symbols[0]}-{request.start}"
        with open(path, "a") as f:
            f.write(json.dumps([*request.symbols]) + "\n")
        if set(request.symbols) & set(self.bad):
            raise OSError("gone")
        days = [request.start + dt.timedelta(days=k) for k in range((request.end - request.start).days + 1)]
        bars = [{"time_ms": ms(d), "close": 1.0, "open": None} for d in [*days, days[-1] + dt.timedelta(days=40)]]
        return {"items": [{"symbol": s, "bars": bars} for s in request.symbols if s not in self.none]}

    def asked(self):
        return sorted(json.loads(line) for p in os.listdir(self.log) for line in open(f"{self.log}/{p}"))


def logged(tmp_path, name, **more):
    (tmp_path / name).mkdir()
    return Logged(str(tmp_path / name), **more)


def test_reader_by_itself():
    """What Spark would pickle and run in executors, here in this process."""
    day = dt.date(2026, 1, 20)
    calls = []

    def ask(r):
        calls.append((r.symbols, r.start, r.end))
        if r.symbols == ("b",):
            return {"status": 3}
        if "b" in r.symbols:
            raise ValueError("whole")
        return {"items": [{"symbol": s, "bars": [{"time_ms": ms(r.start)}, {"time_ms": ms(r.end + dt.timedelta(days=1))}, {"time_ms": None}]} for s in r.symbols]}

    reader = service.FilteredBarReader([("x", ask)], Request(("a", "b", "c", "a"), day, dt.date(2026, 2, 3)), 3, 5)
    parts = reader.partitions()
    assert [len(p.requests) for p in parts] == [1, 1] and parts[0].requests[0].symbols == ("a", "b", "c")
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted((r["symbol"], r["failure"]) for r in rows) == [("a", None)] * 2 + [("b", "x: OSError: the source answered 3: no reason")] * 2 + [("c", None)] * 2
    assert {(a, b) for _, a, b in calls} == {(day, dt.date(2026, 1, 31)), (dt.date(2026, 2, 1), dt.date(2026, 2, 3))}
    from pyspark.sql.datasource import GreaterThanOrEqual, In, LessThan

    filters = [In(("symbol",), ("c", "z")), GreaterThanOrEqual(("time_ms",), ms(dt.date(2026, 2, 1))), LessThan(("time_ms",), ms(dt.date(2027, 2, 1)))]
    assert list(reader.pushFilters(filters)) == filters
    assert [(r.symbols, r.start, r.end) for p in reader.partitions() for r in p.requests] == [(("c",), dt.date(2026, 2, 1), dt.date(2026, 2, 3))]
    assert [p.requests for p in service.BarReader([], Request(("a",), day, day), 3, 5).partitions()] and service.months(day, day) == [(day, day)]


def test_second_service_is_asked_for_the_missing_alone(spark, tmp_path):
    first, second = logged(tmp_path, "one", bad=("000003.SZ",), none=("000002.SZ",)), logged(tmp_path, "two", bad=("000003.SZ",))
    symbols = tuple(f"{k:06}.SZ" for k in range(1, 6))
    got = service.RemoteSource(first, second, size=10, tasks=2).answer(spark, Request(symbols, DAY, DAY))
    assert sorted((r.symbol, r.source, r.adjusted, r.open) for r in got.bars.collect()) == [(s, "secondary" if s == "000002.SZ" else "primary", s != "000002.SZ", 0.0) for s in symbols if s != "000003.SZ"]
    assert [tuple(r) for r in got.failures.collect()] == [("000003.SZ", "primary: OSError: gone; secondary: OSError: gone")]
    assert {s for a in second.asked() for s in a} == {"000002.SZ", "000003.SZ"}
    n = len(first.asked())
    got.bars.count()
    assert len(first.asked()) == n  # an answer is read again, not asked again
    with pytest.raises(OSError, match="gone"):
        service.RemoteSource(logged(tmp_path, "three", bad=symbols)).fetch(spark, Request(symbols, DAY, DAY))
    by_name = spark.read.format("bar_service").options(client="tests.test_services:plain", symbols="000001.SZ, 000002.SZ", start="2026-05-20", end="2026-05-21").load()
    assert by_name.count() == 4


def plain(request):
    bars = [{"time_ms": ms(DAY), "close": 2.0}, {"time_ms": ms(DAY) + 86_400_000, "close": 2.0}]
    return {"items": [{"symbol": s, "bars": bars} for s in request.symbols]}


def bars(spark, rows):
    return spark.createDataFrame(rows, "symbol string, time string, close double").withColumn("exchange", F.lit("SZ"))


def test_fallback_of_any_sources(spark, tmp_path):
    bars(spark, [("000001.SZ", str(DAY), 1.0)]).write.parquet(str(tmp_path / "p"))
    second = logged(tmp_path, "two", bad=("000004.SZ",))
    asked = Request(("000001.SZ", "000002.SZ", "000004.SZ"), DAY, DAY)
    source = readers.FallbackSource(readers.ParquetSource(str(tmp_path / "p")), service.RemoteSource(second, size=1))
    got = source.answer(spark, asked)
    assert sorted((r.symbol, r.adjusted) for r in got.bars.collect()) == [("000001.SZ", True), ("000002.SZ", False)]
    assert [tuple(r) for r in got.failures.collect()] == [("000004.SZ", "secondary: primary: OSError: gone")] and ["000001.SZ"] not in second.asked()
    # A source that fails as a whole, here only when it is read, has no symbol's bars.
    gone = readers.FallbackSource(readers.ParquetSource(str(tmp_path / "nowhere")), readers.ParquetSource(str(tmp_path / "p"))).answer(spark, asked)
    assert [r.symbol for r in gone.bars.collect()] == ["000001.SZ"] and {r.symbol for r in gone.failures.collect()} == {"000002.SZ", "000004.SZ"}


class Lazy:
    """Gives a plan that fails only when it is read."""

    bounded = True

    def fetch(self, spark, request):
        df = bars(spark, [(s, str(request.start), 1.0) for s in request.symbols])
        return df.withColumn("close", F.when(F.col("symbol") == "000003.SZ", F.raise_error(F.lit("late")).cast("double")).otherwise(F.col("close")))


def test_plans_that_fail_late_lose_one_symbol(spark):
    got = readers.answer_of(Lazy(), spark, Request(tuple(f"{k:06}.SZ" for k in range(1, 6)), DAY, DAY), 3, 2)
    assert got.bars.count() == 4 and [r.symbol for r in got.failures.collect()] == ["000003.SZ"]


def test_missed_symbols_are_asked_for_again(spark, tmp_path):
    service_one = logged(tmp_path, "one", bad=("000002.SZ", "000003.SZ"))
    engine = Engine(spark, Config(lake=str(tmp_path / "lake"), daily=Sync(2, 2)), service.RemoteSource(service_one))
    symbols = [f"{k:06}.SZ" for k in range(1, 5)]
    out = engine.sync_daily(symbols, DAY, DAY)
    assert out["rows"] == 2 and [s for s, _ in out["failures"]] == ["000002.SZ", "000003.SZ"] and max(map(len, service_one.asked())) == 2
    assert engine.lake.missed("daily_bars") == [(s, DAY, DAY) for s in ("000002.SZ", "000003.SZ")]
    engine.source = service.RemoteSource(logged(tmp_path, "two", bad=("000003.SZ",)))
    later = DAY + dt.timedelta(days=2)
    out = engine.sync_daily(symbols, end=later, incremental=True)
    assert engine.lake.watermark("daily_bars") == later
    assert engine.lake.missed("daily_bars") == [("000003.SZ", DAY, DAY), ("000003.SZ", DAY + dt.timedelta(days=1), later)]
    engine.source = service.RemoteSource(logged(tmp_path, "three"))
    engine.sync_daily(symbols, end=later, incremental=True)  # nothing new, but what was missed
    assert engine.lake.missed("daily_bars") == [] and engine.lake.read("daily_bars").count() == 12


def test_files_are_imported_once(spark, tmp_path):
    folder, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()
    head = ",".join(readers.INDEX_CSV)
    line = lambda day: f"000001.SH,2026-05-{day:02},1,2,0.5,1.5,100,7,x,1.4"
    (folder / "a.csv").write_text(f"{head}\n{line(1)}\n")
    (folder / "note.txt").write_text("nothing")
    assert lake.import_stream("index-daily", str(folder)) == {"rows": 1, "partitions": 1, "files": 1}
    assert lake.import_stream("index-daily", str(folder))["files"] == 0
    (folder / "b.CSV").write_text(f"{head}\n{line(2)}\n{line(3)}\n")
    assert lake.import_stream("index-daily", str(folder))["files"] == 1
    assert sorted(r.time for r in lake.read("index_daily_bars").collect()) == ["2026-05-01", "2026-05-02", "2026-05-03"]


def test_a_failed_batch_of_files_comes_again(spark, tmp_path, monkeypatch):
    folder, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()
    (folder / "a.csv").write_text(",".join(readers.INDEX_CSV) + "\n000001.SH,2026-05-01,1,2,0.5,1.5,100,7,x,1.4\n")
    write = lake.write
    monkeypatch.setattr(lake, "write", lambda *a: (write(*a), 1 / 0))  # after the rows are in
    with pytest.raises(Exception):
        lake.import_stream("index-daily", str(folder))
    monkeypatch.undo()
    assert lake.import_stream("index-daily", str(folder))["files"] == 1 and lake.read("index_daily_bars").count() == 1


@dataclass(frozen=True)
class Market:
    """Ticks by symbol; the clock is a file, and one worker fails while a file is there."""

    folder: str

    def clock(self):
        return float(open(f"{self.folder}/clock").read())

    def __call__(self, symbols):
        with open(f"{self.folder}/asked", "a") as f:
            f.write(json.dumps(symbols) + "\n")
        if "000003.SZ" in symbols and os.path.exists(f"{self.folder}/broken"):
            raise OSError("line is down")
        return {s: None if s == "000007.SZ" else json.dumps({"time": 1, "lastPrice": float(s[:6])}) for s in symbols}


def test_snapshots_skip_late_cycles_and_repeat_whole_ones(spark, tmp_path):
    market, symbols = Market(str(tmp_path)), [f"{k:06}.SZ" for k in range(25)]
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run(now):
        (tmp_path / "clock").write_text(str(now))
        stream = snapshot_stream(spark, market, symbols, 10.0, 10, market.clock)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(processingTime="200 milliseconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return spark.read.parquet(out).groupBy("cycle").agg(F.count("*").alias("n"), F.count("tick").alias("ticks")).orderBy("cycle").collect()

    assert [tuple(r) for r in run(1000)] == [(100, 25, 24)]  # at once
    assert [tuple(r) for r in run(1042)] == [(100, 25, 24), (104, 25, 24)]  # 101 to 103 are skipped
    (tmp_path / "broken").write_text("")
    with pytest.raises(Exception, match="line is down"):
        run(1050)
    (tmp_path / "broken").unlink()
    (tmp_path / "asked").write_text("")
    assert [tuple(r) for r in run(1055)] == [(100, 25, 24), (104, 25, 24), (105, 25, 24)]
    assert sorted(s for line in open(tmp_path / "asked") for s in json.loads(line)) == symbols  # all ten workers again


@dataclass(frozen=True)
class Shaky(FolderBus):
    """A folder bus that breaks once after it has staged, and once after it has committed."""

    def _once(self, name):
        path = f"{self.folder}/{name}"
        if os.path.exists(path):
            os.remove(path)
            return True
        return False

    def stage(self, messages):
        token = super().stage(messages)
        if any("000004" in s for s, _ in messages) and self._once("break-stage"):
            raise ValueError("lost a worker")
        return token

    def commit(self, batch, tokens):
        super().commit(batch, tokens)
        if self._once("break-commit"):
            raise ValueError("lost the driver")


def test_a_batch_is_published_once(spark, tmp_path):
    shape = "symbol string, tick struct<last_price:double>"
    rows = spark.createDataFrame([(f"{k:06}.SZ", (float(k),)) for k in range(9)], shape).repartition(3)
    rows.write.parquet(str(tmp_path / "in"))
    (tmp_path / "bus").mkdir()
    bus = Shaky(str(tmp_path / "bus"))
    source = lambda: publish_rows(spark.readStream.schema(shape).parquet(str(tmp_path / "in")))
    for broken in ("break-stage", "break-commit", None):
        if broken:
            (tmp_path / "bus" / broken).write_text("")
        query = to_bus(source(), bus, str(tmp_path / "check")).trigger(availableNow=True).start()
        try:
            query.awaitTermination(60)
        except Exception:
            assert broken
        assert len(bus.messages()) == (0 if broken == "break-stage" and query.exception() else 9)
    assert sorted(s for _, s, _ in bus.messages()) == [f"stock.tick.{k:06}.SZ" for k in range(9)] and {b for b, _, _ in bus.messages()} == {0}
    loop = QuoteLoop(spark, bus)
    rows.limit(2).write.mode("append").parquet(str(tmp_path / "in"))
    loop.start(spark.readStream.schema(shape).parquet(str(tmp_path / "in")), str(tmp_path / "check"), every=None)
    loop.query.awaitTermination(60)
    assert len(bus.messages()) == 11 and not loop.status()["running"]


def test_row_groups(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    days = spark.range(300_000).select(F.concat(F.lpad((F.col("id") % 10_000).cast("string"), 6, "0"), F.lit(".SZ")).alias("symbol"), F.lit("SZ").alias("exchange"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") / 10_000).cast("int")).cast("string").alias("time"), F.col("id").cast("double").alias("close"))
    assert lake.write("daily_bars", days)["rows"] == 300_000
    groups = [m.row_group(k).num_rows for f in (tmp_path / "daily_bars").rglob("*.parquet") for m in [pq.ParquetFile(f).metadata] for k in range(m.num_row_groups)]
    assert sum(groups) == 300_000 and max(groups) <= 140_000
