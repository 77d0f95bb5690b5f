import datetime as dt
import threading
import zipfile
from dataclasses import dataclass

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapeline.engine import Engine
from tapeline.config import Config, Sync
from tapeline.functions import scalars as sc
from tapeline.operators import detectors as det
from tapeline.operators import evidence
from tapeline.operators import frame as fr
from tapeline.operators import scan
from tapeline.operators.report import notify, report
from tapeline.plans.jobs import Jobs, NotFound
from tapeline.sources import readers
from tapeline.sources.bars import daily_bars
from tapeline.sources.lake import Lake

BAR = "symbol string, exchange string, time string, open double, high double, low double, close double, volume double"


def bar(spark, rows):
    return spark.createDataFrame([(s, s.split(".")[1], t, c, c + 1, c - 1, c, 1000.0) for s, t, c in rows], BAR)


def test_union_casts(spark):
    a = bar(spark, [("000001.SZ", "2026-05-20", 10.0)]).withColumn("volume", F.lit(100).cast("long"))
    out = fr.union_frames(spark, [a, bar(spark, [("000002.SZ", "2026-05-20", 11.0)])])
    assert sorted(r.volume for r in out.collect()) == [100.0, 1000.0]
    assert fr.union_frames(spark, []).schema == fr.KLINE


def test_dedup_keeps_by_order(spark):
    rows = spark.createDataFrame([("000001.SZ", "2026-05-20", 10.0, 1), ("000001.SZ", "2026-05-20", 11.0, 2), ("000002.SZ", "2026-05-20", 9.0, 3), (None, "x", 1.0, 4)], "symbol string, time string, open double, n int")
    last = {(r.symbol, r.open) for r in fr.dedup(rows, [F.col("n")]).collect()}
    first = {(r.symbol, r.open) for r in fr.dedup(rows, [F.col("n")], keep="first").collect()}
    assert last == {("000001.SZ", 11.0), ("000002.SZ", 9.0)} and ("000001.SZ", 10.0) in first


def test_lake_merges_instead_of_losing_days(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write("daily_bars", bar(spark, [("000001.SZ", "2026-05-20", 10.0), ("000001.SZ", "2026-06-01", 10.0), ("600000.SH", "2026-05-20", 5.0)]))
    out = lake.write("daily_bars", bar(spark, [("000001.SZ", "2026-05-21", 11.0), ("000001.SZ", "2026-05-20", 12.0)]))
    assert out == {"rows": 2, "partitions": 1}
    got = sorted((r.symbol, r.time, r.close) for r in lake.read("daily_bars").collect())
    assert got == [("000001.SZ", "2026-05-20", 12.0), ("000001.SZ", "2026-05-21", 11.0), ("000001.SZ", "2026-06-01", 10.0), ("600000.SH", "2026-05-20", 5.0)]
    assert (tmp_path / "daily_bars/exchange=SZ/year=2026/month=05").is_dir()


def test_minute_lake_dedups(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write("minute_bars_1m", bar(spark, [("000001.SZ", "2026-05-24 09:31:00", 1.0), ("000001.SZ", "2026-05-24 09:31:00", 1.0), ("600000.SH", "2026-05-24 14:59:00", 2.0)]))
    assert lake.read("minute_bars_1m").count() == 2
    assert (tmp_path / "minute_bars_1m/trade_date=2026-05-24/exchange=SH").is_dir()


def test_import_csv_and_zip_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = ",".join(readers.MINUTE_CSV)
    line = lambda s, t, c: f"{s},{t},1,2,0.5,{c},1.0,100,x,,0"
    (folder / "a.csv").write_text("\n".join([head, line("000001.SZ", "2026-05-24 09:31:00", 1.5), line("nodot", "2026-05-24 09:31:00", 1), line("000001.SZ", "2026-05-24", 1), line("000002.SZ", "2026-05-24 09:31:00", "nan")]))
    with zipfile.ZipFile(folder / "b.ZIP", "w") as z:
        z.writestr("x/one.CSV", "\n".join([head, line("600000.SH", "2026-05-24 09:32:00", 3.5), line("600000.SH", "2026-05-24 09:32:00", 4.5)]))
        z.writestr("readme.txt", "no")
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.import_files("minute", str(folder))["files"] == 2
    got = sorted((r.symbol, r.close, r.amount) for r in lake.read("minute_bars_1m").collect())
    assert got == [("000001.SZ", 1.5, None), ("000002.SZ", None, None), ("600000.SH", 4.5, None)]
    assert lake.import_files("minute", str(folder)) == {"rows": 0, "partitions": 0, "files": 0}


def test_watermark(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.next_start("daily_bars", dt.date(2026, 1, 5)) == dt.date(2026, 1, 5)
    lake.set_watermark("daily_bars", dt.date(2026, 1, 7))
    assert lake.next_start("daily_bars", dt.date(2026, 1, 5)) == dt.date(2026, 1, 8)


def test_symbol_file_and_universe(spark, tmp_path):
    (tmp_path / "s.txt").write_text(" 600000.SH \n# no\n\n000001.SZ\n830799.BJ\n600000.SH\n")
    found = readers.symbol_file(spark, str(tmp_path / "s.txt"))
    assert [r.symbol for r in found.collect()] == ["000001.SZ", "600000.SH", "830799.BJ"]
    assert [r.symbol for r in readers.universe(found).collect()] == ["000001.SZ", "600000.SH"]
    with pytest.raises(ValueError):
        readers.universe(found.where("symbol = '830799.BJ'"))


def test_response_rows(spark):
    rows = spark.createDataFrame([("000001.SZ", [(1779235200000, 1.0, 2.0, 0.5, 1.5, 100, None)])], "symbol string, bars array<struct<time_ms:bigint,open:double,high:double,low:double,close:double,volume:bigint,amount:double>>")
    r = readers.bars_from_response(rows, sc.Period.D1).first()
    assert (r.time, r.exchange, r.volume, r.amount, r.factor, r.turnover_rate) == ("2026-05-20", "SZ", 100.0, 0.0, 1.0, None)


def test_requests_are_checked():
    with pytest.raises(ValueError):
        readers.Request((), dt.date(2026, 1, 1), dt.date(2026, 1, 2))
    with pytest.raises(ValueError):
        readers.Request(("000001.SZ",), dt.date(2026, 1, 3), dt.date(2026, 1, 2))
    assert sc.Period.parse("1mo") is sc.Period.MON1 and sc.Adjust.parse("qfq") is sc.Adjust.FRONT
    assert sc.normalize_base_url(" x:1 ") == "http://x:1" and sc.normalize_base_url("https://x") == "https://x"


def test_engine_end_to_end(spark, tmp_path):
    src = str(tmp_path / "src")
    bars = daily_bars(spark, "/root/testdata/sf0.001").withColumn("time", F.col("time").cast("string"))
    bars.write.parquet(src)
    symbols = [r.symbol for r in fr.symbols(bars).collect()]
    sent = []
    engine = Engine(spark, Config(lake=str(tmp_path / "lake")), readers.FallbackSource(readers.ParquetSource(src), readers.NoSource()), lambda x: sent.append(x) or 200)
    day = dt.date(1996, 6, 28)
    out = engine.sync_daily(symbols, dt.date(1995, 6, 1), day)
    assert out["rows"] == fr.between_dates(bars, "1995-06-01", str(day)).count() > 0 and engine.lake.watermark("daily_bars") == day
    one = engine.daily_bars(symbols[0].lower(), dt.date(1996, 1, 1), day).collect()
    assert one and [r.time for r in one] == sorted(r.time for r in one)
    want = {(r.symbol, r.pattern_id) for r in scan.signals(scan.prepared(fr.between_dates(bars, str(day - dt.timedelta(days=365)), str(day)))).collect()}
    assert {(r.symbol, r.pattern_id) for r in engine.signals(day).collect()} == want
    for s, p in list(want)[:1]:
        assert engine.check(s, day, p)
    job = engine.scan_market(day, symbols=[*symbols, "999999.SZ"], wait=True)
    assert engine.job(job.id).status == "succeeded", job.error
    assert job.result["counters"]["failed"] == 1 and job.result["counters"]["signals"] == len(want)
    assert len(job.result["patterns"]) == 14 and sent[0]["title"] == f"Pattern scan {day}"
    with pytest.raises(ValueError, match="available"):
        engine.check(symbols[0], day, "nothing")
    assert engine.pattern_ids() == sorted(engine.pattern_ids()) and len(engine.pattern_ids()) == 14


def test_reports_and_webhook(spark):
    none = spark.createDataFrame([], "symbol string, pattern_id string, signal_date date, score double, explanation string")
    assert report("t", none, spark.createDataFrame([("a", "x  y")], "symbol string, error string"))[2:] == ["Pattern Summary:", "- None", "", "Signals:", "- None", "", "Failed Symbols:", "- a | x y"]
    many = spark.createDataFrame([(f"{k:03}", "p", dt.date(2026, 1, 1), 0.8, "e") for k in range(33)], none.schema)
    lines = report("t", many, none.selectExpr("symbol", "explanation as error"))
    assert "- ... and 3 more" in lines and "- 000 | p | 2026-01-01 | score 0.80 | e" in lines
    assert notify(lines, None) is False
    with pytest.raises(RuntimeError):
        notify(lines, lambda x: 500)


def test_jobs():
    jobs = Jobs(most=3)
    bad = jobs.submit("x", {}, lambda: 1 / 0, wait=True)
    assert bad.status == "failed" and "division" in bad.error
    ids = [jobs.submit("x", {}, lambda: 1, wait=True).id for _ in range(5)]
    jobs.clean()
    assert len(jobs.jobs) == 3 and jobs.get(ids[-1]).result == 1
    with pytest.raises(NotFound):
        jobs.get(bad.id)
    jobs.clean(now=bad.finished + 90_000)
    assert not jobs.jobs


def test_scalars(spark):
    df = spark.createDataFrame([("20260520", "2026-05-20 09:30", "SZ.000001", 3725), ("2026-13-01", "x", "abc", 65)], "d string, t string, s string, n int")
    got = df.select(
        sc.dashed_date(F.col("d")), sc.compact_datetime(F.col("t")), sc.split_symbol(F.col("s")), sc.format_seconds(F.col("n")), sc.output_id(F.col("t"), F.col("n")), sc.date_from_text(F.col("d")), sc.flatten_text(F.lit(" a \n b "))
    ).collect()
    assert tuple(got[0]) == ("2026-05-20", "20260520093000", ("000001", "SZ"), "01:02:05", "src-03725-2026-05-20_09_30", "2026-05-20", "a b")
    assert tuple(got[1]) == (None, None, None, "01:05", "src-00065-x", "2026-13-01", "a b")


def test_output_names(spark):
    paths = ["a/b c.tar.gz", "x.csv", "dir.d/.hidden", "plain", "é/ü.zip"]
    df = spark.createDataFrame([(p, k) for k, p in enumerate(paths)], "p string, k int")
    assert [r[0] for r in df.select(sc.output_id(F.col("p"), F.col("k"))).collect()] == ["src-00000-a_b_c_tar", "src-00001-x", "src-00002-dir_d__hidden", "src-00003-plain", "src-00004-___"]


def test_lake_keeps_a_declared_schema(spark, tmp_path):
    """Columns of later syncs are declared, old rows have nulls there, fallback bars stay marked."""
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.write("daily_bars", bar(spark, [("000001.SZ", "2026-05-20", 10.0)]))
    first, second = bar(spark, [("000002.SZ", "2026-05-20", 1.0)]), bar(spark, [("000002.SZ", "2026-05-20", 9.0), ("600000.SH", "2026-05-20", 2.0)])
    lake.write("daily_bars", fr.with_fallback(first, second))
    df = lake.read("daily_bars")
    assert sorted((r.symbol, r.close, r.adjusted, r.month) for r in df.collect()) == [("000001.SZ", 10.0, None, "05"), ("000002.SZ", 1.0, True, "05"), ("600000.SH", 2.0, False, "05")]
    assert sorted(df.schema, key=str) == sorted(lake.schema("daily_bars"), key=str) and spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    groups = [pq.ParquetFile(f).metadata for f in (tmp_path / "lake/daily_bars").rglob("*.parquet")]
    assert all(g.row_group(0).column(0).compression == "SNAPPY" for g in groups)


def test_repeated_writes_agree(spark, tmp_path):
    """Rows of one key without an order: whatever order they come in, the same one stays."""
    rows = [("000001.SZ", "2026-05-20", float(c)) for c in (3, 9, 5, 7)]
    kept = set()
    for k in range(3):
        lake = Lake(spark, str(tmp_path / f"lake{k}"))
        lake.write("daily_bars", bar(spark, rows[k:] + rows[:k]).repartition(k + 1, "close"))
        kept.add(lake.read("daily_bars").first().close)
    assert kept == {9.0}


class Flaky:
    """Answers few symbols at a time, and never for one of them."""

    bounded = True

    def __init__(self):
        self.asked = []

    def fetch(self, spark, request):
        self.asked.append((len(request.symbols), request.adjust))
        if "000003.SZ" in request.symbols:
            raise OSError("gone")
        return bar(spark, [(s, str(request.start), 1.0) for s in request.symbols])


def test_chunks_and_failures(spark, tmp_path):
    source, symbols = Flaky(), [f"{k:06}.SZ" for k in range(1, 8)]
    engine = Engine(spark, Config(lake=str(tmp_path), adjust="hfq", daily=Sync(4, 2)), source)
    out = engine.sync_daily(symbols, dt.date(2026, 5, 20), dt.date(2026, 5, 20))
    assert out["failures"] == [("000003.SZ", "OSError: gone")] and out["rows"] == 6 and max(n for n, _ in source.asked) == 4
    engine.signals(dt.date(2026, 5, 20), ["w_bottom"], ["000001.SZ"], refresh=True)
    assert source.asked[-1][1] is sc.Adjust.BACK


def test_settings_switch_the_fallback(spark):
    both = readers.FallbackSource(readers.NoSource(), readers.NoSource())
    assert Engine(spark, Config(fallback=False), both).source.enabled is False and Engine(spark, Config(), both).source.enabled is True


def test_adjusted_tables(spark, tmp_path):
    for name, close in (("plain", 1.0), ("front", 2.0)):
        bar(spark, [("000001.SZ", "2026-05-20", close)]).write.parquet(str(tmp_path / name))
    source = readers.ParquetSource(str(tmp_path / "plain"), {sc.Adjust.FRONT: str(tmp_path / "front")})
    ask = lambda adjust: source.fetch(spark, readers.Request(("000001.SZ",), dt.date(2026, 5, 1), dt.date(2026, 5, 31), adjust=adjust)).first().close
    assert (ask(sc.Adjust.NONE), ask(sc.Adjust.FRONT)) == (1.0, 2.0)
    with pytest.raises(ValueError):
        ask(sc.Adjust.BACK)


def test_pages_go_back_to_the_start(spark):
    def page(symbol, offset, count):
        if symbol == "000009.SZ":
            raise OSError("gone")
        days = [{"time": dt.datetime(2026, 1, 1, 9, 31) + dt.timedelta(days=k), "close": float(k)} for k in range(30)]
        end = len(days) - max(0, offset - 1)  # pages overlap by a bar
        return days[max(0, end - count) : end]

    source = readers.PagedSource(page, count=7, tasks=2)
    asked = readers.Request(("000001.SZ", "000009.SZ"), dt.date(2026, 1, 10), dt.date(2026, 1, 28), sc.Period.M1)
    got = source.fetch(spark, asked).orderBy("time").collect()
    assert [r.time for r in got] == [f"2026-01-{d:02} 09:31:00" for d in range(10, 29)] and {r.symbol for r in got} == {"000001.SZ"}
    assert [r.close for r in got] == [float(d - 1) for d in range(10, 29)] and got[0].exchange == "SZ" and got[0].factor == 1.0


def test_many_symbols_are_a_table(spark, monkeypatch):
    df = bar(spark, [(f"{k:06}.SZ", "2026-05-20", 1.0) for k in range(9)])
    monkeypatch.setattr(readers, "LISTED", 2)
    assert readers.only_symbols(df, ("000001.SZ", "000003.SZ", "000003.SZ", "000099.SZ")).count() == 2


def test_months_are_committed_in_turn(spark, tmp_path):
    days = ["2026-01-30", "2026-02-02", "2026-02-27", "2026-03-02"]
    bar(spark, [("000001.SZ", d, 1.0) for d in days]).write.parquet(str(tmp_path / "src"))
    engine = Engine(spark, Config(lake=str(tmp_path / "lake")), readers.ParquetSource(str(tmp_path / "src")))
    out = engine.sync_months(["000001.SZ"], dt.date(2026, 1, 15), dt.date(2026, 3, 10))
    assert [(x["until"], x["rows"]) for x in out] == [(dt.date(2026, 1, 31), 1), (dt.date(2026, 2, 28), 2), (dt.date(2026, 3, 10), 1)]
    assert engine.lake.watermark("daily_bars") == dt.date(2026, 3, 10) and engine.lake.read("daily_bars").count() == 4
    engine.source = readers.ParquetSource(str(tmp_path / "nowhere"))
    with pytest.raises(Exception, match="nowhere"):
        engine.sync_months(["000001.SZ"], dt.date(2026, 4, 1), dt.date(2026, 5, 10))


def test_scans_side_by_side_keep_their_own_patterns(spark):
    bars = fr.between_dates(daily_bars(spark, "/root/testdata/sf0.001"), dt.date(1995, 6, 1), dt.date(1996, 6, 28))
    ready = scan.prepared(bars).persist()
    sets = [["w_bottom", "limit_up_pullback"], ["trend_start"], ["multi_golden_cross", "morning_star"]]
    one = lambda ids: sorted((r.symbol, str(r.time), r.pattern_id) for r in scan.signals(ready, [det.lookup(p) for p in ids], latest_only=False).collect())
    want, got = [one(s) for s in sets], [None] * 3
    threads = [threading.Thread(target=lambda k=k: got.__setitem__(k, one(sets[k]))) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    ready.unpersist()
    assert got == want and any(want)


def test_latest_signals_are_those_of_the_whole_series(spark):
    bars = fr.between_dates(daily_bars(spark, "/root/testdata/sf0.001"), dt.date(1994, 1, 1), dt.date(1996, 6, 28))
    whole = {tuple(map(str, r)) for r in scan.signals(scan.prepared(bars)).collect()}
    assert {tuple(map(str, r)) for r in scan.latest_signals(bars).collect()} == whole and whole


@dataclass(frozen=True)
class Own:
    id, score, tags, explanation = "own", 0.5, ("mine",), "The close rises."

    def found(self):
        return F.when(F.col("close") > F.col("prev"), F.struct(F.col("time").alias("signal_date"), det.B.back("close", 3).alias("before")))


def test_a_detector_of_ones_own_and_progress(spark, tmp_path):
    bars = daily_bars(spark, "/root/testdata/sf0.001").withColumn("time", F.col("time").cast("string"))
    found = scan.latest_signals(fr.between_dates(bars, "1995-06-01", "1996-06-28"), [Own()])
    assert set(found.first().evidence and __import__("json").loads(found.first().evidence)) == {"signal_date", "before"}
    lake = Lake(spark, str(tmp_path))
    lake.write("daily_bars", fr.between_dates(bars, "1995-06-01", "1996-06-28"))
    told = []
    job = Engine(spark, Config(lake=str(tmp_path))).scan_market(dt.date(1996, 6, 28), ["trend_start"], wait=True, on_progress=told.append)
    assert job.status == "succeeded" and told[-1] == job.progress == job.result["counters"] and job.progress["failed"] == 0


def test_evidence_has_every_key(spark):
    """The keys that users of these patterns read, with kinds and reasons."""
    keys = {
        "limit_up_pullback": {"key_date", "key_date_type", "limit_up_date", "reasons", "support_price", "latest_volume_ratio"}, "morning_star": {"key_date", "third_candle_date", "reasons", "ma5"},
        "multi_golden_cross": {"key_date", "key_date_type", "reasons", "bull_bear_line"}, "multi_party_cannon": {"key_date", "reasons", "pattern_category"}, "trend_start": {"key_date", "pattern_type", "reasons"},
        "resistance_breakout": {"key_date", "key_date_type", "reasons", "support"}, "trend_resonance_reversal": {"key_date", "key_date_type", "rsi_breakout_day", "reasons"},
        "w_bottom": {"key_date", "key_date_type", "break_date", "trend_reversal", "reasons"}, "limit_up_sideways": {"key_date", "key_date_type", "limit_up_date", "reasons"},
        "immortal_guidance": {"key_date", "key_date_type", "signal_day", "key_day_open", "ma5", "ma10", "ma20", "confirmation_details", "reasons"},
    }
    ready, made = det.B.apply(scan.prepared(daily_bars(spark, "/root/testdata/sf0.001")), [det.lookup(k) for k in keys])
    df = ready.select(*[e.alias(k) for k, e in zip(keys, made, strict=True)])
    for k, want in keys.items():
        names = df.select(evidence.whole(k, F.col(k), df.schema[k].dataType.names).alias("e")).schema["e"].dataType.names
        assert want <= set(names) and len(names) == len(set(names)), k


def test_service_answers(spark):
    bars = [{"time_ms": 1779235200000, "open": 1, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 100.0}]
    asked = readers.Request(("000001.SZ",), dt.date(2026, 5, 20), dt.date(2026, 5, 20))
    r = readers.RemoteSource(lambda q: {"items": [{"symbol": q.symbols[0], "bars": bars}, {"symbol": "000002.SZ"}]}).fetch(spark, asked).collect()
    assert [(x.symbol, x.time, x.close, x.amount) for x in r] == [("000001.SZ", "2026-05-20", 1.5, 0.0)]
    with pytest.raises(OSError, match="7: busy"):
        readers.RemoteSource(lambda q: {"status": 7, "message": "busy"}).fetch(spark, asked)


def test_health(spark, tmp_path):
    assert Engine(spark, Config(lake=str(tmp_path / "lake"))).health()["ok"] and (tmp_path / "lake").is_dir()
    assert not Engine(spark, Config(lake="nosuch://x/lake")).health()["ok"]
