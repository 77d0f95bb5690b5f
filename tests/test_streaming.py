import pytest
from pyspark.sql import functions as F

from tapeline.streaming.quotes import QuoteLoop, normalize_ticks, publish_rows

TICK = "symbol string, tick struct<time_ms:bigint,last_price:double,ask_price:array<double>>"


def test_messages(spark):
    rows = spark.createDataFrame([("sz.000001", (1, 2.5, [1.0])), ("600000.sh", None)], TICK)
    got = [tuple(r) for r in publish_rows(rows).collect()]
    assert got == [("stock.tick.000001.SZ", '{"code":"000001.SZ","tick":{"time_ms":1,"last_price":2.5,"ask_price":[1.0]}}')]
    with pytest.raises(Exception, match="unsupported symbol format: nonsense"):
        publish_rows(spark.createDataFrame([("nonsense", (1, 2.5, [1.0]))], TICK)).collect()


def test_ticks(spark):
    payloads = [
        '{"data": {"000001.SZ": {"time": 5, "lastPrice": "10.1", "askPrice1": 3, "bidVol5": " ", "openInt": 7}}}',
        '[{"result": {"items": {"600000.SH": [{"datetime": "x", "lastPrice": null}, {"lastPrice": 1}, {"tick": {"time": 1}}]}}}]',
        '{"data": {"nothing": {"time": 1}}, "000002.SZ": {"ticks": [{"timestamp": "9"}]}}', "null", "", "broken{",
    ]
    got = {r.symbol: r for r in normalize_ticks(spark.createDataFrame([(p,) for p in payloads], "payload string")).collect()}
    assert sorted(got) == ["000001.SZ", "000002.SZ", "600000.SH"]
    a = got["000001.SZ"]
    assert (a.exchange, a.time, a.last_price, a.ask_price_1, a.bid_vol_5, a.open_interest) == ("SZ", "5", 10.1, 3.0, None, 7.0)
    assert got["600000.SH"].time == "x" and got["000002.SZ"].time == "9"


def test_loop(spark, tmp_path):
    rows = spark.createDataFrame([(f"{k:06}.SZ", (k, 1.0, [1.0])) for k in range(25)], TICK)
    rows.write.parquet(str(tmp_path / "in"))
    sent = []
    loop = QuoteLoop(spark, lambda df: sent.extend(r.subject for r in df.collect()))
    assert loop.status() == {"running": False, "last": None, "error": None, "reconnects": 0}
    source = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    loop.start(source(), str(tmp_path / "check"), every=None)
    loop.query.awaitTermination(60)
    assert len(sent) == 25 and not loop.stop()["running"]
    rows.select(F.concat(F.lit("x"), "symbol").alias("symbol"), "tick").write.mode("append").parquet(str(tmp_path / "in"))
    loop.start(source(), str(tmp_path / "check"), every=None)
    with pytest.raises(Exception):
        loop.query.awaitTermination(60)
    assert "unsupported symbol" in loop.status()["error"] and len(sent) == 25


def test_ticks_at_any_depth_and_behind_empty_wrappers(spark):
    deep = '{"data": ' * 12 + '{"000001.SZ": ' + '{"tick": ' * 9 + '{"time": 1, "open": "2"}' + "}" * 22
    behind = '{"000002.SZ": {"tick": {}, "data": [{"time": null}], "items": [{"time": 3}, {"time": 4}], "time": 9}, "000003.SZ": {"tick": {}, "time": 7, "stockStatus": 5}}'
    got = normalize_ticks(spark.createDataFrame([(deep, 1), (behind, 2), ("[" * 100_000, 3)], "payload string, n int"), ["n"]).collect()
    assert sorted((r.n, r.symbol, r.time, r.open, r.stock_status) for r in got) == [(1, "000001.SZ", "1", 2.0, None), (2, "000002.SZ", "3", None, None), (2, "000002.SZ", "4", None, None), (2, "000003.SZ", "7", None, "5")]


def test_reconnects(spark, tmp_path):
    rows = spark.createDataFrame([("000001.SZ", (1, 1.0, [1.0]))], TICK)
    rows.write.parquet(str(tmp_path / "in"))
    sent, up = [], []

    def publish(df):
        if not up:
            raise ConnectionError("bus is down")
        sent.extend(r.subject for r in df.collect())

    source = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    loop = QuoteLoop(spark, publish, reconnect=lambda: up.append(1), pause=0.01)
    loop.start(source(), str(tmp_path / "check"), every=None)
    loop.query.awaitTermination(60)
    assert sent == ["stock.tick.000001.SZ"] and loop.status()["reconnects"] == 1
