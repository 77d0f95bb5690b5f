"""Checks in bulk, latest bars read from arrays, numbers in reasons, archives read entry by entry."""

import datetime as dt
import zipfile
from dataclasses import dataclass

from pyspark.sql import functions as F

from tapeline.config import Config
from tapeline.engine import Engine
from tapeline.operators import detectors as det
from tapeline.operators import evidence, scan
from tapeline.operators import frame as fr
from tapeline.sources import readers
from tapeline.sources.bars import daily_bars
from tapeline.sources.lake import Lake

SF = "/root/testdata/sf0.001"


def test_checks_are_those_of_single_ones(spark, tmp_path):
    bars = fr.between_dates(daily_bars(spark, SF), "1995-01-02", "1996-12-31").withColumn("time", F.col("time").cast("string"))
    lake = Lake(spark, str(tmp_path))
    lake.write("daily_bars", bars)
    engine = Engine(spark, Config(lake=str(tmp_path)))
    rows = [("000002.SZ", dt.date(1996, 6, 28), p, k) for k, p in enumerate(("limit_up_pullback", "multi_golden_cross", "trend_start"))]
    rows += [(" 000003.sh", dt.date(1996, 6, 29), "limit_up_pullback", 7), ("000002.SZ", dt.date(1996, 6, 28), "limit_up_pullback", 8), ("999999.SZ", dt.date(1996, 6, 28), "trend_start", 9), (None, dt.date(1996, 6, 28), "trend_start", 10)]
    asked = spark.createDataFrame(rows, "symbol string, as_of date, pattern_id string, n int")
    got = {r.n: r.matched for r in engine.check_many(asked).collect()}
    assert len(got) == len(rows) and not got[9] and not got[10] and got[0] == got[8]
    hits = {(r.symbol, r.pattern_id) for r in engine.signals(dt.date(1996, 6, 28), ["limit_up_pullback", "multi_golden_cross", "trend_start"]).collect()}
    assert [got[k] for k in range(3)] == [("000002.SZ", rows[k][2]) in hits for k in range(3)]
    assert got[7] == engine.check("000003.SH", dt.date(1996, 6, 29), "limit_up_pullback")
    assert engine.check_many(asked.where("false")).count() == 0


@dataclass(frozen=True)
class Spread:
    """Uses an aggregation that arrays of bars do not know."""

    id, score, tags, explanation = "spread", 0.5, ("own",), "The close varies."

    def found(self):
        return F.when(det.B.run(F.stddev, "close", 4) > 0, F.struct(F.col("time").alias("signal_date"), det.B.back("close", 2).alias("before")))


def test_latest_bars_from_arrays(spark):
    """Every detector, and one of a user with a function of its own, as over windows at every bar."""
    bars = fr.between_dates(daily_bars(spark, SF), dt.date(1995, 1, 1), dt.date(1996, 3, 29))
    chosen = [*det.REGISTRY.values()]
    every = {tuple(map(str, r)) for r in scan.signals(scan.prepared(bars), chosen).collect()}
    assert {tuple(map(str, r)) for r in scan.latest_signals(bars, chosen).collect()} == every
    own = scan.latest_signals(bars, [Spread()]).collect()
    assert len(own) == bars.select("symbol").distinct().count()
    few = bars.where("symbol = '000001.SH'").limit(20)
    assert scan.latest_signals(few, chosen).count() == 0


def test_numbers_in_reasons(spark):
    df = spark.createDataFrame([(2.675, 0.125, 1234567.891, 3, None)], "a double, b double, c double, n int, x double")
    got = df.select(
        evidence.reason("%.2f, %.2f, %.1f%%, %d", [F.col("a"), F.col("b"), F.col("c"), F.col("n")]), evidence.reason("100%% sure", []), evidence.reason("%.2f", [F.col("x")])
    ).first()
    assert tuple(got)[:2] == ("2.67, 0.12, 1234567.9%, 3", "100% sure")  # the binary value's rounding, ties to even


def test_archives_of_many_entries(spark, tmp_path):
    head = ",".join(readers.INDEX_CSV)
    for a in range(2):
        with zipfile.ZipFile(tmp_path / f"a {a}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for e in range(6):
                z.writestr(f"sub/{e}.CSV" if e % 2 else f"{e}.csv", "\n".join([head, *(f"00000{a}.SH,2026-05-{e + 1:02},1,2,0.5,{k}.5,100,7,x,1.4" for k in range(40))]))
            z.writestr("note.txt", "nothing")
            z.writestr("empty.csv", head + "\n")
    rows = readers.read_zip(spark, str(tmp_path), "index-daily")
    assert rows.rdd.getNumPartitions() >= 6
    got = rows.collect()
    assert len(got) == 480 and len({r.source_file for r in got}) == 12
    assert sorted(r.source_row for r in got if r.source_file.endswith("a%200.zip/0.csv") or r.source_file.endswith("a 0.zip/0.csv")) == list(range(40))
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.import_files("index-daily", str(tmp_path))["files"] == 2
    assert {r.close for r in lake.read("index_daily_bars").collect()} == {39.5}  # the last row of each entry stays
