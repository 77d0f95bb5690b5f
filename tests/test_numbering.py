import random

from pyspark.sql import functions as F

from tapeline.operators.numbering import chunk_numbers, numbered, worker_numbers


def test_numbers_follow_the_order(spark):
    r = random.Random(3)
    rows = [(r.choice([None, *range(40)]), r.choice("ab"), k) for k in range(500)]
    df = spark.createDataFrame(rows, "x int, part string, at int").repartition(7)
    got = numbered(df, [F.desc_nulls_last("x"), "part", "at"], "n", 5).collect()
    assert sorted(g.n for g in got) == list(range(500))
    want = sorted(rows, key=lambda t: (t[0] is None, -(t[0] or 0), t[1], t[2]))
    assert [(g.x, g.part, g["at"]) for g in sorted(got, key=lambda g: g.n)] == want


def test_ties_and_empty_tables(spark):
    same = spark.createDataFrame([("s",)] * 30, "symbol string")
    assert sorted(r.number for r in numbered(same, ["symbol"]).collect()) == list(range(30))
    assert numbered(same.where("false"), ["symbol"]).count() == 0
    assert sorted(r.chunk for r in chunk_numbers(same, 7).collect()) == [k // 7 for k in range(30)]
    assert sorted(r.worker for r in worker_numbers(same, 4).collect()) == [k // 8 for k in range(30)]
    assert worker_numbers(same.where("false"), 4).count() == 0


def test_no_window_over_all_rows(spark):
    plan = numbered(spark.range(10).withColumnRenamed("id", "symbol"), ["symbol"])._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
