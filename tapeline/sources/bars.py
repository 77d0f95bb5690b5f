"""Bars derived from the generic test tables, by statements that run in Spark SQL and DuckDB alike.

Prices are whole ticks held as doubles, so sums over them are exact in any order and comparisons
of means do not hang on rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DAILY_SQL = """
with days as (
    select l_suppkey % 50 as sid, cast(l_shipdate as date) as dt, cast(sum(l_orderkey * 31 + l_partkey * 17 + l_linenumber * 13) as bigint) as hsh
    from lineitem group by l_suppkey % 50, cast(l_shipdate as date)),
steps as (
    select sid, dt, hsh, cast(case when hsh % 53 = 0 then 320 when hsh % 53 = 1 then -280 else (hsh % 81) - 40 end as bigint) as step from days),
path as (
    select sid, dt, hsh, step, 2000 + abs(cast(sum(step) over (partition by sid order by dt rows between unbounded preceding and current row) as bigint)) as ct from steps),
opened as (
    select sid, dt, hsh, step, ct, coalesce(lag(ct) over (partition by sid order by dt), ct) + (hsh % 21) - 10 as ot from path)
select concat(lpad(cast(sid as string), 6, '0'), case when sid % 2 = 0 then '.SZ' else '.SH' end) as symbol,
       case when sid % 2 = 0 then 'SZ' else 'SH' end as exchange, dt as time,
       cast(ot as double) as open, cast(greatest(ot, ct) + (hsh % 11) as double) as high,
       cast(least(ot, ct) - (case when hsh % 3 = 0 then 0 else hsh % 7 end) as double) as low,
       cast(ct as double) as close, cast((1000 + hsh % 400) * (case when step = 320 then 4 else 1 end) as double) as volume
from opened"""

INTRADAY_SQL = """
with ticks as (
    select event_type as symbol, date_trunc('hour', ts) as time, ts, event_id, value,
           row_number() over (partition by event_type, date_trunc('hour', ts) order by ts, event_id) as first_n,
           row_number() over (partition by event_type, date_trunc('hour', ts) order by ts desc, event_id desc) as last_n
    from events)
select symbol, time, max(case when first_n = 1 then value end) as open, max(value) as high, min(value) as low,
       max(case when last_n = 1 then value end) as close, cast(count(*) as double) as volume
from ticks group by symbol, time"""


def _view(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, exchange, time (date), open, high, low, close, volume."""
    lines = _view(spark, sf_dir, "lineitem", ["l_suppkey", "l_shipdate", "l_orderkey", "l_partkey", "l_linenumber"])
    return spark.sql(DAILY_SQL.replace("from lineitem", "from {lineitem}"), lineitem=lines)


def intraday_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars by event type: symbol, time, open, high, low, close, volume."""
    events = _view(spark, sf_dir, "events", ["event_type", "ts", "event_id", "value"])
    return spark.sql(INTRADAY_SQL.replace("from events", "from {events}"), events=events)
