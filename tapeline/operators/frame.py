"""The K-line frame: schema, casts, union, deduplication, partition keys, set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tapeline.functions.scalars import datetime_parts, parse_datetime

STRINGS = ["symbol", "exchange", "period", "source"]
NUMBERS = ["open", "high", "low", "close", "volume", "amount", "turnover_rate", "factor"]

KLINE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("symbol", "exchange", "period")]
    + [T.StructField("time", T.StringType()), T.StructField("trade_date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "volume", "amount", "turnover_rate", "factor")]
    + [T.StructField("source", T.StringType())]
)


def empty_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], KLINE)


def cast_frame(df: DataFrame) -> DataFrame:
    """Cast the known columns that are there; the others and the order stay."""
    kinds = dict.fromkeys(STRINGS, "string") | dict.fromkeys(NUMBERS, "double")
    return df.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def fill_frame(df: DataFrame) -> DataFrame:
    """What a row without numbers means: prices, volume and amount 0, factor 1."""
    zero = [c for c in ("open", "high", "low", "close", "volume", "amount") if c in df.columns]
    return df.na.fill(0.0, zero).na.fill(1.0, [c for c in ("factor",) if c in df.columns])


def union_frames(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    """UNION ALL after the casts; an empty typed frame without inputs."""
    if not frames:
        return empty_frame(spark)
    return reduce(lambda a, b: a.unionByName(b), [cast_frame(f) for f in frames])


def drop_null_keys(df: DataFrame, keys: tuple[str, ...] = ("symbol", "time")) -> DataFrame:
    return df.dropna(subset=list(keys))


def dedup(df: DataFrame, order: list[Column], keys: tuple[str, ...] = ("symbol", "time"), keep: str = "last") -> DataFrame:
    """One row for each key: the last (or first) by an explicit order, never an arbitrary one.

    Spark limits each group to its first row before the shuffle, so a key that very many rows
    share is not gathered in one task.
    """
    by = [c.desc() for c in order] if keep == "last" else [c.asc() for c in order]
    w = Window.partitionBy(*keys).orderBy(*by)
    return drop_null_keys(df, keys).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def month_keys(df: DataFrame) -> DataFrame:
    """exchange, year and month as the texts that name a partition; rows with too short a time go."""
    t = F.col("time").cast("string")
    return df.where(F.length(t) >= 7).withColumn("year", F.substring(t, 1, 4)).withColumn("month", F.substring(t, 6, 2))


def day_keys(df: DataFrame) -> DataFrame:
    return df.withColumn("trade_date", F.substring(F.col("time").cast("string"), 1, 10))


def _picked(df: DataFrame, kinds: dict[str, str], names: dict[str, str]) -> DataFrame:
    """Columns of the given types, by other names in the frame where names says so; null where it has none."""
    there = {c: names.get(c, c) for c in kinds}
    return df.select(*[(F.col(of).cast(kinds[c]) if of in df.columns else F.lit(None).cast(kinds[c])).alias(c) for c, of in there.items()])


PRICES = dict.fromkeys(("open", "high", "low", "close", "volume", "amount"), "double")


def daily_rows(frame: DataFrame) -> DataFrame:
    """Daily bars as they are handed on and stored: adj_factor for the factor, settle and open_interest where known."""
    kinds = {"symbol": "string", "exchange": "string", "time": "string"} | PRICES | {"adj_factor": "double", "settle": "double", "open_interest": "double", "source": "string"}
    return _picked(frame, kinds, {"adj_factor": "factor"})


def minute_rows(frame: DataFrame) -> DataFrame:
    """Minute bars with their trade date, turnover and factor."""
    kinds = {"symbol": "string", "exchange": "string", "trade_date": "string", "time": "string"} | PRICES | {"turn_over": "double", "turn_over_rate": "double", "factor": "double"}
    dated = frame.withColumn("trade_date", F.substring(F.col("time").cast("string"), 1, 10))
    return _picked(dated, kinds, {"turn_over": "amount", "turn_over_rate": "turnover_rate"})


def raw_rows(frame: DataFrame) -> DataFrame:
    """Bars with the parts of their time as numbers and the time as a text; rows without a valid time go."""
    t = parse_datetime(F.col("time").cast("string"))
    rows = _picked(frame, PRICES, {}).columns
    dated = frame.withColumn("_t", t).where(F.col("_t").isNotNull()).withColumn("_p", datetime_parts(F.col("_t")))
    return dated.select(*[F.col(c).cast("double").alias(c) if c in frame.columns else F.lit(None).cast("double").alias(c) for c in rows], "_p.*", F.date_format("_t", "yyyy-MM-dd HH:mm").alias("datetime"))


def symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").where(F.col("symbol").isNotNull()).distinct()


def missing(requested: DataFrame, found: DataFrame) -> DataFrame:
    """Requested symbols that have no bar."""
    return requested.select("symbol").distinct().join(symbols(found), "symbol", "left_anti")


def with_fallback(primary: DataFrame, secondary: DataFrame, enabled: bool = True) -> DataFrame:
    """Primary bars, and for symbols that have none there the secondary's, marked unadjusted."""
    primary = primary.withColumn("adjusted", F.lit(True))
    if not enabled:
        return primary
    rest = secondary.join(symbols(primary), "symbol", "left_anti").withColumn("adjusted", F.lit(False))
    return primary.unionByName(rest)


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames).distinct()


def between_dates(df: DataFrame, start, end, column: str = "time") -> DataFrame:
    """Inclusive; a plain comparison, so it reaches the Parquet scan."""
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def month_windows(ranges: DataFrame) -> DataFrame:
    """window_start and window_end: the calendar months of each start..end range, clipped to it."""
    bad = F.assert_true(F.col("start") <= F.col("end"), F.lit("start is after end"))
    months = F.explode(F.sequence(F.trunc("start", "MM"), F.col("end"), F.expr("interval 1 month"))).alias("month")
    return ranges.where(F.coalesce(bad.cast("string"), F.lit("")) == "").select("start", "end", months).select(
        F.greatest("start", "month").cast("date").alias("window_start"), F.least("end", F.last_day("month")).alias("window_end")
    )
