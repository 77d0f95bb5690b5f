"""Numbers of rows in a total order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.sources.scratch import scratch

#: monotonically_increasing_id: the partition is above, the row within it below these bits.
ROW_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "number", partitions: int | None = None) -> DataFrame:
    """df with the column name: 0, 1, 2, ... in the given order; rows that tie are told apart by their other columns' hash.

    Rows are dealt to range partitions and sorted there; each partition's count then shifts the
    numbers of those behind it. The rows are shuffled once, written to the shared folder so that
    partitions stay as they are, and only the counts of partitions are added up in one place.
    """
    spark = df.sparkSession
    tie = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    keys = [*(F.col(c) if isinstance(c, str) else c for c in order), tie]
    dealt = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    packed = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("own")
    path = scratch(spark, "numbered")
    dealt.sortWithinPartitions(*keys).select(packed, F.monotonically_increasing_id().alias("at")).write.parquet(path)
    rows = spark.read.parquet(path)
    part, place = F.shiftright("at", ROW_BITS), F.col("at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    counts = rows.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row for each partition
    before, starts = 0, []
    for r in counts:
        starts.append((r["part"], before))
        before += r["count"]
    shift = F.broadcast(spark.createDataFrame(starts, "part long, start long"))
    out = rows.withColumn("part", part).join(shift, "part")
    return out.select(*[F.col("own").getField(c).alias(c) for c in df.columns], (F.col("start") + place).alias(name))


def chunk_numbers(df: DataFrame, size: int, by: str = "symbol") -> DataFrame:
    """df with chunk: rows in the order of by, size to a chunk."""
    rows = numbered(df, [by], "chunk")
    return rows.withColumn("chunk", F.floor(F.col("chunk") / size).cast("int"))


def worker_numbers(df: DataFrame, count: int, by: str = "symbol") -> DataFrame:
    """df with worker: equal runs of ceil(n / count) rows in order; the last may be shorter."""
    rows = numbered(df, [by], "worker")
    each = max(1, -(-df.count() // count))
    return rows.withColumn("worker", F.floor(F.col("worker") / each).cast("int"))
