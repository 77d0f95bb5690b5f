"""Snapshots of the whole market as a streaming source.

A cycle is one snapshot of every symbol, taken by several tasks at once. Offsets are the numbers of
periods since the epoch: a batch takes the latest cycle that has begun, and cycles that passed
while another was late are skipped, not made up for. If a task fails, so does the batch, and a
restart from the checkpoint takes the whole cycle again.
"""

from __future__ import annotations

import base64
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

PERIOD, WORKERS = 10.0, 10
ROWS = "cycle long, symbol string, tick string"
SHAPE = pa.schema([("cycle", pa.int64()), ("symbol", pa.string()), ("tick", pa.string())])


@dataclass
class Part(InputPartition):
    """A worker's symbols in one cycle."""

    cycle: int
    symbols: list[str]

    def __post_init__(self):
        super().__init__(None)


class SnapshotReader(DataSourceStreamReader):
    """ask(symbols) gives each symbol's tick as JSON, or None for one without."""

    def __init__(self, ask: Callable[[list[str]], dict[str, str | None]], symbols: list[str], period: float, workers: int, clock: Callable[[], float]):
        self.ask, self.symbols, self.period, self.workers, self.clock = ask, symbols, period, workers, clock

    def _now(self) -> int:
        return int(self.clock() // self.period)

    def initialOffset(self) -> dict:  # noqa: N802
        """Just before the cycle that runs: the first snapshot is taken at once."""
        return {"cycle": self._now() - 1}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"cycle": self._now()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["cycle"] <= start["cycle"]:
            return []
        return [Part(end["cycle"], self.symbols[k :: self.workers]) for k in range(min(self.workers, len(self.symbols)))]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        got = self.ask(partition.symbols)
        rows = [(partition.cycle, s, got.get(s)) for s in partition.symbols]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SHAPE, strict=True)], schema=SHAPE)

    def commit(self, end: dict) -> None:
        """Nothing is held for cycles that are done."""


class Snapshots(DataSource):
    @classmethod
    def name(cls) -> str:
        return "market_snapshots"

    def schema(self) -> str:
        return ROWS

    def streamReader(self, schema) -> SnapshotReader:  # noqa: N802
        return SnapshotReader(*cloudpickle.loads(base64.b64decode(self.options["asked"])))


def snapshot_stream(spark: SparkSession, ask: Callable[[list[str]], dict[str, str | None]], symbols: list[str], period: float = PERIOD, workers: int = WORKERS, clock: Callable[[], float] = time.time) -> DataFrame:
    """A streaming frame of cycle, symbol and tick (JSON; null for a symbol without one)."""
    spark.dataSource.register(Snapshots)
    asked = base64.b64encode(cloudpickle.dumps((ask, list(dict.fromkeys(symbols)), period, workers, clock))).decode()
    return spark.readStream.format("market_snapshots").option("asked", asked).load()
