"""Live quotes: tick payloads to rows, rows to messages, and the snapshot loop as a streaming query."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapeline.functions.scalars import exchange_of, split_symbol
from tapeline.streaming.bus import Bus, to_bus

# The fields of a tick and the names they come under.
TIME_NAMES = ["time", "timestamp", "datetime"]
NUMBERS = {
    "last_price": ["lastPrice"], "open": ["open"], "high": ["high"], "low": ["low"], "last_close": ["lastClose"], "amount": ["amount"], "volume": ["volume"],
    "pvolume": ["pvolume"], "open_interest": ["openInt", "openInterest"], "last_settlement_price": ["lastSettlementPrice"],
}
BOOK = {f"{a}_{b}_{k}": [f"{a}{b.capitalize()}{k}"] for b in ("price", "vol") for a in ("ask", "bid") for k in range(1, 6)}
SYMBOL = re.compile(r"[A-Za-z0-9_]+\.[A-Za-z0-9_]+")
WRAPPERS, TICK_WRAPPERS = ["data", "result", "items"], ["tick", "ticks", "data", "items", "result"]

def _entries(raw: Column) -> Column:
    """The members of a JSON object as structs of key and value; none for anything else."""
    return F.coalesce(F.map_entries(F.from_json(raw, "map<string,string>")), F.array().cast("array<struct<key:string,value:string>>"))


def _number(entries: Column, names: list[str]) -> Column:
    text = _pick(entries, names)
    return F.nullif(F.trim(text), F.lit("")).try_cast("double")


def _pick(entries: Column, names: list[str]) -> Column:
    """The value of the first of the names that is a member, whatever its value."""

    def named(name: str) -> Column:
        return F.filter(entries, lambda e: e["key"] == name)

    found = F.lit(None).cast("string")
    for n in reversed(names):
        found = F.when(F.size(named(n)) > 0, F.get(named(n), F.lit(0))["value"]).otherwise(found)
    return found


def _time(tick: dict):
    return next((tick[n] for n in TIME_NAMES if n in tick), None)


def _ticks(payload) -> list[dict]:
    """The ticks in what a symbol's member holds: a tick, a list of ticks, or a wrapper of one at any
    depth. Of an object's wrappers the first that holds a tick counts, then the object itself."""
    if isinstance(payload, list):
        return [x for x in payload if isinstance(x, dict) and _time(x) is not None]
    if not isinstance(payload, dict):
        return []
    for name in TICK_WRAPPERS:
        if name in payload and (inner := _ticks(payload[name])):
            return inner
    return [payload] if _time(payload) is not None else []


def ticks_of(text: str | None) -> list[tuple[str, str]]:
    """(symbol, tick as JSON) of a payload; none of what is no JSON, or nested deeper than it can be read."""
    try:
        todo, found = [json.loads(text)] if text else [], []
        while todo:
            x = todo.pop()
            if isinstance(x, list):
                todo += reversed(x)
            elif isinstance(x, dict):
                todo += [x[n] for n in WRAPPERS if n in x]
                found += [(k, json.dumps(t)) for k, v in x.items() if k not in WRAPPERS and SYMBOL.fullmatch(k) for t in _ticks(v)]
    except (ValueError, RecursionError):
        return []
    return found


def normalize_ticks(payloads: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows of ticks from JSON payloads (column payload): members named like symbols, at any depth of
    wrappers, hold a tick, a list of ticks or a wrapper of one. A tick without a time is none.

    Unwrapping to any depth is no relational step, so it is done by Arrow batches; the fields are read by Spark.
    """
    keep = keep or []
    shape = T.StructType([payloads.schema[c] for c in keep] + [T.StructField("symbol", T.StringType()), T.StructField("raw", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, symbol, raw) for k, text in enumerate(batch.column(len(keep))) for symbol, raw in ticks_of(text.as_py())]
            at = pa.array([r[0] for r in rows], pa.int32())
            own = [batch.column(k).take(at) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*own, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], [*keep, "symbol", "raw"])

    ticks = payloads.select(*keep, F.col("payload").cast("string").alias("payload")).mapInArrow(run, shape)
    e = F.col("e")
    fields = [_number(e, names).alias(c) for c, names in (NUMBERS | BOOK).items()]
    rows = ticks.select(*keep, "symbol", _entries(F.col("raw")).alias("e"))
    return rows.select(
        *keep, "symbol", exchange_of(F.col("symbol")).alias("exchange"), _pick(e, TIME_NAMES).alias("time"), *fields, _pick(e, ["stockStatus"]).alias("stock_status")
    ).where(F.col("time").isNotNull() & F.col("exchange").isNotNull())


def publish_rows(snapshots: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """subject and payload of each snapshot (symbol, tick): no tick, no message; a bad symbol fails the batch."""
    parts = split_symbol(F.col("symbol"))
    bad = F.raise_error(F.concat(F.lit("unsupported symbol format: "), F.coalesce("symbol", F.lit("null"))))
    code = F.when(parts.isNull(), bad.cast("string")).otherwise(F.concat(parts["code"], F.lit("."), parts["market"]))
    rows = snapshots.where(F.col("tick").isNotNull()).select(*(keep or []), code.alias("code"), "tick")
    return rows.select(*(keep or []), F.concat(F.lit("stock.tick."), F.col("code")).alias("subject"), F.to_json(F.struct("code", "tick")).alias("payload"))


class QuoteLoop:
    """One running query that publishes each micro-batch of snapshots; start, stop and status.

    publish is a Bus, to which tasks send their own messages and each batch goes once; or a function of
    a batch's rows, which must bear a batch that is published again. A bus that is not connected is
    tried again up to `attempts` times; then the query fails, and a start from the same checkpoint
    takes the batch up again.
    """

    def __init__(self, spark: SparkSession, publish: Callable[[DataFrame], None] | Bus, name: str = "whole_quote", reconnect: Callable[[], None] | None = None, attempts: int = 3, pause: float = 1.0):
        self.spark, self.publish, self.name = spark, publish, name
        self.reconnect, self.attempts, self.pause, self.reconnects = reconnect, attempts, pause, 0
        self.query: StreamingQuery | None = None

    @property
    def running(self) -> bool:
        return self.query is not None and self.query.isActive

    def _batch(self, df: DataFrame, _: int) -> None:
        for attempt in range(1, self.attempts + 1):
            try:
                return self.publish(df)
            except ConnectionError:
                if self.reconnect is None or attempt == self.attempts:
                    raise
                time.sleep(self.pause)
                self.reconnect()
                self.reconnects += 1

    def start(self, snapshots: DataFrame, checkpoint: str, every: str | None = "10 seconds") -> dict:
        """snapshots: a streaming frame of symbol and tick, such as snapshot_stream(). A batch that fails is not
        acknowledged and comes again after a restart from the checkpoint; a trigger that is late is skipped, not
        made up for. every=None takes what is there and stops, for schedulers."""
        if self.running:
            return self.status()
        rows = publish_rows(snapshots)
        if hasattr(self.publish, "stage"):
            writer = to_bus(rows, self.publish, checkpoint, self.attempts, self.pause)
        else:
            writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self._batch)
        writer = writer.queryName(self.name)
        writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
        self.query = writer.start()
        return self.status()

    def stop(self) -> dict:
        if self.query is not None:
            self.query.stop()
        return self.status()

    def status(self) -> dict:
        q = self.query
        error = None if q is None or q.exception() is None else str(q.exception())
        last = None if q is None or q.lastProgress is None else {"batch": q.lastProgress["batchId"], "rows": q.lastProgress["numInputRows"]}
        return {"running": self.running, "last": last, "error": error, "reconnects": self.reconnects}
