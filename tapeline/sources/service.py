"""Bars of services as a Spark data source: executors ask for chunks of symbols and months, and what
fails comes back as rows beside the bars.

A client is ask(request) -> {"status", "message", "items": [{"symbol", "bars": [{"time_ms", ...}]}]}; a
status other than 0, or an error, fails the request. A request of many symbols that fails is asked in
halves, down to a symbol. Clients are asked in order, each only for the symbols that those before it
had no bars of. A symbol without any bars that some client failed on is a row with failure set.
"""

from __future__ import annotations

import base64
import datetime as dt
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from importlib import import_module

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from tapeline.functions import scalars as sc
from tapeline.operators import frame as fr
from tapeline.sources.request import Request
from tapeline.sources.scratch import scratch

Ask = Callable[[Request], dict]

NUMBERS = ["open", "high", "low", "close", "volume", "amount"]
ROWS = "symbol string, time_ms long, " + ", ".join(f"{c} double" for c in NUMBERS) + ", source string, failure string"
SHAPE = pa.schema([("symbol", pa.string()), ("time_ms", pa.int64()), *((c, pa.float64()) for c in NUMBERS), ("source", pa.string()), ("failure", pa.string())])
#: The exchanges' clock is ahead of UTC by so many milliseconds; a day has so many.
AHEAD, DAY = 8 * 3_600_000, 86_400_000


def day_of(ms: int) -> dt.date:
    return dt.date(1970, 1, 1) + dt.timedelta(days=(ms + AHEAD) // DAY)


def months(start: dt.date, end: dt.date) -> list[tuple[dt.date, dt.date]]:
    """The calendar months of a range, clipped to it."""
    out = []
    while start <= end:
        last = min(end, (start.replace(day=1) + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1))
        out.append((start, last))
        start = last + dt.timedelta(days=1)
    return out


def ask_split(ask: Ask, request: Request) -> tuple[dict[str, list[dict]], dict[str, str]]:
    """Bars by symbol, and the symbols that failed alone, with why."""
    try:
        got = ask(request)
        if got.get("status", 0) != 0:
            raise OSError(f"the source answered {got['status']}: {got.get('message') or 'no reason'}")
        return {i["symbol"]: i.get("bars") or [] for i in got.get("items") or []}, {}
    except Exception as e:
        if len(request.symbols) == 1:
            return {}, {request.symbols[0]: f"{type(e).__name__}: {e}"}
        half = len(request.symbols) // 2
        (a, x), (b, y) = (ask_split(ask, replace(request, symbols=part)) for part in (request.symbols[:half], request.symbols[half:]))
        return a | b, x | y


def answered(clients: list[tuple[str, Ask]], request: Request) -> Iterator[tuple]:
    """Rows of ROWS for one request."""
    left, reasons = request.symbols, dict[str, list[str]]()
    for label, ask in clients:
        got, errors = ask_split(ask, replace(request, symbols=left))
        for s, why in errors.items():
            reasons.setdefault(s, []).append(f"{label}: {why}")
        found = set()
        for symbol, bars in got.items():
            for b in bars:
                if b.get("time_ms") is not None and request.start <= day_of(int(b["time_ms"])) <= request.end:
                    found.add(symbol)
                    yield (symbol, int(b["time_ms"]), *(None if b.get(c) is None else float(b[c]) for c in NUMBERS), label, None)
        left = tuple(s for s in left if s not in found)
        if not left:
            return
    for s in left:
        if s in reasons:
            yield (s, None, *(None,) * len(NUMBERS), None, "; ".join(reasons[s]))


@dataclass
class Asked(InputPartition):
    """The requests of one task."""

    requests: list[Request]

    def __post_init__(self):
        super().__init__(None)


class BarReader(DataSourceReader):
    def __init__(self, clients: list[tuple[str, Ask]], request: Request, size: int, tasks: int):
        self.clients, self.request, self.size, self.tasks = clients, request, max(1, size), max(1, tasks)

    def partitions(self) -> list[InputPartition]:
        """Each chunk of symbols and month is a request; tasks many requests are out at once."""
        r = self.request
        symbols = [s for s in dict.fromkeys(r.symbols) if s]
        all_of = [replace(r, symbols=tuple(symbols[k : k + self.size]), start=a, end=b) for k in range(0, len(symbols), self.size) for a, b in months(r.start, r.end)]
        return [Asked(all_of[k :: self.tasks]) for k in range(min(self.tasks, len(all_of)))] or [Asked([])]

    def read(self, partition: Asked) -> Iterator[pa.RecordBatch]:
        for request in partition.requests:
            rows = list(answered(self.clients, request))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SHAPE.types, strict=True)], schema=SHAPE)


class FilteredBarReader(BarReader):
    """The same with filters pushed down, for sessions where spark.sql.python.filterPushdown.enabled is true
    (Spark refuses such a reader elsewhere)."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Symbols and times narrow what is asked; Spark evaluates all of them again on the rows."""
        for f in filters:
            if f.__class__ in (EqualTo, In) and f.attribute == ("symbol",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.request = replace(self.request, symbols=tuple(s for s in self.request.symbols if s in wanted) or ("",))
            elif f.__class__ in (GreaterThan, GreaterThanOrEqual) and f.attribute == ("time_ms",):
                self.request = replace(self.request, start=min(max(self.request.start, day_of(f.value)), self.request.end))
            elif f.__class__ in (LessThan, LessThanOrEqual) and f.attribute == ("time_ms",):
                self.request = replace(self.request, end=max(min(self.request.end, day_of(f.value)), self.request.start))
            yield f


class BarService(DataSource):
    """spark.read.format("bar_service") with options: client, and fallback if there is one, as module:name;
    symbols (with commas), start, end, period (1d), adjust; size (symbols of a request), tasks (requests
    at once), pushdown (false). Or asked, which packed() makes of clients that cannot be imported by name."""

    @classmethod
    def name(cls) -> str:
        return "bar_service"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> BarReader:
        o = self.options
        kind = FilteredBarReader if o.get("pushdown", "false").lower() == "true" else BarReader
        if "asked" in o:
            return kind(*cloudpickle.loads(base64.b64decode(o["asked"])))
        clients = [(label, named(o[key])) for label, key in (("primary", "client"), ("secondary", "fallback")) if key in o]
        day = dt.date.fromisoformat
        request = Request(tuple(s.strip() for s in o["symbols"].split(",")), day(o["start"]), day(o["end"]), sc.Period.parse(o.get("period", "1d")), sc.Adjust.parse(o.get("adjust", "none")))
        return kind(clients, request, int(o.get("size", 200)), int(o.get("tasks", 8)))


def named(text: str) -> Ask:
    module, _, name = text.partition(":")
    return getattr(import_module(module), name)


def packed(clients: list[tuple[str, Ask]], request: Request, size: int, tasks: int) -> str:
    return base64.b64encode(cloudpickle.dumps((clients, request, size, tasks))).decode()


@dataclass(frozen=True)
class Answer:
    """What a source gave: bars, and failures (symbol, reason) of symbols that have none."""

    bars: DataFrame
    failures: DataFrame


def no_failures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "symbol string, reason string")


@dataclass(frozen=True)
class RemoteSource:
    """Bars of a service, and of a second one for symbols that the first has none of.

    The service is asked once by the executors, a chunk of symbols and a month at a time; the answer
    lies in the shared folder and is split into bars and failures. The driver holds neither.
    """

    ask: Ask
    fallback: Ask | None = None
    size: int = 200
    tasks: int = 8
    label: str = "primary"
    bounded = True

    def clients(self) -> list[tuple[str, Ask]]:
        return [(self.label, self.ask), *([("secondary", self.fallback)] if self.fallback else [])]

    def answer(self, spark: SparkSession, request: Request, size: int | None = None, tasks: int | None = None) -> Answer:
        spark.dataSource.register(BarService)
        rows = spark.read.format("bar_service").option("asked", packed(self.clients(), request, size or self.size, tasks or self.tasks)).load()
        path = scratch(spark, "answer")
        rows.write.parquet(path)
        rows = spark.read.schema(ROWS).parquet(path)
        bars = kline(rows.where("failure is null"), request.period)
        if self.fallback:
            bars = bars.withColumn("adjusted", F.col("source") != "secondary")
        return Answer(bars, rows.where("failure is not null").groupBy("symbol").agg(F.min("failure").alias("reason")))

    def fetch(self, spark: SparkSession, request: Request) -> DataFrame:
        """The bars; an error if no symbol was answered and some failed."""
        got = self.answer(spark, request)
        if got.bars.isEmpty() and (bad := got.failures.orderBy("symbol").first()):
            raise OSError(bad["reason"])
        return got.bars


def kline(rows: DataFrame, period: sc.Period) -> DataFrame:
    """K-line rows of symbol, time_ms, numbers and source."""
    time = sc.time_from_millis(F.col("time_ms"), period)
    return fr.fill_frame(
        rows.select(
            "symbol", sc.exchange_of(F.col("symbol")).alias("exchange"), F.lit(period.value).alias("period"), time.alias("time"), sc.trade_date_of(time).cast("date").alias("trade_date"),
            *[F.col(c).cast("double").alias(c) for c in NUMBERS], F.lit(None).cast("double").alias("turnover_rate"), F.lit(1.0).alias("factor"), "source",
        )
    )


@dataclass(frozen=True)
class Pages:
    """A client of a source that gives the latest bars first, a page at a time.

    page(symbol, offset, count) gives up to count bars, oldest first, that end `offset` bars before
    the latest; a bar is a dict with time (a datetime or date of the exchange's clock) and numbers. A
    symbol is paged back until a page reaches the start or is short; of one time the first bar
    stays. Minute bars lie on whole minutes.
    """

    page: Callable[[str, int, int], list[dict]]
    count: int = 800

    def __call__(self, request: Request) -> dict:
        return {"items": [{"symbol": s, "bars": self.bars_of(s, request)} for s in request.symbols]}

    def bars_of(self, symbol: str, request: Request) -> list[dict]:
        whole = lambda t: t.replace(second=0, microsecond=0) if isinstance(t, dt.datetime) else dt.datetime.combine(t, dt.time())
        found, offset = [], 0
        while got := self.page(symbol, offset, self.count):
            found += got
            offset += len(got)
            if len(got) < self.count or whole(got[0]["time"]).date() <= request.start:
                break
        by_time: dict = {}
        for b in found:
            by_time.setdefault(whole(b["time"]), b)
        ms = lambda t: int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 1000 - AHEAD
        return [{"time_ms": ms(t), **{c: by_time[t].get(c) for c in NUMBERS}} for t in sorted(by_time)]


def PagedSource(page: Callable[[str, int, int], list[dict]], count: int = 800, tasks: int = 8, fallback: Ask | None = None) -> RemoteSource:  # noqa: N802
    """Bars of a paged source (see Pages), each symbol a request of its own."""
    return RemoteSource(Pages(page, count), fallback, 1, tasks, "paged")
