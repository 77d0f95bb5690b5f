"""The facade: sync, query, check, scan."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.config import Config
from tapeline.functions import scalars as sc
from tapeline.operators import detectors as det
from tapeline.operators import scan
from tapeline.operators.frame import between_dates
from tapeline.operators.report import notify, report
from tapeline.plans.jobs import Job, Jobs
from tapeline.sources.lake import Lake
from tapeline.sources.readers import BarSource, FallbackSource, answer_of, only_symbols
from tapeline.sources.request import Request
from tapeline.sources.service import Answer, months
from tapeline.streaming.quotes import QuoteLoop


class Engine:
    def __init__(self, spark: SparkSession, config: Config | None = None, source: BarSource | None = None, send: Callable[[dict], int] | None = None):
        self.spark, self.config, self.send = spark, config or Config(), send
        self.source = replace(source, enabled=source.enabled and self.config.fallback) if isinstance(source, FallbackSource) else source
        self.lake, self.jobs = Lake(spark, self.config.lake, self.config.part_rows), Jobs()
        self.quotes: QuoteLoop | None = None
        #: One sync at a time, whoever asks for it.
        self.syncing = threading.Lock()

    def health(self) -> dict:
        """Whether the session answers and the lake's folder can be reached."""
        try:
            self.lake.ensure()
            return {"ok": self.spark.range(1).count() == 1, "message": self.lake.root}
        except Exception as e:
            return {"ok": False, "message": f"{type(e).__name__}: {e}".splitlines()[0]}

    # Sync

    def _sync(self, table: str, symbols: Iterable[str], start: dt.date | None, end: dt.date | None, period: sc.Period, incremental: bool) -> dict:
        if self.source is None:
            raise ValueError("no bar source is configured")
        with self.syncing:
            end = end or dt.date.today()
            start = start or (self.lake.next_start(table, end) if incremental else end)
            # What an earlier sync could not get is asked for first, range by range.
            late = self.lake.missed(table) if incremental else []
            asked = [Request(tuple(sorted(s for s, a, b in late if (a, b) == span)), *span, period) for span in sorted({(a, b) for _, a, b in late})]
            if not (incremental and start > end):
                asked.append(Request(tuple(symbols), start, end, period))
            out = {"rows": 0, "partitions": 0, "failures": []}
            for request in asked:
                got = self._commit(table, request)
                out = {k: out[k] + got[k] for k in out}
            if not (incremental and start > end):
                self.lake.set_watermark(table, end)
            return out

    def _commit(self, table: str, request: Request) -> dict:
        """Fetch and merge one request's bars; symbols that failed are noted with the range, for a later sync."""
        got = self._fetch(request)
        out = self.lake.write(table, got.bars)
        failures = [tuple(r) for r in got.failures.select("symbol", "reason").orderBy("symbol").collect()]  # no more than were asked
        self.lake.note_missed(table, request.symbols, request.start, request.end, dict(failures))
        return out | {"failures": failures}

    def _fetch(self, request: Request) -> Answer:
        """The bars, and the symbols that failed with why. Chunks are as large and as many at once as the settings say."""
        sizes = self.config.daily if request.period.daily else self.config.minute
        return answer_of(self.source, self.spark, request, sizes.chunk_size, sizes.fetch_concurrency)

    def sync_daily(self, symbols: Iterable[str], start: dt.date | None = None, end: dt.date | None = None, incremental: bool = False) -> dict:
        """Fetch daily bars (today's by default) and merge them into the lake; the mark moves when the data is committed.

        Symbols that failed do not hold the mark back: they are kept in a table of the lake with their
        range, and the next incremental sync asks for them first.
        """
        return self._sync("daily_bars", symbols, start, end, sc.Period.D1, incremental)

    def sync_minute(self, symbols: Iterable[str], start: dt.date | None = None, end: dt.date | None = None, incremental: bool = False) -> dict:
        return self._sync("minute_bars_1m", symbols, start, end, sc.Period.M1, incremental)

    def sync_months(self, symbols: Iterable[str], start: dt.date, end: dt.date) -> list[dict]:
        """A long range of daily bars, fetched and committed month by month.

        The mark follows each month that is committed, so an incremental sync goes on behind the last
        one. A month's requests run side by side in the executors.
        """
        if self.source is None:
            raise ValueError("no bar source is configured")
        symbols, done = tuple(symbols), []
        with self.syncing:
            for first, last in months(start, end):
                done.append(self._commit("daily_bars", Request(symbols, first, last)) | {"until": last})
                self.lake.set_watermark("daily_bars", last)
        return done

    def import_new(self, kind: str, folder: str, checkpoint: str | None = None) -> dict:
        """Files that came since the last call, each once; for a scheduler outside to start."""
        return self.lake.import_stream(kind, folder, checkpoint)

    # Queries

    def daily_bars(self, symbol: str, start: dt.date, end: dt.date) -> DataFrame:
        """One symbol's daily bars in order of time; the range prunes months and reaches the scan."""
        df = self.lake.read("daily_bars").where(F.col("symbol") == symbol.strip().upper())
        months = F.concat(F.col("year"), F.col("month"))
        return between_dates(df.where(months.between(f"{start:%Y%m}", f"{end:%Y%m}")), *self._ends(df, start, end)).orderBy("time")

    def minute_bars(self, symbol: str, start: dt.datetime, end: dt.datetime | None = None) -> DataFrame:
        """One symbol's minute bars; a bare date means its session from 09:30:00 to 15:00:00."""
        if not isinstance(start, dt.datetime):
            start, end = dt.datetime.combine(start, dt.time(9, 30)), end or dt.datetime.combine(start, dt.time(15, 0))
        end = end or dt.datetime.combine(start.date(), dt.time(15, 0))
        df = self.lake.read("minute_bars_1m").where((F.col("symbol") == symbol.strip().upper()) & F.col("trade_date").between(f"{start:%Y-%m-%d}", f"{end:%Y-%m-%d}"))
        kind = dict(df.dtypes)["time"]
        ends = (f"{start:%Y-%m-%d %H:%M:%S}", f"{end:%Y-%m-%d %H:%M:%S}") if kind == "string" else (start, end)
        return between_dates(df, *ends).orderBy("time")

    @staticmethod
    def _ends(df: DataFrame, start: dt.date, end: dt.date) -> tuple:
        return (str(start), str(end)) if dict(df.dtypes)["time"] == "string" else (start, end)

    # Patterns

    def pattern_ids(self) -> list[str]:
        return sorted(det.REGISTRY)

    def _window(self, as_of: dt.date, history_days: int | None, symbols: Iterable[str] | None, refresh: bool = False) -> DataFrame:
        """Bars of the history window: the lake's, or with refresh the source's, adjusted as the settings say."""
        start, end = scan.history_window(as_of, history_days)
        if refresh:
            if self.source is None or not symbols:
                raise ValueError("a refresh needs a bar source and symbols")
            return self._fetch(Request(tuple(symbols), start, end, sc.Period.D1, sc.Adjust.parse(self.config.adjust))).bars
        df = self.lake.read("daily_bars")
        months = F.concat(F.col("year"), F.col("month"))
        df = between_dates(df.where(months.between(f"{start:%Y%m}", f"{end:%Y%m}")), *self._ends(df, start, end))
        return only_symbols(df, tuple(symbols)) if symbols else df

    def signals(self, as_of: dt.date, patterns: Iterable[str] | None = None, symbols: Iterable[str] | None = None, history_days: int | None = None, refresh: bool = False) -> DataFrame:
        """Signals at each symbol's latest bar up to as_of; the bars of the history window alone are read."""
        chosen = [det.lookup(p) for p in patterns] if patterns else None
        return scan.latest_signals(self._window(as_of, history_days, symbols, refresh), chosen)

    def check(self, symbol: str, as_of: dt.date, pattern_id: str) -> bool:
        return not self.signals(as_of, [pattern_id], [symbol]).isEmpty()

    def check_all(self, symbol: str, as_of: dt.date) -> DataFrame:
        return self.signals(as_of, None, [symbol])

    def check_many(self, requests: DataFrame, history_days: int | None = None) -> DataFrame:
        """requests (symbol, as_of, pattern_id) with matched, as check() would have it for each, in one plan."""
        return scan.checks(requests, self.lake.read("daily_bars"), history_days)

    def scan_market(self, as_of: dt.date, patterns: Iterable[str] | None = None, symbols: Iterable[str] | None = None, history_days: int | None = None, wait: bool = False,
                    refresh: bool = False, on_progress: Callable[[dict], None] | None = None) -> Job:
        """A job that scans; its result has the counters, each pattern's hits and the report's lines.

        While it runs, its progress says how many of Spark's tasks are done, and at the end it has the
        counters; on_progress gets each change.
        """
        patterns, symbols = list(patterns or []), list(symbols or [])
        for p in patterns:
            det.lookup(p)

        def work() -> dict:
            bars = self._window(as_of, history_days, symbols, refresh)
            wanted = self.spark.createDataFrame([(s,) for s in symbols], "symbol string") if symbols else bars.select("symbol").distinct()
            # Counters, groups and report all read the signals, so they are made once.
            found = scan.latest_signals(bars, [det.lookup(p) for p in patterns] or None).persist()
            try:
                counts = scan.counters(wanted, bars, found).first().asDict()
                lines = report(f"Pattern scan {as_of}", found, scan.failures(wanted, bars))
                groups = {r["pattern_id"]: r["hits"] for r in scan.by_pattern(found, patterns or None).collect()}
            finally:
                found.unpersist()
            notify(lines, self.send)
            return {"counters": counts, "patterns": groups, "report": lines}

        return self.jobs.submit("scan_market", {"as_of": str(as_of), "patterns": patterns, "symbols": symbols}, work, wait, self.spark, on_progress)

    def job(self, job_id: str) -> Job:
        return self.jobs.get(job_id)

    # Quotes

    def start_quotes(self, snapshots: DataFrame, publish: Callable[[DataFrame], None], checkpoint: str, every: str | None = "10 seconds") -> dict:
        self.quotes = self.quotes or QuoteLoop(self.spark, publish)
        return self.quotes.start(snapshots, checkpoint, every)

    def stop_quotes(self) -> dict:
        return self.quotes.stop() if self.quotes else {"running": False, "last": None, "error": None}

    def quote_status(self) -> dict:
        return self.quotes.status() if self.quotes else {"running": False, "last": None, "error": None}
