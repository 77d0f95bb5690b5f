"""Scans: indicators, detectors and reports over many symbols, as of a date or at every bar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeline.operators import detectors as det
from tapeline.operators.evidence import whole
from tapeline.operators.frame import dedup
from tapeline.operators.indicators import DEFAULT_PATTERN_SET, compute

MIN_BARS = 20
HISTORY_DAYS, LEAST_HISTORY_DAYS = 365, 30
#: Detectors look back over at most so many bars: 120 from one some ten bars back.
TAIL = 140


def history_window(as_of: dt.date, history_days: int | None = None) -> tuple[dt.date, dt.date]:
    days = max(LEAST_HISTORY_DAYS, HISTORY_DAYS if history_days is None else history_days)
    return as_of - dt.timedelta(days=days), as_of


def series(bars: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One bar for each symbol and time, the last by order (ingest order); without keys none."""
    return dedup(bars, order) if order else bars.where(F.col("symbol").isNotNull() & F.col("time").isNotNull())


def prepared(bars: DataFrame) -> DataFrame:
    """Bars of symbols with enough history, with all that detectors read."""
    n = F.count("*").over(Window.partitionBy("symbol"))
    long_enough = bars.withColumn("_n", n).where(F.col("_n") >= MIN_BARS).drop("_n")
    return det.prepare(compute(long_enough, DEFAULT_PATTERN_SET))


def latest_signals(bars: DataFrame, chosen: Iterable[det.Detector] | None = None, tail: int = TAIL) -> DataFrame:
    """signals() at each symbol's latest bar alone. Indicators run over all bars; what detectors read
    behind them is made for the last `tail` bars, which is as far as any looks back."""
    whole = compute(bars.withColumn("_n", F.count("*").over(Window.partitionBy("symbol"))).where(F.col("_n") >= MIN_BARS), DEFAULT_PATTERN_SET)
    last = whole.withColumn("_rn", F.row_number().over(det.by_symbol())).where(F.col("_n") - F.col("_rn") < tail).drop("_rn")
    return signals(det.prepare(last, F.greatest(F.col("_n") - tail, F.lit(0))), chosen, trimmed=True)


#: Between a symbol and the date that a check is made as of, in the name of its own series.
AT = "@"


def checks(requests: DataFrame, bars: DataFrame, history_days: int | None = None) -> DataFrame:
    """requests (symbol, as_of, pattern_id; further columns stay) with matched: whether the pattern is found at the
    symbol's last bar up to as_of, over the bars of the history window before it.

    All requests are one plan. Each symbol and date is a series of its own, made by a join of the bars
    with the distinct dates of their symbol; requests for other patterns of one series share it. A
    symbol without bars, or with too few, matches nothing. An unknown pattern is an error.
    """
    known = [r["pattern_id"] for r in requests.select("pattern_id").distinct().collect()]  # as many as there are patterns
    chosen = [det.lookup(p) for p in known if p is not None]
    if not chosen:
        return requests.withColumn("matched", F.lit(False))
    days = max(LEAST_HISTORY_DAYS, HISTORY_DAYS if history_days is None else history_days)
    wanted = requests.select(F.upper(F.trim("symbol")).alias("of"), F.col("as_of").cast("date").alias("as_of")).dropna().distinct()
    day = bars["time"].cast("date")
    near = (bars["symbol"] == wanted["of"]) & day.between(F.date_sub(wanted["as_of"], days), wanted["as_of"])
    own = F.concat_ws(AT, wanted["of"], wanted["as_of"].cast("string")).alias("symbol")
    windows = bars.join(wanted, near).select(own, *[bars[c] for c in bars.columns if c != "symbol"])
    found = latest_signals(windows, chosen).select(F.col("symbol").alias("series"), F.col("pattern_id").alias("found")).distinct()
    series = F.concat_ws(AT, F.upper(F.trim("symbol")), F.col("as_of").cast("date").cast("string"))
    out = requests.join(found, (F.col("series") == series) & (F.col("found") == F.col("pattern_id")), "left")
    return out.select(*[requests[c] for c in requests.columns], F.col("found").isNotNull().alias("matched"))


def evidence_frame(ready: DataFrame, detector: det.Detector) -> DataFrame:
    """History of one detector: symbol, exchange, time and the evidence as columns, where it fires."""
    ready, (found,) = det.B.apply(ready, [detector])
    return ready.select("symbol", "exchange", "time", "rn", found.alias("e")).where((F.col("rn") >= MIN_BARS) & F.col("e").isNotNull()).select("symbol", "exchange", "time", "e.*")


def signals(ready: DataFrame, chosen: Iterable[det.Detector] | None = None, latest_only: bool = True, trimmed: bool = False) -> DataFrame:
    """symbol, exchange, time, pattern_id, signal_date, score, tags, explanation, evidence (JSON).

    At the latest bar of each symbol, or at every bar. All detectors share one window, so a symbol
    is sorted once. trimmed: the frame holds only the last bars of each symbol, which then become one row.
    """
    chosen = list(det.REGISTRY.values() if chosen is None else chosen)
    ready, made = (det.B.latest if latest_only and trimmed else det.B.apply)(ready, chosen)
    found = ready.select("symbol", "exchange", "time", "rn", "latest", *[e.alias(d.id) for d, e in zip(chosen, made, strict=True)]).where(F.col("rn") >= MIN_BARS)
    if latest_only:
        found = found.where("latest")
    rows = [
        F.when(
            F.col(d.id).isNotNull(),
            F.struct(
                F.lit(d.id).alias("pattern_id"), F.col(d.id)["signal_date"].cast("date").alias("signal_date"), F.lit(d.score).alias("score"),
                F.array(*map(F.lit, d.tags)).alias("tags"), F.lit(d.explanation).alias("explanation"), F.to_json(whole(d.id, F.col(d.id), found.schema[d.id].dataType.names)).alias("evidence"),
            ),
        )
        for d in chosen
    ]
    return found.select("symbol", "exchange", "time", F.explode(F.array_compact(F.array(*rows))).alias("s")).select("symbol", "exchange", "time", "s.*")


def counters(requested: DataFrame, bars: DataFrame, found: DataFrame) -> DataFrame:
    """One row: requested, completed, series_loaded, skipped_short, signals, failed."""
    sizes = bars.groupBy("symbol").agg(F.count("*").alias("n"))
    hits = found.groupBy("symbol").agg(F.count("*").alias("hits"))
    per = requested.select("symbol").distinct().join(sizes, "symbol", "left").join(hits, "symbol", "left")
    n = F.coalesce("n", F.lit(0))
    return per.agg(
        F.count("*").alias("requested"), F.count("*").alias("completed"), F.count_if(n > 0).alias("series_loaded"),
        F.count_if((n > 0) & (n < MIN_BARS)).alias("skipped_short"), F.coalesce(F.sum("hits"), F.lit(0)).alias("signals"), F.count_if(n == 0).alias("failed"),
    )


def by_pattern(found: DataFrame, catalog: Iterable[str] | None = None) -> DataFrame:
    """pattern_id, hits and symbols of every known pattern, those without signals included."""
    spark = found.sparkSession
    known = spark.createDataFrame([(p,) for p in sorted(catalog or det.REGISTRY)], "pattern_id string")
    grouped = found.groupBy("pattern_id").agg(F.count("*").alias("hits"), F.array_sort(F.collect_set("symbol")).alias("symbols"))
    # The catalogue has a row for each detector, so it is the side that is sent around.
    none = F.array().cast("array<string>")
    return F.broadcast(known).join(grouped, "pattern_id", "left").select("pattern_id", F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("symbols", none).alias("symbols"))


def pattern_summary(found: DataFrame) -> DataFrame:
    return found.groupBy("pattern_id").agg(F.count("*").alias("hits"))


def failures(requested: DataFrame, bars: DataFrame) -> DataFrame:
    """symbol and error of requested symbols without bars."""
    return requested.select("symbol").distinct().join(bars.select("symbol").distinct(), "symbol", "left_anti").withColumn("error", F.lit("no bars in the window"))
