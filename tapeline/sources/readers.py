"""Sources: bar sources behind one protocol, positional CSV, ZIP archives of CSV, symbol files, manifests."""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions import scalars as sc
from tapeline.operators import frame as fr
from tapeline.sources.request import Request
from tapeline.sources.scratch import scratch
from tapeline.sources.service import Answer, PagedSource, RemoteSource, kline, no_failures  # noqa: F401

# The positional columns of the CSV layouts.
DAILY_CSV = ["symbol", "time", "open", "high", "low", "close", "volume", "turnover", "factor", "prev_close", "avg_price", "high_limit", "low_limit", "turnover_rate", "amp_rate", "quote_rate", "is_paused", "is_st"]
INDEX_CSV = ["symbol", "time", "open", "high", "low", "close", "volume", "turnover", "unused", "prev_close"]
MINUTE_CSV = ["symbol", "time", "open", "high", "low", "close", "factor", "volume", "turnover", "turnover_rate", "is_paused"]
#: Where an imported row comes from, in the order in which rows came.
ORDER = ["source_file", "source_part", "source_row"]
LAYOUTS = {"daily": (DAILY_CSV, 10), "index-daily": (INDEX_CSV, 10), "minute": (MINUTE_CSV, 19)}


class BarSource(Protocol):
    """A place that bars come from: a frame with the K-line columns, filtered to the request."""

    def fetch(self, spark: SparkSession, request: Request) -> DataFrame: ...


#: Up to so many symbols are compared in the scan; more are a table to join with.
LISTED = 1000


def only_symbols(df: DataFrame, symbols: tuple[str, ...]) -> DataFrame:
    if len(symbols) <= LISTED:
        return df.where(F.col("symbol").isin(*symbols))
    wanted = df.sparkSession.createDataFrame([(s,) for s in dict.fromkeys(symbols)], "symbol string")
    return df.join(wanted, "symbol", "left_semi")


@dataclass(frozen=True)
class ParquetSource:
    """Bars in a Parquet table, and tables of adjusted bars by adjustment; the range and the symbols reach the scan."""

    path: str
    adjusted: dict[sc.Adjust, str] = field(default_factory=dict)

    def fetch(self, spark: SparkSession, request: Request) -> DataFrame:
        if self.adjusted and request.adjust not in {sc.Adjust.NONE, *self.adjusted}:
            raise ValueError(f"no bars with adjustment {request.adjust.value}")
        df = spark.read.parquet(self.adjusted.get(request.adjust, self.path))
        kind = dict(df.dtypes)["time"]
        end: object = request.end
        if kind.startswith("timestamp"):
            end = dt.datetime.combine(request.end, dt.time.max)
        elif kind == "string":
            end = f"{request.end} 23:59:59"
        start = str(request.start) if kind == "string" else request.start
        return only_symbols(fr.between_dates(df, start, end), request.symbols)


@dataclass(frozen=True)
class NoSource:
    """A source that is switched off: no bars, whatever is asked."""

    def fetch(self, spark: SparkSession, request: Request) -> DataFrame:
        return fr.empty_frame(spark)


@dataclass(frozen=True)
class FallbackSource:
    """The primary's bars, and the secondary's for symbols that the primary has none of; only these are
    asked of it. A source that fails as a whole has no bars of any symbol."""

    primary: BarSource
    secondary: BarSource
    enabled: bool = True

    @property
    def bounded(self) -> bool:
        return any(getattr(s, "bounded", False) for s in (self.primary, self.secondary))

    def answer(self, spark: SparkSession, request: Request, size: int | None = None, tasks: int | None = None) -> Answer:
        if not self.enabled:
            got = answer_of(self.primary, spark, request, size, tasks)
            return Answer(got.bars.withColumn("adjusted", F.lit(True)), got.failures)
        first = _whole(self.primary, spark, request, size, tasks)
        found = {r["symbol"] for r in fr.symbols(first.bars).collect()}  # no more than were asked
        left = tuple(s for s in dict.fromkeys(request.symbols) if s not in found)
        if not left:
            return Answer(first.bars.withColumn("adjusted", F.lit(True)), no_failures(spark))
        second = _whole(self.secondary, spark, replace(request, symbols=left), size, tasks)
        columns = [c for c in first.bars.columns if c in second.bars.columns and c != "adjusted"]
        reasons = first.failures.select("symbol", F.concat(F.lit("primary: "), "reason").alias("reason"))
        reasons = reasons.union(second.failures.select("symbol", F.concat(F.lit("secondary: "), "reason")))
        failed = reasons.groupBy("symbol").agg(F.array_join(F.array_sort(F.collect_set("reason")), "; ").alias("reason"))
        bars = fr.with_fallback(first.bars.select(*columns), second.bars.select(*columns))
        return Answer(bars, failed.join(fr.symbols(bars), "symbol", "left_anti"))

    def fetch(self, spark: SparkSession, request: Request) -> DataFrame:
        return self.answer(spark, request).bars


def _staged(df: DataFrame) -> DataFrame:
    """df read once, so that what fails fails here."""
    path = scratch(df.sparkSession, "bars")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _whole(source: BarSource, spark: SparkSession, request: Request, size: int | None, tasks: int | None) -> Answer:
    """A source's answer; if the source fails, every symbol's failure."""
    try:
        got = answer_of(source, spark, request, size, tasks)
        return Answer(_staged(got.bars), got.failures)
    except Exception as e:
        why = f"{type(e).__name__}: {e}".splitlines()[0]
        return Answer(fr.empty_frame(spark), spark.createDataFrame([(s, why) for s in dict.fromkeys(request.symbols)], "symbol string, reason string"))


def answer_of(source: BarSource, spark: SparkSession, request: Request, size: int | None = None, tasks: int | None = None) -> Answer:
    """Bars and failures of any source. Sources that have answer() are asked by it; others that say bounded =
    True are asked for size symbols at a time by as many threads as tasks, the rest for all at once."""
    if hasattr(source, "answer"):
        return source.answer(spark, request, size, tasks)
    if not getattr(source, "bounded", False):
        return Answer(source.fetch(spark, request), no_failures(spark))
    chunked = ChunkedSource(source, size or 200, tasks or 8)
    return Answer(chunked.fetch(spark, request), spark.createDataFrame(chunked.failures, "symbol string, reason string"))


@dataclass
class ChunkedSource:
    """Another source's bars, asked for `size` symbols at a time by `concurrency` threads.

    For sources that make plans of bounded requests in the driver; services are better asked by
    executors (RemoteSource). A chunk is read at once, so a chunk that fails, also while it is read, is
    asked for in halves, down to a symbol; a symbol that fails alone is noted in failures and left out.
    """

    source: BarSource
    size: int = 200
    concurrency: int = 8
    failures: list[tuple[str, str]] = field(default_factory=list)

    def fetch(self, spark: SparkSession, request: Request) -> DataFrame:
        def ask(symbols: tuple[str, ...]) -> list[DataFrame]:
            try:
                return [_staged(self.source.fetch(spark, replace(request, symbols=symbols)))]
            except Exception as e:
                if len(symbols) == 1:
                    self.failures.append((symbols[0], f"{type(e).__name__}: {e}".splitlines()[0]))
                    return []
                half = len(symbols) // 2
                return ask(symbols[:half]) + ask(symbols[half:])

        self.failures.clear()
        chunks = [request.symbols[k : k + self.size] for k in range(0, len(request.symbols), max(1, self.size))]
        with ThreadPoolExecutor(max(1, self.concurrency)) as pool:
            frames = [f for found in pool.map(ask, chunks) for f in found]
        self.failures.sort()
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else fr.empty_frame(spark)


def bars_from_response(items: DataFrame, period: sc.Period) -> DataFrame:
    """K-line rows of a nested response (symbol, bars: array of structs with time_ms and numbers)."""
    rows = items.select("symbol", F.explode("bars").alias("b")).select("symbol", "b.*", F.lit("primary").alias("source"))
    return kline(rows, period)


def universe(members: DataFrame) -> DataFrame:
    """Sorted distinct A-share symbols of the exchanges that are scanned; an error if there are none."""
    found = members.select(F.trim("symbol").alias("symbol")).where(sc.is_a_share(F.col("symbol"))).distinct().orderBy("symbol")
    if found.isEmpty():
        raise ValueError("no A-share symbols")
    return found


def symbol_file(spark: SparkSession, path: str) -> DataFrame:
    """One symbol on a line; blank lines and lines that begin with # do not count."""
    line = F.trim("value")
    found = spark.read.text(path).select(line.alias("symbol")).where((F.col("symbol") != "") & ~F.col("symbol").startswith("#")).distinct().orderBy("symbol")
    if found.isEmpty():
        raise ValueError(f"{path} names no symbols")
    return found


def files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """path, length and modificationTime of files (not their content), by a glob on names."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(folder).select("path", "length", "modificationTime")


def _acceptable(columns: list[str], width: int) -> tuple[Column, list[Column]]:
    parts = F.split("symbol", "\\.")
    fit = (F.size(parts) >= 2) & (F.length("time") >= width)
    texts = {"symbol", "time", "unused"}
    made = [sc.number_from_text(F.col(c)).alias(c) for c in columns if c not in texts]
    return fit, [F.trim("symbol").alias("symbol"), F.get(parts, F.lit(1)).alias("exchange"), F.substring(F.trim("time"), 1, width).alias("time"), *made]


def csv_rows(raw: DataFrame, kind: str) -> DataFrame:
    """Typed rows of raw texts (columns by place, plus source): bad numbers are null, rows without a symbol or time go."""
    columns, width = LAYOUTS[kind]
    fit, made = _acceptable(columns, width)
    extra = [c for c in ORDER if c in raw.columns]
    return raw.where(fit).select(*made, *extra)


def read_csv(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """A header line, then columns by place; a row with too many or too few fields fails the read."""
    schema = ", ".join(f"`{c}` string" for c in LAYOUTS[kind][0])
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[cC][sS][vV]").csv(path, header=True, schema=schema, mode="FAILFAST", enforceSchema=True)
    # A file may be read in several parts, in any order: the part's place in it, then the row's in the part.
    raw = raw.withColumns({"source_file": F.col("_metadata.file_path"), "source_part": F.col("_metadata.file_block_start"), "source_row": F.monotonically_increasing_id()})
    return csv_rows(raw, kind)


#: Tasks over the entries of archives at most; beyond, a task reads several.
MOST_ENTRY_TASKS = 10_000
#: File systems whose files tasks can read in parts.
RANGED = ("file", "hdfs", "s3", "s3a", "gs")


def opened(path: str):
    """A file that can be read in parts, in any of the RANGED stores."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    rest = rest.lstrip("/")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file(f"/{rest}")
    place, _, inner = rest.partition("/")
    found, root = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{place}")
    return found.open_input_file(f"{root.rstrip('/')}/{inner}")


def csv_entries(archive: zipfile.ZipFile) -> list[str]:
    return sorted(n for n in archive.namelist() if n.lower().endswith(".csv"))


def entry_rows(archive: zipfile.ZipFile, path: str, entry: str, columns: list[str]) -> Iterator[pd.DataFrame]:
    """An entry's rows, inflated and parsed a chunk at a time."""
    at = 0
    with archive.open(entry) as f:
        for part in pd.read_csv(f, header=None, skiprows=1, names=columns, dtype=str, keep_default_na=False, chunksize=100_000, index_col=False):
            yield part.assign(source_file=f"{path}/{entry}", source_part=0, source_row=range(at, at + len(part)))
            at += len(part)


def read_zip(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """Rows of every .csv entry of the archives.

    Where tasks can read parts of files, each entry is a task of its own: the archive's directory is
    read from its end, and an entry from where it lies, so neither an archive nor an entry is ever whole in
    memory. In other stores Spark hands whole archives (of at most 2 GB) to tasks.
    """
    columns = LAYOUTS[kind][0]
    schema = ", ".join(f"`{c}` string" for c in columns) + ", source_file string, source_part long, source_row long"
    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[zZ][iI][pP]").load(path)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where in batch["path"]:
                with opened(where) as f, zipfile.ZipFile(f) as archive:
                    yield pd.DataFrame({"path": where, "entry": csv_entries(archive)}, columns=["path", "entry"], dtype=str)

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, entry in zip(batch["path"], batch["entry"], strict=True):
                with opened(where) as f, zipfile.ZipFile(f) as archive:
                    yield from entry_rows(archive, where, entry, columns)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for entry in csv_entries(archive):
                        yield from entry_rows(archive, where, entry, columns)

    paths = archives.select("path")
    if paths.where(~F.substring_index("path", ":", 1).isin(*RANGED)).isEmpty():
        staged = scratch(spark, "entries")
        paths.mapInPandas(listed, "path string, entry string").write.parquet(staged)
        names = spark.read.schema("path string, entry string").parquet(staged)
        rows = names.repartition(max(1, min(names.count(), MOST_ENTRY_TASKS)), "path", "entry").mapInPandas(entries, schema)
    else:
        rows = archives.select("path", "content").mapInPandas(whole, schema)
    return csv_rows(rows, kind)


MANIFEST = "path string, length long, modificationTime timestamp"


@dataclass
class Manifest:
    """What has been imported: path, size and time of change of each source, in a Parquet table."""

    spark: SparkSession
    path: str
    seen: DataFrame = field(init=False)

    def __post_init__(self):
        self.seen = self.spark.read.schema(MANIFEST).parquet(self.path) if exists(self.spark, self.path) else self.spark.createDataFrame([], MANIFEST)

    def new(self, found: DataFrame) -> DataFrame:
        return found.join(self.seen, ["path", "length", "modificationTime"], "left_anti")

    def add(self, done: DataFrame) -> None:
        """After the import succeeded."""
        done.select("path", "length", "modificationTime").write.mode("append").parquet(self.path)
        self.seen = self.spark.read.schema(MANIFEST).parquet(self.path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
