"""The Parquet lake: partitioned, idempotent writes and high-water marks.

daily_bars and index_daily_bars lie by exchange/year/month, minute_bars_1m by trade_date/exchange;
never by symbol. A write reads what its partitions hold, merges, keeps the last row of each key and
replaces those partitions alone, so a repeated or partial sync loses nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.operators import frame as fr
from tapeline.sources.readers import ORDER, Manifest, exists, files, read_csv, read_zip

PART_ROWS = 200_000
#: So many touched partitions are sent to all tasks at most.
MOST_LISTED = 50_000
#: Rows of a Parquet row group.
GROUP_ROWS = 131_072
TABLES = {"daily": "daily_bars", "index-daily": "index_daily_bars", "minute": "minute_bars_1m"}
PARTITIONS = {"daily_bars": ["exchange", "year", "month"], "index_daily_bars": ["exchange", "year", "month"], "minute_bars_1m": ["trade_date", "exchange"]}
#: How rows lie in a file, for skipping by minima and maxima.
SORT = {"daily_bars": ["time", "symbol"], "index_daily_bars": ["time", "symbol"], "minute_bars_1m": ["symbol", "time"]}
#: Other names that importers and older files use.
ALIASES = {"turnover": "amount", "turn_over": "amount", "adj_factor": "factor", "turn_over_rate": "turnover_rate", "openInterest": "open_interest"}


MISSED = "symbol string, start date, end date, reason string"


class Lake:
    def __init__(self, spark: SparkSession, root: str, part_rows: int = PART_ROWS):
        self.spark, self.root, self.part_rows = spark, root.rstrip("/"), part_rows

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def ensure(self) -> None:
        """Make the lake's folder (or bucket prefix) if it is missing."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(p)

    def schema(self, table: str) -> T.StructType | None:
        """The declared schema, so that a read opens no footers; null before the first write."""
        path = f"{self.root}/_schema/{table}"
        return T.StructType.fromJson(json.loads(self.spark.read.text(path, wholetext=True).first()[0])) if exists(self.spark, path) else None

    def declare(self, table: str, schema: T.StructType) -> T.StructType:
        """Add what is new in schema to the declared one; partition values are texts."""
        old = self.schema(table) or T.StructType()
        own = [*old, *(f for f in schema if f.name not in old.names)]
        by = PARTITIONS[table]
        new = T.StructType([T.StructField(f.name, T.StringType() if f.name in by else f.dataType) for f in own])
        if new != old:
            self.spark.createDataFrame([(new.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/_schema/{table}")
        return new

    def read(self, table: str) -> DataFrame:
        """The table with partition values as texts (month 03 stays 03)."""
        schema = self.schema(table)
        if schema is None:  # written by something else: look at all files once
            schema = self.declare(table, self.spark.read.option("mergeSchema", "true").parquet(self.path(table)).schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def write(self, table: str, rows: DataFrame, merge: bool = True) -> dict[str, int]:
        """Merge rows into the table; returns rows and partitions written.

        Of rows with one key the last by where they come from (ORDER) stays. Rows without that have no
        order; of them the last by their own values stays, so a repeated write gives the same.
        """
        by = PARTITIONS[table]
        self.ensure()
        rows = rows.select(*[F.col(c).alias(ALIASES.get(c, c)) for c in rows.columns if c not in (*ORDER, "unused", *by[1:])], *[F.col(c) for c in ORDER if c in rows.columns])
        rows = fr.day_keys(rows) if table == "minute_bars_1m" else fr.month_keys(rows)
        rows = fr.drop_null_keys(rows, ("symbol", "time", *by)) if "exchange" in rows.columns else rows.withColumn("exchange", F.get(F.split("symbol", "\\."), F.lit(1)))
        order: list[Column] = [F.col(c) for c in ORDER if c in rows.columns] or [F.col(c) for c in rows.columns if c not in ("symbol", "time")]
        rows = fr.dedup(rows, order).drop(*ORDER).withColumn("_new", F.lit(1))
        rows = rows.withColumns({c: F.col(c).cast("string") for c in by})
        # New rows are read twice (their partitions, then themselves): once written, once for all.
        staged = f"{self.root}/_staging/{table}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{staged}/new")
        rows = self.spark.read.parquet(f"{staged}/new")
        listed = rows.select(*by).distinct().limit(MOST_LISTED + 1).collect()
        n = len(listed)
        # So many names of partitions are a few megabytes at most; more are joined by a shuffle. Each
        # column's own values are compared too, as plain comparisons of partition columns prune a scan.
        touched = F.broadcast(self.spark.createDataFrame(listed, rows.select(*by).schema)) if n <= MOST_LISTED else rows.select(*by).distinct()
        within = [F.col(c).isin(*sorted({r[c] for r in listed})) for c in by] if 0 < n <= MOST_LISTED else []
        near = reduce(Column.__and__, within, F.lit(True))
        if merge and exists(self.spark, self.path(table)):
            # Partition values name folders, so only the touched partitions are read.
            old = self.read(table).where(near).join(touched, by, "left_semi").withColumn("_new", F.lit(0))
            rows = fr.dedup(rows.unionByName(old, allowMissingColumns=True), [F.col("_new")])
        rows = rows.drop("_new")
        out = rows.repartition(*by).sortWithinPartitions(*by, *SORT[table])
        # The merge reads the partitions that it replaces, so it is whole in the staging folder first.
        seen = Observation()
        out.observe(seen, F.count("*").alias("rows")).write.parquet(f"{staged}/merged")
        merged = self.spark.read.schema(out.schema).parquet(f"{staged}/merged")
        count = seen.get["rows"]  # counted by the job that wrote them
        self.declare(table, merged.schema)
        # The staged files are dealt out and sorted already: no second shuffle, only what a task holds is put in order.
        put = Observation()
        writer = merged.sortWithinPartitions(*by, *SORT[table]).observe(put, F.count("*").alias("rows")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer = writer.option("maxRecordsPerFile", self.part_rows if table == "minute_bars_1m" else 0).option("parquet.block.row.count.limit", GROUP_ROWS)
        writer.option("compression", "snappy").partitionBy(*by).parquet(self.path(table))
        if put.get["rows"] != count:
            raise OSError(f"{table}: {put.get['rows']} rows written instead of {count}")
        self._delete(staged)
        return {"rows": count, "partitions": n if n <= MOST_LISTED else touched.count()}

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def watermark(self, name: str) -> dt.date | None:
        """The last date that a finished sync covered."""
        path = f"{self.root}/_watermark/{name}"
        if not exists(self.spark, path):
            return None
        return self.spark.read.schema("date date").json(path).agg(F.max("date")).first()[0]

    def set_watermark(self, name: str, date: dt.date) -> None:
        """After the data is committed."""
        self.spark.createDataFrame([(date,)], "date date").coalesce(1).write.mode("overwrite").json(f"{self.root}/_watermark/{name}")

    def missed(self, name: str) -> list[tuple[str, dt.date, dt.date]]:
        """Symbols that a sync could not get, each with the range that was asked for."""
        path = f"{self.root}/_missed/{name}"
        if not exists(self.spark, path):
            return []
        return sorted((r["symbol"], r["start"], r["end"]) for r in self.spark.read.schema(MISSED).json(path).collect())

    def note_missed(self, name: str, symbols: tuple[str, ...], start: dt.date, end: dt.date, failed: dict[str, str]) -> None:
        """After a request: those of its symbols that failed are missed, the others' ranges within it no longer."""
        asked, path = set(symbols), f"{self.root}/_missed/{name}"
        old = [tuple(r) for r in self.spark.read.schema(MISSED).json(path).collect()] if exists(self.spark, path) else []
        rest = [m for m in old if not (m[0] in asked and start <= m[1] and m[2] <= end)]
        new = rest + [(s, start, end, why) for s, why in sorted(failed.items())]
        if sorted(new) != sorted(old):
            self.spark.createDataFrame(new, MISSED).coalesce(1).write.mode("overwrite").json(path)

    def next_start(self, name: str, default: dt.date) -> dt.date:
        last = self.watermark(name)
        return default if last is None else last + dt.timedelta(days=1)

    def _rows(self, kind: str, paths: list[str]) -> DataFrame:
        """Typed rows of CSV and ZIP files."""
        zips, plain = [p for p in paths if p.lower().endswith(".zip")], [p for p in paths if p.lower().endswith(".csv")]
        parts = ([read_csv(self.spark, plain, kind)] if plain else []) + ([read_zip(self.spark, zips, kind)] if zips else [])
        return reduce(DataFrame.unionByName, parts)

    def import_files(self, kind: str, folder: str) -> dict[str, int]:
        """Import CSV and ZIP files that the manifest has not; append to it when all is written."""
        table = TABLES[kind]
        manifest = Manifest(self.spark, f"{self.root}/_manifest/{kind}")
        found = manifest.new(files(self.spark, folder, "*.{csv,CSV,zip,ZIP}"))
        paths = [r["path"] for r in found.select("path").collect()]
        if not paths:
            return {"rows": 0, "partitions": 0, "files": 0}
        rows = self._rows(kind, paths)
        done = self.spark.createDataFrame(found.collect(), found.schema)
        out = self.write(table, rows)
        manifest.add(done)
        return out | {"files": len(paths)}

    def import_stream(self, kind: str, folder: str, checkpoint: str | None = None) -> dict[str, int]:
        """Import the CSV and ZIP files that came since the last call: a file stream that takes what is there
        and ends. Its checkpoint (in the lake unless given) is the mark of what is imported.

        A file is imported once: a batch is done when its rows are committed; one that failed is merged
        again as a whole, which leaves the same rows. Start it from any scheduler, one at a time.
        """
        table = TABLES[kind]
        done: list[dict[str, int]] = []
        schema = "path string, modificationTime timestamp, length long, content binary"
        found = self.spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.{csv,CSV,zip,ZIP}").option("recursiveFileLookup", "true").load(folder)

        def batch(df: DataFrame, _: int) -> None:
            paths = [r["path"] for r in df.select("path").collect()]  # names alone; contents are read by tasks
            if paths:
                done.append(self.write(table, self._rows(kind, paths)) | {"files": len(paths)})

        writer = found.writeStream.option("checkpointLocation", checkpoint or f"{self.root}/_imports/{kind}").foreachBatch(batch)
        writer.trigger(availableNow=True).start().awaitTermination()
        return {k: sum(d[k] for d in done) for k in ("rows", "partitions", "files")}
