"""Helpers that the operators share: tables, shared scratch tables, size-checked broadcasts, components."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side whose stored size is at most this many bytes may be broadcast.
BROADCAST_BYTES = 16 << 20

#: ASCII white space: the separators of words in every contract of this package.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Only where none is named (tests on one machine) is a temporary one made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tapeline-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


_own: set[str] = set()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in this application's part of the shared folder, which goes when the driver exits."""
    top = f"{scratch_root(spark)}/tapeline/{spark.sparkContext.applicationId}"
    if top not in _own:
        _own.add(top)
        path = spark._jvm.org.apache.hadoop.fs.Path(top)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

        def clean() -> None:
            with contextlib.suppress(Exception):  # the JVM may be gone; nothing depends on it
                fs.delete(path, True)

        atexit.register(clean)
    return f"{top}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files of a materialized table, by the file system that holds them."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(path).getLength())


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that no plan reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a materialized table, but only when its stored size allows it.

    Beyond the limit the plain table goes back and the join shuffles.
    """
    return F.broadcast(df) if stored_bytes(df) <= limit else df


def with_row(docs: DataFrame) -> DataFrame:
    """doc_id, text, row (a hash of the text) and own, a struct of all columns: whatever the
    table's columns are called, those that an operator adds clash with none."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"), own.alias("own"))


def unpacked(rows: DataFrame, docs: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns of docs out of own, some of them changed."""
    changed = changed or {}
    return rows.select(*[changed.get(c, F.col("own").getField(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def let(value: Column, body) -> Column:
    """Evaluate value once for each row and hand it to body as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def salts(spark: SparkSession) -> int:
    """Into how many parts a hot key is dealt: a multiple of the shuffle's partitions."""
    return max(256, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def components(edges: DataFrame, tag: str) -> DataFrame:
    """Connected components by rounds of contraction.

    edges has long columns a and b, in any order and number. Returns (node, root), one row for
    each node of an edge whose endpoints differ; root is some node of the same component, and the
    root's own row is included. In every round each node points to its least neighbour (or
    itself), pointers are followed once more, and the edges are rewritten between what they point
    to. All joins and aggregations are on node ids; the minima are combined before the shuffle, so
    a node with very many neighbours does not gather them in one task. Each round is written to
    the shared folder; nothing is collected but row counts.
    """
    edges = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{tag}-edges",
    )
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        least = materialize(least, f"{tag}-least")
        hop = least.select(F.col("node").alias("up"), F.col("up").alias("top"))
        up = materialize(least.join(hop, "up").select("node", F.col("top").alias("root")), f"{tag}-up")
        maps.append(up)
        moved = (
            edges.join(up.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
            .join(up.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
            .where("ra <> rb")
            .select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b"))
            .distinct()
        )
        edges = materialize(moved, f"{tag}-edges")
    if not maps:
        return materialize(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), f"{tag}-roots")
    # From the last round to the first: where a round sent a node, later rounds may send it on.
    whole = maps[-1]
    for earlier in reversed(maps[:-1]):
        later = whole.select(F.col("node").alias("root"), F.col("root").alias("last"))
        whole = materialize(
            earlier.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root")), f"{tag}-roots"
        )
    return whole
