"""Operator 10: exact top-k inner products by tiled matrix products and tree merging."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeline.llm.common import BROADCAST_BYTES, materialize

#: Queries of a block at most (fewer if their vectors take more than BROADCAST_BYTES); rows and
#: columns of a tile of the product.
QUERY_BLOCK, QUERY_TILE, TILE = 65_536, 2048, 4096
#: Lists merged at once.
FAN_IN = 16
#: What no score is.
NONE = -(2**63)


def whole_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """vec_id and v (array of double: floor(scale * x)) of the vectors that take part.

    Vectors that are null or hold null, NaN or infinite components take no part, nor do rows
    without vec_id.
    """
    x = F.col("embedding").cast("array<double>")
    # From 2^53 on a double is a whole number, and may be beyond a long.
    whole = lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
        .where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(math.inf))))
        .select("vec_id", F.transform("x", lambda e: whole(e * F.lit(float(scale)))).alias("v"))
    )


def matrices(ids: np.ndarray, v: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: ids in ascending order and their rows."""
    out = {}
    offsets = v.offsets.to_numpy()
    lengths, flat, starts = np.diff(offsets), v.values.to_numpy(zero_copy_only=False), offsets[:-1]
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        at = at[np.argsort(ids[at], kind="stable")]
        out[int(d)] = ids[at], flat[starts[at][:, None] + np.arange(d)].reshape(len(at), d)
    return out


class Best:
    """The k best candidates so far of each query of one block and length."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int):
        self.ids, self.rows, self.k = ids, rows, k
        self.most = float(np.abs(rows).max(initial=0))
        self.score = np.full((len(ids), k), NONE, np.int64)
        self.vec = np.full((len(ids), k), 2**63 - 1, np.int64)

    def product(self, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Whole scores, in the narrowest type in which every partial sum is exact; Python's integers beyond."""
        bound = max(1.0, self.most * float(np.abs(c).max(initial=0)) * max(c.shape[1], 1))
        if not c.shape[1]:
            return np.zeros((len(q), len(c)), np.int64)
        if bound < 2**53:
            kind = np.float32 if bound < 2**24 else np.float64
            return (q.astype(kind) @ c.astype(kind).T).astype(np.int64)
        q, c = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (q, c))
        return np.clip(q @ c.T, NONE + 1, 2**63 - 1).astype(np.int64)

    def add(self, c_ids: np.ndarray, c: np.ndarray) -> None:
        """Take in a tile of candidates, in ascending order of id."""
        for a in range(0, len(self.ids), QUERY_TILE):
            ids = self.ids[a : a + QUERY_TILE]
            s = self.product(self.rows[a : a + QUERY_TILE], c)
            s[ids[:, None] == c_ids[None, :]] = NONE  # the query's own
            # Only what reaches a query's k-th best, and the tile's own k-th best, can come in.
            least = self.score[a : a + QUERY_TILE, -1]
            if s.shape[1] > 2 * self.k and (least == NONE).any():
                least = np.maximum(least, np.partition(s, s.shape[1] - self.k, axis=1)[:, -self.k])
            q, at = np.nonzero((s >= least[:, None]) & (s > NONE))
            if not len(q):
                continue
            old = np.flatnonzero(self.score[a : a + QUERY_TILE].ravel() > NONE)
            q = np.concatenate((old // self.k, q))
            score = np.concatenate((self.score[a : a + QUERY_TILE].ravel()[old], s[q[len(old) :], at]))
            vec = np.concatenate((self.vec[a : a + QUERY_TILE].ravel()[old], c_ids[at]))
            order = np.lexsort((vec, -score, q))
            q, score, vec = q[order], score[order], vec[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            q, score, vec, place = (x[place < self.k] for x in (q, score, vec, place))
            self.score[a + q, place], self.vec[a + q, place] = score, vec


def block_count(queries: DataFrame, limit: int) -> int:
    """Into how many blocks by hash queries go so that each has at most QUERY_BLOCK rows and limit
    bytes (one vector alone may be more)."""
    size = F.size("v").cast("long") * 8 + 8
    rows, total = queries.agg(F.count("*"), F.sum(size)).first()
    blocks = max(1, math.ceil(rows / QUERY_BLOCK), math.ceil((total or 0) / limit))
    while blocks > 1 or rows > QUERY_BLOCK:
        most, n, own = queries.groupBy(block_of(blocks).alias("b")).agg(F.sum(size).alias("s"), F.count("*").alias("n")).agg(F.max("s"), F.max("n"), F.max(F.struct("s", "n"))).first()
        if n <= QUERY_BLOCK and (most <= limit or own["n"] == 1):
            break
        blocks = math.ceil(blocks * 1.3)
    return blocks


def block_of(blocks: int):
    return F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The k best candidates of each query by inner product, ties to the smaller vec_id.

    Both have vec_id and v (whole numbers as doubles). A query's own vec_id is no candidate. Only
    vectors of equal length have a product. Returns query_id, rank (from 1), vec_id, score.
    Candidates stay where they lie: nothing of them is shuffled or copied. Queries are sent to all
    tasks a block at a time, each of at most limit bytes, so a table is read as often as there are
    blocks. A task multiplies the block with its candidates tile by tile and keeps k for each
    query, so its memory is bounded and the pairs are never rows. The lists of a query are then
    merged in a tree, FAN_IN at a time.
    """
    spark = queries.sparkSession
    blocks = block_count(queries, limit)
    done = [merged(block_lists(queries.where(block_of(blocks) == b) if blocks > 1 else queries, candidates, k), k, blocks) for b in range(blocks)]
    if blocks == 1:
        return done[0]
    return spark.read.schema(done[0].schema).parquet(*[d._scratch for d in done])


def block_lists(block: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """query_id, list (the task), vec_id and score: the k best of each task's candidates."""
    asked = block.select("vec_id", "v").toArrow().combine_chunks()
    parts = matrices(asked["vec_id"].combine_chunks().to_numpy(), asked["v"].combine_chunks()) if asked.num_rows else {}
    # Whole numbers up to 2^15 fit two bytes.
    parts = {d: (ids, rows.astype(np.int16) if np.abs(rows).max(initial=0) < 2**15 else rows) for d, (ids, rows) in parts.items()}
    sent = block.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {d: Best(ids, rows.astype(np.float64), k) for d, (ids, rows) in sent.value.items()}
        held: list[pa.RecordBatch] = []

        def tile() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            if t.num_rows:
                v = t["v"].combine_chunks() if isinstance(t["v"], pa.ChunkedArray) else t["v"]
                for d, (ids, rows) in matrices(t["vec_id"].combine_chunks().to_numpy(), v).items():
                    if d in best:
                        best[d].add(ids, rows)
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                held.append(batch.slice(at, TILE))
                if sum(b.num_rows for b in held) >= TILE:
                    tile()
        if held:
            tile()
        task = TaskContext.get().partitionId()
        for b in best.values():
            for at in range(0, len(b.ids), 512):
                real = b.score[at : at + 512] > NONE
                q = np.broadcast_to(b.ids[at : at + 512, None], real.shape)[real]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int64()), pa.array(np.full(len(q), task), pa.int32()), pa.array(b.vec[at : at + 512][real], pa.int64()), pa.array(b.score[at : at + 512][real], pa.int64())],
                    ["query_id", "list", "vec_id", "score"],
                )

    return candidates.select("vec_id", "v").mapInArrow(run, "query_id long, list int, vec_id long, score long")


def merged(lists: DataFrame, k: int, blocks: int) -> DataFrame:
    """The k best of each query out of its lists, FAN_IN lists at a time."""
    lists = materialize(lists, "lists")
    n = (lists.agg(F.max("list")).first()[0] or 0) + 1
    while True:
        n = math.ceil(n / FAN_IN)
        lists = lists.withColumn("list", F.floor(F.col("list") / FAN_IN).cast("int"))
        w = Window.partitionBy("query_id", "list").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        if n <= 1:
            break
    lists = lists.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    return lists if blocks == 1 else materialize(lists, "top")


def exact_top_k(embeddings: DataFrame, k: int = 20, scale: int = 64, every: int = 20) -> DataFrame:
    """For each row whose vec_id is divisible by every: its k best among all other rows.

    Rows with a query's vec_id are its own and no candidates of it; of repeated rows of a query
    one counts as the query, and repeated candidates each keep a place. Fewer than k candidates
    are all returned; an empty table gives an empty result. Further columns are not read. Scores
    beyond a long are cut off at its ends.
    """
    vectors = materialize(whole_vectors(embeddings, scale), "vectors")
    asked = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    return top_k(materialize(asked, "queries"), vectors, k)
