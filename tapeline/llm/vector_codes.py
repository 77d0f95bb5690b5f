"""Operator 13: product codes of vectors, assigned by partial-distance search.

A vector is cut into parts, each with a codebook of its own. The search for the nearest entry takes
a part's positions in descending variance over the codebook, adds up whole squared differences, and
drops an entry for a vector as soon as its sum strictly exceeds the best complete distance found so
far; what ties stays, so the least index wins as in a full search.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm.common import BROADCAST_BYTES, materialize, stored_bytes

#: Entries of a codebook; parts of a vector; rounds of training; what components are multiplied by.
ENTRIES, PARTS, ROUNDS, SCALE = 256, 4, 4, 1024
#: Vectors and entries that are compared at a time.
ROWS, BLOCK = 2048, 64
#: Positions whose sums one aggregation has as columns.
WIDTH = 32
#: Labels with more than this share of the rows are joined by a broadcast of at most its inverse.
HOT_SHARE = 1 / 1024
#: The largest long, where whole numbers, distances and sums end.
MOST = 2**63 - 1


def cuts(length: int, parts: int) -> list[int]:
    """Where parts begin, and the end; equal parts if the length can be divided."""
    return [length * k // parts for k in range(parts + 1)]


class Codebook:
    """The entries of one part, for searches by partial distances."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.most = max([0, *(abs(int(x)) for x in (entries.min(initial=0), entries.max(initial=0)))])
        n, wide = len(entries), entries.astype(object)
        spread = n * (wide * wide).sum(axis=0) - wide.sum(axis=0) ** 2 if entries.size else []
        #: Positions by descending variance (times the squared number of entries: whole numbers).
        self.order = sorted(range(entries.shape[1]), key=lambda j: (-spread[j], j))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to the nearest entry of each row, ties to the lower index."""
        code, least = np.zeros(len(x), np.int64), []
        bound = self.most + max(0, -int(x.min(initial=0)), int(x.max(initial=0)))
        kind = np.int64 if bound * bound * max(x.shape[1], 1) <= MOST else object  # Python's integers where sums could overflow
        entries = self.entries.astype(kind)
        for at in range(0, len(x), ROWS):
            code[at : at + ROWS], d = self._search(x[at : at + ROWS].astype(kind), entries)
            least.append(d)
        return code, np.concatenate(least) if least else np.zeros(0, np.int64)

    def _search(self, x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, lead = len(x), self.order[: max(1, len(self.order) // 4)]
        code = np.zeros(n, np.int64)
        # The first complete distance: the entry that is nearest on the leading positions.
        if lead:
            far = np.zeros((n, len(entries)), x.dtype)
            for j in lead:
                d = x[:, j, None] - entries[None, :, j]
                far += d * d
            code = far.argmin(axis=1)
        d = x - entries[code]
        best = (d * d).sum(axis=1) if d.shape[1] else np.zeros(n, x.dtype)
        for first in range(0, len(entries), BLOCK):
            # All pairs of rows and entries of the block; what cannot be nearest falls out by masks.
            if lead:
                row, entry = np.nonzero(far[:, first : first + BLOCK] <= best[:, None])
                total = far[row, first + entry]
            else:
                row, entry = (a.ravel() for a in np.indices((n, min(BLOCK, len(entries) - first))))
                total = np.zeros(len(row), x.dtype)
            entry = entry + first
            for j in self.order[len(lead) :]:
                d = x[row, j] - entries[entry, j]
                total = total + d * d
                stay = total <= best[row]
                row, entry, total = row[stay], entry[stay], total[stay]
            if not len(row):
                continue
            # Complete: the least of each row, at its lowest index, against the best so far.
            starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            least = np.minimum.reduceat(total, starts)
            hit = np.flatnonzero(total == np.repeat(least, np.diff(np.append(starts, len(row)))))
            rows, at = np.unique(row[hit], return_index=True)
            found = entry[hit[at]]
            better = (least < best[rows]) | (found < code[rows])  # an equal distance at a lower index wins too
            code[rows[better]], best[rows[better]] = found[better], least[better]
        return code, best


def whole_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and v (array of long: floor(scale * x)) of the rows whose vector is there and
    holds no null, NaN or infinity. Whole numbers beyond a long are cut off at its ends."""
    x = F.col("embedding").cast("array<double>")
    # An ANSI cast refuses what a long cannot hold.
    whole = lambda y: F.when(y >= 2.0**63, F.lit(MOST)).when(y <= -(2.0**63), F.lit(-MOST)).otherwise(F.floor(F.when(F.abs(y) < 2.0**63, y)).cast("long"))
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), x.alias("x"))
        .where(F.col("x").isNotNull())
        .where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(math.inf))))
        .select("vec_id", "label", F.transform("x", lambda e: whole(e * F.lit(float(scale)))).alias("v"))
    )


def matrix(v: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have the length, and their vectors as a matrix."""
    offsets = v.offsets.to_numpy()
    at = np.flatnonzero(np.diff(offsets) == length)
    flat = v.values.to_numpy(zero_copy_only=False)
    return at, flat[offsets[at][:, None] + np.arange(length)].reshape(len(at), length)


def part_sums(vectors: DataFrame, books: list[np.ndarray], length: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """By part and entry: how many parts are nearest to the entry, and their sum.

    Each task adds up its own before anything is shuffled; sums are whole numbers of 38 digits.
    """
    at = cuts(length, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Codebook(b) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        # Sums of the upper and the lower 32 bits: no task has rows enough to overflow them.
        high, low = ([np.zeros(b.shape, np.int64) for b in books] for _ in range(2))
        for batch in batches:
            _, rows = matrix(batch.column(0), length)
            for p, book in enumerate(found):
                x = rows[:, at[p] : at[p + 1]]
                code, _ = book.nearest(x)
                count[p] += np.bincount(code, minlength=len(count[p]))
                np.add.at(high[p], code, x >> 32)
                np.add.at(low[p], code, x & 0xFFFFFFFF)
        out = []
        for p in range(len(books)):
            for e in np.flatnonzero(count[p]).tolist():
                total = [Decimal((int(h) << 32) + int(w)) for h, w in zip(high[p][e], low[p][e], strict=True)]
                out += [{"part": p, "entry": e, "block": k // WIDTH, "n": int(count[p][e]), "s": total[k : k + WIDTH]} for k in range(0, max(len(total), 1), WIDTH)]
        shape = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("block", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.decimal128(38, 0)))])
        yield pa.RecordBatch.from_pylist(out, shape)

    sums = vectors.select("v").mapInArrow(run, "part int, entry int, block int, n long, s array<decimal(38,0)>")
    totals = [F.sum(F.get("s", F.lit(k))).alias(f"s{k}") for k in range(min(WIDTH, max(1, math.ceil(length / len(books)))))]
    grouped = sums.groupBy("part", "entry", "block").agg(F.sum("n").alias("n"), *totals)
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in sorted(grouped.collect(), key=lambda r: r["block"]):  # as many rows as the codebooks have, whatever the table's size
        held = out.setdefault((r["part"], r["entry"]), (r["n"], []))
        held[1].extend(int(x) for x in r[4:] if x is not None)
    return out


def train(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> tuple[int, list[np.ndarray]]:
    """The length that is coded and each part's codebook.

    A codebook begins as the parts of the vectors of the least vec_ids (rows without one come
    last, equal vec_ids by their vectors). The first of these sets the length.
    """
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = vectors.orderBy(*order).select("v").limit(1).collect()
    if not first:
        return 0, []
    length = len(first[0][0])
    seeds = [r[0] for r in vectors.where(F.size("v") == length).orderBy(*order).select("v").limit(entries).collect()]
    whole, at = np.array(seeds, np.int64).reshape(len(seeds), length), cuts(length, parts)
    books = [whole[:, a:b].copy() for a, b in zip(at[:-1], at[1:], strict=True)]
    for _ in range(rounds):
        for (p, e), (n, total) in part_sums(vectors, books, length).items():
            books[p][e] = [s // n for s in total]
    return length, books


def encode(vectors: DataFrame, length: int, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code and error of each vector; the last two null where the length is another."""
    at = cuts(length, max(len(books), 1))
    shape = T.StructType([*(vectors.schema[c] for c in ("vec_id", "label")), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Codebook(b) for b in books]
        for batch in batches:
            where, rows = matrix(batch.column(2), length)
            code, error = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            text, total = np.full(len(where), "", object), np.zeros(len(where), object)
            for p, book in enumerate(found):
                c, d = book.nearest(rows[:, at[p] : at[p + 1]])
                text = text + np.array([f"{x:02x}" for x in c.tolist()], object) if len(c) else text
                total = total + d.astype(object)
            code[where], error[where] = text, np.minimum(total, MOST) if len(where) else total
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code.tolist(), pa.string()), pa.array(error.tolist(), pa.int64())], ["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "v").mapInArrow(run, shape)


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded with label_error: the sum of error over its label's rows, nulls being one label.

    Sums are combined before the shuffle. Labels of many rows, of which there cannot be many, are
    joined by a broadcast, so that no join gathers them; the others too if their table is small.
    """
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(F.count("*").alias("rows"), F.when(total > MOST, F.lit(MOST)).otherwise(total.cast("long")).alias("label_error"))
    sums = materialize(sums.select(F.col("label").alias("of"), "rows", "label_error"), "label-sums")
    same = F.col("label").eqNullSafe(F.col("of"))
    if stored_bytes(sums) <= BROADCAST_BYTES:
        return coded.join(F.broadcast(sums), same).drop("of", "rows")
    least = (coded.count() * HOT_SHARE) + 1
    hot = sums.where(F.col("rows") >= least).select("of", F.col("label_error").alias("hot_error"), F.lit(True).alias("is_hot"))
    marked = coded.join(F.broadcast(hot), same, "left").drop("of")
    rest = marked.where(F.col("is_hot").isNull()).drop("hot_error").join(sums.where(F.col("rows") < least), same)
    out = ["vec_id", "label", "code", "error", "label_error"]
    return marked.where("is_hot").withColumnRenamed("hot_error", "label_error").select(*out).unionByName(rest.select(*out))


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def vector_codes(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each row with a usable vector.

    Rows whose vector is null or holds null, NaN or infinity take no part. Repeated rows and
    vec_ids keep a row each and count as often; a null vec_id is coded, but seeds a codebook only
    if there are not enough others. A vector of another length than that of the least vec_id has a
    null code and error and adds nothing to its label's sum (which is null if no row has an error);
    lengths that cannot be divided by four are cut as evenly as can be. Fewer vectors than entries
    make a smaller codebook. Whole numbers, errors and sums beyond a long are cut off at its ends.
    Further columns are not read; an empty table gives an empty result. The driver holds the
    codebooks alone.
    """
    vectors = materialize(whole_vectors(embeddings, SCALE), "vectors")
    length, books = train(vectors)
    coded = materialize(encode(vectors, length, books), "codes")
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
