"""Operator 1: best-fit packing of token sequences by exact-complement hashing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeline.llm.common import materialize, salts
from tapeline.llm.words import encoder

#: Ends a document; it counts as one of its tokens.
END_ID = 1


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, length, ids_crc32.

    A null or empty text has the end id alone. Only documents longer than capacity are cut, into
    pieces of capacity tokens; the last may be shorter. Whole texts are encoded where they lie.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


@dataclass
class Plan:
    """Which ranks of which length go where: parallel arrays sorted by (length, first rank)."""

    length: np.ndarray
    first: np.ndarray  # rank, among the items of that length, of the slot's first item
    repeat: np.ndarray  # items of this length in each sequence of the slot's pattern
    sequence: np.ndarray  # number of the pattern's first sequence
    offset: np.ndarray  # place of the slot's first item in its sequence
    sequences: int


def fill(counts: dict[int, int], capacity: int) -> Plan:
    """Plan sequences for so many items of each length from 1 to capacity.

    The longest length left opens a sequence. Its gap is looked up in the index of sums: a single
    length, then a pair, then a triple of lengths that are left in sufficient number and fill it
    exactly. If none does, the longest length that fits (the best fit) goes in and the smaller gap
    is looked up in turn. What was found is consumed as often as the counts allow, so each pattern
    uses up a length: there are at most `capacity` patterns, each with fewer than
    sqrt(2 * capacity) + 1 lengths, whatever the number of items. The plan has that proven bound.
    """
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    there = left > 0
    there[0] = False
    # Ordered pairs and triples of lengths left, by their sum. Lengths go in and out one by one.
    known = np.zeros(capacity + 1, bool)
    pairs, triples = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)

    def put(n: int, sign: int) -> None:
        """Add (sign 1) a length to the indexes of sums, or take it out (-1)."""
        if sign < 0:
            known[n] = False
            pairs[n:] -= 2 * known[: capacity + 1 - n]  # with each other length, in both orders
            if 2 * n <= capacity:
                pairs[2 * n] -= 1  # with itself
        triples[n:] += sign * 3 * pairs[: capacity + 1 - n]  # once, with two others
        if 2 * n <= capacity:
            triples[2 * n :] += sign * 3 * known[: capacity + 1 - 2 * n]  # twice, with one other
        if 3 * n <= capacity:
            triples[3 * n] += sign
        if sign > 0:
            pairs[n:] += 2 * known[: capacity + 1 - n]
            if 2 * n <= capacity:
                pairs[2 * n] += 1
            known[n] = True

    for x in np.flatnonzero(there):
        put(int(x), 1)

    def two(gap: int, used: dict[int, int]) -> tuple[int, ...] | None:
        """The pair with the longest member that fills gap and is left once more."""
        if not pairs[gap]:
            return None
        x = np.arange(gap - 1, (gap - 1) // 2, -1)
        for a in x[there[x] & there[gap - x]]:
            if fits({int(a): 1}, used, int(gap - a)):
                return int(a), int(gap - a)
        return None

    def fits(more: dict[int, int], used: dict[int, int], *also: int) -> bool:
        need = dict(used)
        for n in also:
            need[n] = need.get(n, 0) + 1
        for n, c in more.items():
            need[n] = need.get(n, 0) + c
        return all(left[n] >= c for n, c in need.items())

    def exact(gap: int, used: dict[int, int]) -> tuple[int, ...] | None:
        if there[gap] and fits({}, used, gap):
            return (gap,)
        if pair := two(gap, used):
            return pair
        if not triples[gap]:
            return None
        z = np.arange(gap - 2, 0, -1)
        for c in z[there[z] & (pairs[gap - z] > 0)]:
            plus = dict(used)
            plus[int(c)] = plus.get(int(c), 0) + 1
            if left[c] >= plus[int(c)] and (pair := two(int(gap - c), plus)):
                return (int(c), *pair)
        return None

    slots: list[tuple[int, int, int, int, int]] = []
    taken = np.zeros(capacity + 1, np.int64)
    sequences = 0
    top = capacity
    while top > 0:
        if not there[top]:
            top -= 1
            continue
        used = {top: 1}
        gap = capacity - top
        while gap > 0:
            if found := exact(gap, used):
                for n in found:
                    used[n] = used.get(n, 0) + 1
                gap = 0
                break
            fit = np.flatnonzero(there[1 : gap + 1])[::-1] + 1
            best = next((int(n) for n in fit if left[n] > used.get(int(n), 0)), 0)
            if not best:
                break
            used[best] = used.get(best, 0) + 1
            gap -= best
        times = min(int(left[n]) // c for n, c in used.items())
        offset = 0
        for n in sorted(used, reverse=True):
            slots.append((n, int(taken[n]), used[n], sequences, offset))
            offset += n * used[n]
            taken[n] += used[n] * times
            left[n] -= used[n] * times
            if not left[n]:
                there[n] = False
                put(n, -1)
        sequences += times
    slots.sort()
    cols = [np.array(c, np.int64) for c in zip(*slots, strict=True)] or [np.zeros(0, np.int64)] * 5
    return Plan(*cols, sequences)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to pieces with columns doc_id, piece, length (1 to capacity).

    Only the count of each length reaches the driver (at most `capacity` rows), where fill() plans
    sequences for all items of a length at once; the plan, whose size is bounded by the capacity
    alone, is sent to the tasks. A piece's rank among those of its length comes from its rank in a
    salted part of that length plus the sizes of the parts before, so a length that a third of all
    rows share is spread over many tasks. The salt is the turn in which rows come, which is why it
    is written with them first: it deals out repeated rows as evenly as any. Repeated rows get
    places of their own; which of them gets which is left open. An empty table gives an empty
    result.
    """
    spark = pieces.sparkSession
    extra = [c for c in pieces.columns if c not in ("doc_id", "piece", "length")]
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(salts(spark))).cast("int")
    salted = materialize(pieces.withColumn("_salt", turn), "pieces")
    counts = {r["length"]: r["n"] for r in salted.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(fill(counts, capacity))
    parts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", *extra)
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(parts, ["length", "_salt"])
    ranked = ranked.select("doc_id", "piece", "length", *extra, (F.col("_rank") + F.col("_before")).alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        wide = np.int64(1) << 40
        keys = p.length * wide + p.first
        for b in batches:
            t = pa.table(b)
            length, rank = t["length"].to_numpy(), t["_rank"].to_numpy()
            at = np.searchsorted(keys, length * wide + rank, side="right") - 1
            k = rank - p.first[at]
            t = t.drop_columns(["_rank"])
            t = t.append_column("sequence_id", pa.array(p.sequence[at] + k // p.repeat[at], pa.int64()))
            t = t.append_column("offset", pa.array(p.offset[at] + k % p.repeat[at] * length, pa.int64()))
            yield from t.to_batches()

    kept = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in ranked.columns if c != "_rank")
    return ranked.mapInArrow(run, f"{kept}, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = END_ID) -> DataFrame:
    """Encode documents, cut the long ones and pack all pieces into sequences of capacity tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row for each piece.
    Null texts count as empty (the end id alone); a null doc_id stays null; further columns of
    docs are not read. An empty table gives an empty result.
    """
    return pack(token_pieces(docs, tokenizer, capacity, end_id), capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
