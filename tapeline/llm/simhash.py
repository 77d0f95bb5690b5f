"""Operator 7: SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import components, materialize, small, unpacked, with_row

#: Words of a shingle; the seed of its XXH64.
SHINGLE, SEED = 4, 42
#: A bucket of more fingerprints is split by a second family of masks.
BUCKET = 2048


def fingerprint(text: str) -> int:
    """The unsigned 64-bit fingerprint of a text; 0 without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        flat = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        h = xxhash.xxh64_intdigest
        hashes = [h(flat[a:b], SEED) for a, b in zip(starts[: -SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        part = np.array(hashes[k : k + 65_536], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text) and the fingerprint of each whole text as a signed long; a
    null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(t.as_py() or "") for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got.view(np.int64))], ["doc_id", "row", "fp"])

    text = F.col("text").cast("string")
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"))
    return picked.mapInArrow(run, "doc_id long, row long, fp long")


def covering_masks(bits: list[int], radius: int, seed: int) -> list[int]:
    """Masks over the given bit places such that each pair that differs in at most radius of them
    agrees on all bits of some mask.

    Each place gets a vector of radius + 1 bits; there is a mask for each non-zero vector v, of the
    places whose vector has an odd product with v. The vectors of the places where a pair differs
    span at most radius dimensions, so some v is orthogonal to all of them, and v's mask has none
    of these places. The vectors are dealt evenly, which makes all masks about half of the bits.
    """
    vectors = [1 + k % (2 ** (radius + 1) - 1) for k in range(len(bits))]
    random.Random(seed).shuffle(vectors)
    return [
        sum(1 << b for b, x in zip(bits, vectors, strict=True) if (x & v).bit_count() % 2)
        for v in range(1, 2 ** (radius + 1))
    ]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fps: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Edges from each fingerprint to the first of its component, links being distances within radius.

    A search that only ever compares with what is not reached yet: in a dense group the first few
    steps reach nearly all, so the work is not the square of its size.
    """
    left, a, b = fps, [], []
    while len(left) > 1:
        root, front, left = left[0], [left[0]], left[1:]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= radius
            if near.any():
                got = left[near]
                front.extend(got)
                a += got.view(np.int64).tolist()
                b += [int(root.view(np.int64))] * len(got)
                left = left[~near]
    return a, b


def _runs(radius: int, limit: int | None):
    """A mapInArrow function over rows (bucket..., fp) sorted by bucket and fp.

    Emits forest edges of each bucket's fingerprints; those of a bucket with more than limit go on
    as rows with b null, to be split. Memory holds one bucket of at most limit fingerprints.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["mask", "a", "b"]

        def emit(mask, a, b):
            n = len(a)
            return pa.RecordBatch.from_arrays([pa.array([mask] * n, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names)

        key, held, count = None, [], 0

        def closed():
            if key is not None and 1 < count and (limit is None or count <= limit):
                a, b = forest(np.concatenate(held), radius)
                if a:
                    yield emit(None, a, b)

        for batch in batches:
            keys = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]
            fps = batch.columns[-1].to_numpy().view(np.uint64)
            new = np.zeros(len(fps), bool)
            for c in keys:
                new[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(new).tolist(), len(fps)] if len(fps) else [0]
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                here = tuple(int(c[s]) for c in keys)
                if here != key:
                    yield from closed()
                    key, held, count = here, [], 0
                part = fps[s:e].copy()
                if limit is not None and count + len(part) > limit:
                    for x in [*held, part]:
                        yield emit(key[0], x.view(np.int64).tolist(), [None] * len(x))
                    held = []
                else:
                    held.append(part)
                count += len(part)
        yield from closed()

    return run


def links(distinct: DataFrame, radius: int, limit: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all
    pairs within radius. Every such pair collides under some mask, and each bucket keeps a
    spanning forest of its links.

    A bucket of more than limit fingerprints is not compared as one: its fingerprints agree on the
    mask's bits, so a second family of masks over all other bits splits it, again losing no pair.
    What then still falls together agrees on about three quarters of the 64 bits, which bounds a
    bucket, by the number of other bits, whatever the input's size.
    """
    masks = covering_masks(list(range(64)), radius, 1)
    rows = distinct.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in enumerate(masks)])).alias("m"), "fp"
    ).select("m.mask", "m.key", "fp")
    shape = "mask int, a long, b long"
    first = materialize(rows.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_runs(radius, limit), shape), "covering")
    edges = first.where("b is not null").select("a", "b")
    hot = first.where("b is null").select("mask", F.col("a").alias("fp"))
    if hot.isEmpty():
        return edges
    again = []
    for k, m in enumerate(masks):
        rest = covering_masks([i for i in range(64) if not m >> i & 1], radius, 2)
        again.append(F.array(*[F.struct(F.lit(j).alias("sub"), F.col("fp").bitwiseAND(F.lit(signed(m | r))).alias("key")) for j, r in enumerate(rest)]))
    split = hot.withColumn("m", F.explode(F.element_at(F.array(*again), F.col("mask") + 1))).select("mask", "m.sub", "m.key", "fp")
    second = split.repartition("mask", "sub", "key").sortWithinPartitions("mask", "sub", "key", "fp").mapInArrow(_runs(radius, None), shape)
    return edges.union(materialize(second, "covering").select("a", "b"))


def grouped(docs: DataFrame, radius: int) -> DataFrame:
    """doc_id, row, fp, root (a fingerprint that names the component) and component_id of each row."""
    prints = materialize(fingerprints(docs), "prints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct, radius), "simhash")
    linked = distinct.join(small(roots).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = materialize(linked, "rooted")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = materialize(linked.join(least, "root").select("fp", "root", "component_id"), "by-fp")
    return prints.join(small(by_fp), "fp")


def near_duplicates(docs: DataFrame, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of each row.

    Links join fingerprints that differ in at most radius bits; equal fingerprints fall together
    first, so copies cost nothing more. Null and empty texts have the fingerprint zero and are
    linked like any other. A null doc_id takes part but is no component_id unless its component
    has no other. Repeated rows stay. Further columns are not read; an empty table gives an empty
    result. Fingerprints, links and components stay distributed.
    """
    return grouped(docs, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, radius: int = 4) -> DataFrame:
    """The documents of docs that stay when of each component only the first does.

    The first is the smallest doc_id's (a null one comes last); of different texts under it, the
    one with the least hash. A text under the same doc_id in another component is another document
    and stays or goes with that. Equal rows are one document and stay or go together.
    """
    packed = with_row(docs)
    found = materialize(grouped(packed.select("doc_id", "text"), radius).select("doc_id", "row", "root", "component_id"), "components")
    many = found.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    many = found.join(small(materialize(many, "shared-roots")), "root", "left_semi")
    first = many.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("row").alias("first"))
    later = many.join(small(materialize(first, "first-rows")), "root").where(~F.col("doc_id").eqNullSafe(F.col("component_id")) | (F.col("row") != F.col("first")))
    gone = materialize(later.select(F.col("doc_id").alias("of"), F.col("row").alias("gone")).distinct(), "gone")
    same = (F.col("row") == F.col("gone")) & F.col("doc_id").eqNullSafe(F.col("of"))
    return unpacked(packed.join(small(gone), same, "left_anti"), docs)
