"""Operator 11: a Jaccard join of shingle sets by vertical partitioning.

Shingles are put into a global order, rarest first, which is cut into fragments; each document's
set falls into a segment for each fragment. Pairs are counted fragment by fragment, each partial
overlap apart, and the partial overlaps are summed per pair.

What is counted is kept small without losing a link:

* Equal sets are one class, and classes are joined instead of documents.
* A set can only have a link if nine tenths of its shingles are in other sets too (shared()). All
  other sets leave before anything is ordered.
* Linked sets share a shingle among the first tenth (and one) of each (the prefix). Of the sets
  that meet at a shingle, each is first compared with one, the pivot; then only sets that are not
  in one component yet are compared. So a dense group makes as many pairs as it has sets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import components, materialize, small
from tapeline.llm.ngram_dictionary import unzip_bytes, zip_bytes

#: Words of a shingle; two sets link from this many hundredths of their union on.
SHINGLE, PERCENT = 3, 90
#: Words whose shingles are made at once, and shingles of a block that is sent to the parts.
WORDS = 1 << 20
#: Shingles that a part of the first count has on average.
PART = 4 << 20
#: Fragments of the global order.
FRAGMENTS = 8
#: Longs of a set's parity bits: bit k is set if an odd number of its shingles fall on k. Two sets' bits
#: differ in no more places than the sets do in shingles.
LONGS = 8

GAP = re.compile(rb"[\x20\x09-\x0d]")
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _C3
    return x ^ (x >> np.uint64(29))


def keys_of(words: list[bytes], ends: list[int], lead: list[int]) -> np.ndarray:
    """A 64-bit key of each shingle of some pieces of texts, by the position of its last word; pieces of
    fewer words have one key at their last. Keys of a lead, words that were there before, are 0."""
    import xxhash

    coded = pa.array(words, pa.binary()).dictionary_encode()
    known = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    h = known[coded.indices.to_numpy()]
    ends, lead = np.asarray(ends, np.int64), np.asarray(lead, np.int64)
    starts = np.append(0, ends[:-1])
    doc = np.repeat(np.arange(len(ends)), ends - starts)
    place = np.arange(len(h)) - starts[doc]
    # The position counts the words of the key, so that runs of different lengths differ.
    key = _mix(h + _C1)
    for k in range(1, SHINGLE):
        before = np.zeros(len(h), np.uint64)
        before[k:] = h[:-k]
        key = np.where(place >= k, _mix(key * _C2 + before + np.uint64(k)), key)
    full = place >= SHINGLE - 1
    short = (place == ends[doc] - starts[doc] - 1) & (place < SHINGLE - 1)
    key[~(full | short) | (place < lead[doc])] = 0
    return key


def slices(text: str) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text, A-Z in lower case, a bounded number of bytes at a time, and how many of them
    were there before. Only a text that is all in one part has a part of fewer words than a shingle."""
    data, at, held, before = text.encode("utf-8", "surrogatepass").lower(), 0, [], 0
    while True:
        end = len(data)
        if end - at > 8 * WORDS:
            gap = GAP.search(data, at + 8 * WORDS)
            end = gap.start() if gap else end
        held += data[at:end].split()
        at = end
        if at == len(data):
            break
        if len(held) >= SHINGLE:
            yield held, before
            held = held[-(SHINGLE - 1) :]
            before = len(held)
    yield held, before


def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Rows (all columns but the last, which is the text) and each one's distinct shingle keys in ascending order."""
    rows: list[tuple] = []
    words: list[bytes] = []
    ends: list[int] = []
    lead: list[int] = []
    of: list[int] = []
    parts: dict[int, list[np.ndarray]] = {}

    def count() -> None:
        key, at = keys_of(words, ends, lead), 0
        for row, end in zip(of, ends, strict=True):
            got = key[at:end]
            parts.setdefault(row, []).append(np.unique(got[got != 0]))
            at = end
        for held in (words, ends, lead, of):
            held.clear()

    def out() -> tuple[list, list[np.ndarray]]:
        count()
        got = [parts[k][0] if len(parts[k]) == 1 else np.unique(np.concatenate(parts[k])) for k in range(len(rows))]
        done = (list(rows), got)
        rows.clear()
        parts.clear()
        return done

    total = 0
    for batch in batches:
        for *own, text in zip(*(c.to_pylist() for c in batch.columns[:-1]), batch.columns[-1], strict=True):
            for piece, before in slices(text.as_py() or ""):
                if before and len(piece) - before <= 0:
                    continue
                # A piece behind another only adds whole shingles.
                words += piece
                total += len(piece)
                ends.append(len(words))
                lead.append(before)
                of.append(len(rows))
                if len(words) >= WORDS:
                    count()
            rows.append(tuple(own))
            if total >= WORDS or len(rows) >= 1 << 15:
                yield out()
                total = 0
    if rows:
        yield out()


def class_of(keys: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two longs."""
    import xxhash

    d = xxhash.xxh3_128_digest(keys.astype("<u8").tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def with_class(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text), n (size of the set) and c1, c2 (its class) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in sets(batches):
            ids, row = zip(*rows, strict=True)
            c1, c2 = zip(*map(class_of, found), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(row, pa.int64()), pa.array(list(map(len, found)), pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64())],
                ["doc_id", "row", "n", "c1", "c2"],
            )

    return docs.select("doc_id", "row", "text").mapInArrow(run, "doc_id long, row long, n long, c1 long, c2 long")


def _planes(x: np.ndarray) -> bytes:
    width = x.dtype.itemsize
    return zip_bytes(np.ascontiguousarray(x.view(np.uint8).reshape(-1, width).T).tobytes())


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(unzip_bytes(data), np.uint8).reshape(width, -1).T).view(kind).ravel()


def different(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of pairs of longs in ascending order, and the place of each row among them."""
    order = np.lexsort((names[:, 1], names[:, 0]))
    new = np.append(True, (names[order[1:]] != names[order[:-1]]).any(axis=1))
    at = np.empty(len(names), np.int64)
    at[order] = np.cumsum(new) - 1
    return names[order[new]], at


def shared(docs: DataFrame, shingles: int) -> DataFrame:
    """c1, c2 and shared: how many of a class's shingles other classes have too (classes with any).

    Some documents' keys go to the parts of the key range as one block each: sorted, as differences,
    with the document of each. Keys are cut to as many bits as tell the corpus's shingles apart but
    for one in thousands; a shingle may so seem shared, never seem not to be.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shingles // PART))
    drop = max(0, 64 - (max(shingles, 1).bit_length() + 12))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in sets(batches):
            names = np.array([class_of(k) for k in found], np.int64).reshape(-1, 2)
            keys = np.concatenate([np.zeros(0, np.uint64), *found])
            doc = np.repeat(np.arange(len(found), dtype=np.uint16), [len(k) for k in found])
            order = np.argsort(keys, kind="stable")
            keys, doc = keys[order], doc[order]
            part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            stops = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64)).tolist()
            keys = keys >> np.uint64(drop)
            for p, (a, b) in enumerate(zip(stops[:-1], stops[1:], strict=True)):
                if a < b:
                    here, at = np.unique(doc[a:b], return_inverse=True)
                    data = [_planes(np.diff(keys[a:b], prepend=np.uint64(0))), _planes(at.astype("<u2")), names[here].astype("<i8").tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), *(pa.array([d], pa.binary()) for d in data)], ["part", "keys", "doc", "names"])

    def count(table: pa.Table) -> pa.Table:
        keys, doc, names, before = [], [], [], 0
        for k, d, n in zip(*(table[c].to_pylist() for c in ("keys", "doc", "names")), strict=True):
            keys.append(np.cumsum(_unplanes(k, "<u8"), dtype=np.uint64))
            doc.append(_unplanes(d, "<u2").astype(np.int64) + before)
            names.append(np.frombuffer(n, "<i8").reshape(-1, 2))
            before += len(names[-1])
        keys, doc, names = np.concatenate(keys), np.concatenate(doc), np.concatenate(names)
        named, classes = different(names)
        cls = classes[doc]
        order = np.argsort(keys, kind="stable")  # runs that are sorted already
        keys, cls = keys[order], cls[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        many = np.minimum.reduceat(cls, starts) != np.maximum.reduceat(cls, starts)
        lengths = np.diff(np.append(starts, len(keys)))
        run, stay = np.repeat(np.arange(len(starts)), lengths), np.repeat(many, lengths)
        pair = np.unique(run[stay] * len(named) + cls[stay])  # copies of a class count once
        n = np.bincount(pair % len(named), minlength=len(named))
        at = np.flatnonzero(n)
        # What the parts have of a class is added up by ranges of classes, a block for each part and range.
        place = ((named[at, 0].view(np.uint64) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # ascending but for the sign
        at = at[np.argsort(place, kind="stable")]
        stops = np.searchsorted(np.sort(place), np.arange(parts + 1, dtype=np.uint64)).tolist()
        out = [(p, named[at[a:b]].astype("<i8").tobytes(), _planes(n[at[a:b]].astype("<u4"))) for p, (a, b) in enumerate(zip(stops[:-1], stops[1:], strict=True)) if a < b]
        shape = pa.schema([("place", pa.int64()), ("names", pa.binary()), ("shared", pa.binary())])
        return pa.Table.from_pylist([dict(zip(shape.names, r, strict=True)) for r in out], shape)

    def add(table: pa.Table) -> pa.Table:
        names = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in table["names"].to_pylist()])
        n = np.concatenate([_unplanes(x, "<u4") for x in table["shared"].to_pylist()])
        named, classes = different(names)
        total = np.bincount(classes, weights=n).astype(np.int64)
        return pa.table({"c1": named[:, 0].copy(), "c2": named[:, 1].copy(), "shared": total})

    blocks = docs.select("text").mapInArrow(send, "part long, keys binary, doc binary, names binary")
    found = blocks.groupBy("part").applyInArrow(count, "place long, names binary, shared binary")
    return found.groupBy("place").applyInArrow(add, "c1 long, c2 long, shared long")


def keyed(docs: DataFrame) -> DataFrame:
    """c1, c2, n, keys and parity bits of each row's set."""

    def parity(keys: np.ndarray) -> np.ndarray:
        odd = np.bincount((keys >> np.uint64(20)).astype(np.int64) % (64 * LONGS), minlength=64 * LONGS) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in sets(batches):
            for a in range(0, len(found), 512):
                part = found[a : a + 512]
                c1, c2 = zip(*map(class_of, part), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array([len(k) for k in part], pa.int64()), pa.array([k.view(np.int64) for k in part], pa.list_(pa.int64())), pa.array([parity(k) for k in part], pa.list_(pa.int64()))],
                    ["c1", "c2", "n", "keys", "bits"],
                )

    return docs.select("text").mapInArrow(run, "c1 long, c2 long, n long, keys array<long>, bits array<long>")


def pivots(ordered: DataFrame, fragments: int) -> list[tuple[int, int]]:
    """Where the global order (frequency, key) is cut so that fragments hold about equally many shingles."""
    tokens = ordered.select(F.explode("seq.df").alias("df"))
    at = tokens.agg(F.percentile_approx("df", [k / fragments for k in range(1, fragments)], 1000)).first()[0] or []
    out = []
    for df in sorted(set(at)):
        m = at.count(df)  # one frequency is cut by its keys, which are spread evenly
        out += [(df, -(2**63) + 2**64 * j // (m + 1)) for j in range(1, m + 1)]
    return out


def fragment_of(e: Column, cuts: list[tuple[int, int]]) -> Column:
    """The number of cuts at or before a shingle."""
    n = F.lit(0)
    for df, k in cuts:
        n = n + F.when((e["df"] > df) | ((e["df"] == df) & (e["k"] >= k)), 1).otherwise(0)
    return n


def segments(ordered: DataFrame, fragments: int) -> DataFrame:
    """id, fragment and ks: a set's shared shingles within each fragment of the global order."""
    cuts = pivots(ordered, fragments)
    marked = ordered.select("id", F.transform("seq", lambda e: F.struct(fragment_of(e, cuts).alias("f"), e["k"].alias("k"))).alias("seq"))

    def segment(f: int) -> Column:
        inside = F.filter("seq", lambda e: e["f"] == f)
        return F.struct(F.lit(f).alias("fragment"), F.transform(inside, lambda e: e["k"]).alias("ks"))

    by = F.explode(F.array(*[segment(f) for f in range(len(cuts) + 1)]))
    return marked.select("id", by.alias("s")).select("id", "s.fragment", "s.ks").where(F.size("ks") > 0)


def verified(pairs: DataFrame, segs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose partial overlaps sum up to a link."""
    left = segs.select(F.col("id").alias("a"), "fragment", F.col("ks").alias("ka"))
    right = segs.select(F.col("id").alias("b"), "fragment", F.col("ks").alias("kb"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ka", "kb")).cast("long").alias("both"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("both").alias("both"))
    return total.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def alike(a: str, b: str, percent: int) -> Column:
    """Whether sets of such sizes can link."""
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def apart(a: str, b: str, percent: int) -> Column:
    """Whether the parity bits of two sets (structs of columns n and bits) rule a link out."""
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    least = F.floor((percent * both + 99 + percent) / (100 + percent))  # what a link needs in common
    differ = sum((F.bit_count(F.col(f"{a}.b{k}").bitwiseXOR(F.col(f"{b}.b{k}"))) for k in range(LONGS)), F.lit(0))
    return differ > both - 2 * least


def links(members: DataFrame, percent: int = PERCENT, fragments: int = FRAGMENTS) -> DataFrame:
    """Edges (a, b) between members (id, n, keys, bits) whose components are those of all links."""
    tokens = members.select("id", "n", F.explode("keys").alias("k"))
    df = tokens.groupBy("k").agg(F.count("*").alias("df")).where("df > 1")
    seq = F.sort_array(F.collect_list(F.struct("df", "k"))).alias("seq")  # one set's own shingles
    ordered = materialize(tokens.join(df, "k").groupBy("id").agg(F.first("n").alias("n"), seq), "ordered")
    segs = materialize(segments(ordered, fragments), "segments")
    lone = F.col("n") - F.size("seq")
    head = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1  # the prefix, its unshared shingles first
    first = ordered.withColumn("lone", lone).withColumn("head", head.cast("int")).where("head > lone")
    first = first.select("id", "n", "lone", F.posexplode(F.slice("seq", F.lit(1), (F.col("head") - F.col("lone")).cast("int"))).alias("place", "e"))
    first = materialize(first.select("id", "n", F.col("e.k").alias("k"), (F.col("place") + F.col("lone")).alias("place"), F.floor(1000 * F.col("lone") / F.col("n")).alias("rank")), "prefixes")
    # Each set against the pivot of its shingles that comes first: the one with the fewest shingles of its own.
    best = first.groupBy("k").agg(F.min(F.struct("rank", F.col("id").alias("b"), F.col("n").alias("nb"))).alias("p"), F.count("*").alias("m")).where("m > 1").select("k", "p")
    met = first.join(best, "k").where((F.col("id") != F.col("p.b")) & alike("n", "p.nb", percent))
    pairs = met.groupBy(F.col("id").alias("a"), F.col("n").alias("na")).agg(F.min("p").alias("p")).select("a", "na", F.col("p.b").alias("b"), F.col("p.nb").alias("nb"))
    one = materialize(verified(materialize(pairs, "pairs"), segs, percent), "links")
    roots = components(one, "jaccard")
    # What is still apart where it meets: all but the largest component's sets against all.
    at = materialize(first.drop("rank").join(small(roots).withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("root", "id")).drop("root"), "placed")
    sizes = at.groupBy("k", "comp").agg(F.count("*").alias("m")).groupBy("k").agg(F.max(F.struct("m", "comp")).alias("top"), F.count("*").alias("apart"))
    sizes = materialize(sizes.where("apart > 1").select("k", F.col("top.comp").alias("top")), "apart")
    bits = members.select("id", *[F.get("bits", F.lit(k)).alias(f"b{k}") for k in range(LONGS)])
    rest = materialize(at.join(small(sizes), "k").join(bits, "id"), "rest")
    one_of = F.struct("id", "n", "place", "comp", *[f"b{k}" for k in range(LONGS)])
    minor = rest.where("comp <> top").select("k", one_of.alias("x"))
    other = rest.select("k", "top", one_of.alias("y"))
    most = F.least("x.place", "y.place") + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))  # what can still be common
    met = (F.col("x.comp") != F.col("y.comp")) & ((F.col("y.comp") == F.col("top")) | (F.col("x.id") < F.col("y.id"))) & alike("x.n", "y.n", percent)
    met = met & (100 * most >= percent * (F.col("x.n") + F.col("y.n") - most)) & ~apart("x", "y", percent)
    cross = minor.join(other, "k").where(met).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).distinct()
    two = materialize(verified(materialize(cross, "pairs"), segs, percent), "links")
    return one.union(two)


def jaccard_join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and class_size of each row.

    A document's set has its distinct three-word shingles (with fewer words the whole sequence);
    documents link when the intersection has percent hundredths of the union. component_id is the
    smallest doc_id that links reach, class_size the number of rows with an equal set. Null texts
    and texts without words have an empty set and are linked with nothing, not with each other
    either. A null doc_id takes part but is no component_id unless its component has no other.
    Repeated rows stay and link with each other. Shingles are told apart by 64-bit hashes, sets
    that are equal by 128 bits. Further columns are not read; an empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    rows = materialize(with_class(picked), "sets")
    classes = rows.where("n > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"), F.min("n").alias("n"), F.min(F.struct("doc_id", "row")).alias("own"))
    classes = materialize(classes, "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    able = classes.join(materialize(shared(picked, total), "shared"), ["c1", "c2"]).where(100 * F.col("shared") >= percent * F.col("n"))
    able = materialize(able.select(F.col("own.doc_id").alias("of"), F.col("own.row").alias("own_row")).distinct(), "able")
    chosen = picked.join(small(able), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("own_row")), "left_semi")
    members = materialize(keyed(chosen).dropDuplicates(["c1", "c2"]).withColumn("id", F.monotonically_increasing_id()), "members")
    roots = components(links(members, percent), "jaccard")
    linked = members.select("c1", "c2", "id").join(small(roots).withColumnRenamed("node", "id"), "id").select("c1", "c2", "root")
    named = materialize(classes.join(small(materialize(linked, "linked")), ["c1", "c2"], "left").where("rows > 1 or root is not null").select("c1", "c2", "rows", "least", "root"), "named")
    group = named.where("root is not null").groupBy("root").agg(F.min("least").alias("first"))
    named = named.join(small(materialize(group, "groups")), "root", "left").select("c1", "c2", F.col("rows").alias("class_size"), F.coalesce("first", "least").alias("component_id"))
    out = rows.join(small(materialize(named, "named")), ["c1", "c2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))
