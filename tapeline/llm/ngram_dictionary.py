"""A dictionary of the distinct n-grams of a corpus, and the way of its answers back to documents.

chunked() turns texts into chunks: the distinct words and the sequence of words of some documents,
written once. Each chunk sends every distinct run of one to three words that it holds, with its
count there, to the part of the dictionary that the run's first two words belong to (a longer run
travels with its first two words, so these are sent once). A part puts equal strings of all chunks
together, hashes each distinct string once, and answers in the order in which it was asked. So no
n-gram is a row of its own, frequent ones are counted in their chunks before anything moves, and
the answers are two bytes each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import materialize

#: Bytes of text in a chunk (one text of more is cut between words).
CHUNK = 12 << 20
#: Bytes of text whose n-grams one part of the dictionary has on average.
PART = 16 << 20
BUCKETS = 10_000
#: Buckets whose sums are added up together.
SLICE = 100
#: How hard zstd tries.
LEVEL = 6

# Lower case for A-Z only; what separates words becomes a space.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TABLE = bytes(32 if _LOWER[b] < 0x30 or 0x3A <= _LOWER[b] <= 0x60 or 0x7B <= _LOWER[b] <= 0x7F else _LOWER[b] for b in range(256))

CHUNK_SHAPE = "chunk long, bytes long, words binary, ids binary, ends array<int>, lead array<int>, at array<long>, doc_id array<long>"


def joined(values: pa.Array) -> bytes:
    """Strings without line ends as one compressed text."""
    return zip_bytes(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), pa.scalar(b"\n", values.type))[0].as_py() if len(values) else b"")


def split(data: bytes, n: int) -> pa.Array:
    """What joined() joined."""
    if not n:
        return pa.array([], pa.binary())
    flat = np.frombuffer(unzip_bytes(data), np.uint8)
    stops = np.append(np.flatnonzero(flat == 10), len(flat))
    offsets = np.append(0, stops - np.arange(len(stops))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(flat[flat != 10])])


def hashes(values: pa.Array) -> np.ndarray:
    out = np.empty(len(values), np.int64)
    for k in range(0, len(values), 1 << 16):  # Python holds one slice's strings
        out[k : k + (1 << 16)] = np.fromiter(map(zlib.crc32, values.slice(k, 1 << 16).to_numpy(zero_copy_only=False)), np.int64)
    return out


def zip_bytes(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True) + len(data).to_bytes(8, "little")


def unzip_bytes(data: bytes) -> bytes:
    return pa.decompress(data[:-8], int.from_bytes(data[-8:], "little"), "zstd", asbytes=True)


def zip_numbers(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers below 2^32; their first, second, ... bytes lie together, which compresses well."""
    width = np.dtype(kind).itemsize
    return zip_bytes(np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, width).T).tobytes())


def unzip_numbers(data: bytes, kind: str = "<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(unzip_bytes(data), np.uint8).reshape(width, -1).T).view(kind).ravel().astype(np.int64)


def pieces(text: str) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text, at most about CHUNK bytes at a time, and how many of them were there before."""
    data, at, last = text.encode("utf-8", "surrogatepass").translate(_TABLE), 0, []
    while True:
        end = len(data)
        if end - at > CHUNK:
            gap = data.find(b" ", at + CHUNK)
            end = gap if gap >= 0 else end
        words = data[at:end].split()
        yield last + words, len(last)
        if end == len(data):
            return
        at, last = end, (last + words)[-2:]


def chunked(docs: DataFrame) -> DataFrame:
    """The chunks of docs (columns doc_id, text), written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, row = TaskContext.get().partitionId(), 0, 0
        words: list[bytes] = []
        ends: list[int] = []
        lead: list[int] = []
        at: list[int] = []
        ids: list[int | None] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            coded = pa.array(words, pa.binary()).dictionary_encode()
            # The most frequent words have the lowest numbers, whose upper bytes then compress well.
            order = np.argsort(-np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)), kind="stable")
            seq = ranks(order)[coded.indices.to_numpy()]
            got = [(task << 33) + made, size, joined(coded.dictionary.take(pa.array(order))), zip_numbers(seq), list(ends), list(lead), list(at), list(ids)]
            shape = pa.schema([("chunk", pa.int64()), ("bytes", pa.int64()), ("words", pa.binary()), ("ids", pa.binary()), ("ends", pa.list_(pa.int32())), ("lead", pa.list_(pa.int32())), ("at", pa.list_(pa.int64())), ("doc_id", pa.list_(pa.int64()))])
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(got, shape, strict=True)], schema=shape)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for part, before in pieces(text.as_py() or ""):
                    words += part
                    size += sum(map(len, part)) + len(part)
                    ends.append(len(words))
                    lead.append(before)
                    at.append((task << 33) + row)
                    ids.append(doc_id)
                    if size >= CHUNK or len(ends) >= 1 << 16:
                        yield chunk()
                        made, size = made + 1, 0
                        for held in (words, ends, lead, at, ids):
                            held.clear()
                row += 1
        if ends:
            yield chunk()

    return materialize(docs.mapInArrow(run, CHUNK_SHAPE), "chunks")


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in ascending order, and the place of each key among them."""
    order = np.argsort(keys).astype(np.int32)
    keys = keys[order]
    new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    at = np.empty(len(keys), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    return keys[new], at


def ranks(order: np.ndarray) -> np.ndarray:
    """The place of each thing, where order lists the things by their places."""
    out = np.empty(len(order), np.int32)
    out[order] = np.arange(len(order), dtype=np.int32)
    return out


class Grams:
    """The distinct runs of one, two and three words of a chunk, and where each occurrence is.

    A run of three is a run of two and a word, numbered by these; all are in ascending order of
    their words.
    """

    def __init__(self, words: bytes, ids: bytes, ends: list[int], lead: list[int]):
        one = unzip_numbers(ids).astype(np.int32)
        vocabulary = int(one.max(initial=-1)) + 1
        known = split(words, vocabulary)
        order = pc.sort_indices(known)
        self.words, one = known.take(order), ranks(order.to_numpy())[one]
        del known, order
        n, ends = len(one), np.asarray(ends, np.int32)
        starts = np.append(0, ends[:-1]).astype(np.int32)
        self.doc = np.repeat(np.arange(len(ends), dtype=np.int32), ends - starts)
        place = np.arange(n, dtype=np.int32) - starts[self.doc]
        fresh = place >= np.asarray(lead, np.int32)[self.doc]
        self.ends = [np.flatnonzero(fresh & (place >= k)).astype(np.int32) for k in range(3)]  # where runs of k + 1 words end
        behind = place[1:] >= 1
        del place, fresh
        # Runs of two are numbered wherever they end, since those in a lead may begin runs of three.
        pair = np.zeros(n, np.int32)
        self.pairs, pair[1:][behind] = distinct((one[:-1].astype(np.int64) * vocabulary + one[1:])[behind])
        self.triples, three = distinct(pair[self.ends[2] - 1].astype(np.int64) * vocabulary + one[self.ends[2]])
        self.vocabulary = vocabulary
        self.occurrences = [one[self.ends[0]], pair[self.ends[1]], three]
        self.counts = [np.bincount(o, minlength=m) for o, m in zip(self.occurrences, (vocabulary, len(self.pairs), len(self.triples)), strict=True)]

    def routes(self, parts: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each part of the dictionary which words, runs of two and of three it is asked for."""
        h = hashes(self.words).astype(np.uint64)
        mixed = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)
        one = mixed(h).astype(np.int32)
        two = mixed(h[self.pairs // max(self.vocabulary, 1)] * np.uint64(0xC2B2AE3D27D4EB4F) + h[self.pairs % max(self.vocabulary, 1)] + np.uint64(1)).astype(np.int32)
        three = two[self.triples // max(self.vocabulary, 1)]
        return list(zip(*[_by_part(x, parts) for x in (one, two, three)], strict=True))

    def asked(self, route: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[list[int], list[bytes]]:
        """What is sent to one part: sizes, and the strings and counts."""
        one, two, three = route
        v = max(self.vocabulary, 1)
        # Runs of two are in the order of their first words, each of which is sent once; runs of three in that of their runs of two.
        first, second = np.divmod(self.pairs[two], v)
        firsts, times = np.unique(first, return_counts=True)
        follow = np.diff(np.searchsorted(self.triples[three] // v, np.append(two, len(self.pairs))))
        spelled = lambda which: joined(self.words.take(pa.array(which)))
        data = [spelled(one), spelled(firsts), zip_numbers(times), spelled(second), zip_numbers(follow), spelled(self.triples[three] % v)]
        return [len(one), len(firsts), len(two), len(three)], [*data, zip_numbers(np.concatenate([c[r] for c, r in zip(self.counts, route, strict=True)]))]


def _by_part(part: np.ndarray, parts: int) -> list[np.ndarray]:
    order = np.argsort(part, kind="stable").astype(np.int32)
    return np.split(order, np.cumsum(np.bincount(part, minlength=parts))[:-1])


def strings(sizes: list[int], data: list[bytes]) -> pa.Array:
    """The n-grams of which asked() sent the parts: words, then runs of two, then of three."""
    space = pa.scalar(b" ", pa.binary())

    def behind(heads: pa.Array, times: bytes, last: pa.Array) -> pa.Array:
        return pc.binary_join_element_wise(heads.take(pa.array(np.repeat(np.arange(len(heads)), unzip_numbers(times)))), last, space)

    one, firsts, second, last = (split(data[k], n) for k, n in zip((0, 1, 3, 5), sizes, strict=True))
    two = behind(firsts, data[2], second)
    return pa.concat_arrays([one, two, behind(two, data[4], last)])


def dictionary(chunks: DataFrame, parts: int) -> DataFrame:
    """The dictionary's answers: rows of (chunk, part, buckets) with the bucket of each n-gram in the
    order of asking, and for each part one with sums, the occurrences in each bucket."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("sizes", pa.list_(pa.int64())), ("data", pa.list_(pa.binary()))])
        for batch in batches:
            for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                g = Grams(r["words"], r["ids"], r["ends"], r["lead"])
                for part, route in enumerate(g.routes(parts)):
                    if any(map(len, route)):
                        sizes, data = g.asked(route)
                        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((part, r["chunk"], sizes, data), shape, strict=True)], schema=shape)

    def answer(table: pa.Table) -> pa.Table:
        asked, counts = [], []
        for block in table.select(["sizes", "data"]).to_batches(max_chunksize=1):
            sizes, data = block.column(0)[0].as_py(), block.column(1)[0].as_py()
            asked.append(strings(sizes, data))
            counts.append(unzip_numbers(data[6]))
        sizes = [len(a) for a in asked]
        known = pa.concat_arrays(asked)
        asked.clear()
        known = known.dictionary_encode()
        at, known = known.indices.to_numpy(), known.dictionary
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(known)).astype(np.int64)
        bucket = hashes(known) % BUCKETS  # each distinct string once
        sums = np.zeros(BUCKETS, np.int64)
        np.add.at(sums, bucket, total)
        got = [zip_numbers(b, "<u2") for b in np.split(bucket[at], np.cumsum(sizes)[:-1])]
        part = table["part"][0].as_py()
        shape = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("buckets", pa.binary()), ("sums", pa.binary())])
        out = [pa.array([*table["chunk"].to_pylist(), None], pa.int64()), pa.array([part] * (len(got) + 1), pa.int64()), pa.array([*got, None], pa.binary()), pa.array([None] * len(got) + [zip_numbers(sums, "<u8")], pa.binary())]
        return pa.Table.from_arrays(out, schema=shape)

    blocks = chunks.select("chunk", "words", "ids", "ends", "lead").mapInArrow(ask, "part long, chunk long, sizes array<long>, data array<binary>")
    return materialize(blocks.groupBy("part").applyInArrow(answer, "chunk long, part long, buckets binary, sums binary"), "answers")


def part_count(chunks: DataFrame) -> int:
    """Into how many parts a dictionary goes: by bytes of text, and a few for each shuffle partition."""
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    return max(2 * int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART))


def bucket_sums(answers: DataFrame) -> list[int]:
    """Occurrences in each bucket: as many rows as there are buckets, whatever the corpus.

    Tasks add up their parts; what they have is then added up a slice of buckets at a time.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += unzip_numbers(data.as_py(), "<u8")
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(BUCKETS // SLICE), pa.int32()), pa.array(list(total.reshape(-1, SLICE)), pa.list_(pa.int64()))], ["slice", "sums"])

    def add(table: pa.Table) -> pa.Table:
        at = table["slice"][0].as_py()
        total = np.sum([np.array(x, np.int64) for x in table["sums"].to_pylist()], axis=0)
        return pa.table({"bucket": pa.array(np.arange(SLICE) + at * SLICE, pa.int32()), "n": pa.array(total, pa.int64())})

    sums = answers.where("sums is not null").select("sums").mapInArrow(task, "slice int, sums array<long>")
    out = [0] * BUCKETS
    for r in sums.groupBy("slice").applyInArrow(add, "bucket int, n long").collect():
        out[r["bucket"]] = r["n"]
    return out


def weighed(chunks: DataFrame, answers: DataFrame, parts: int, gains: list[int]) -> DataFrame:
    """at (a number of the row), doc_id, n_words, n_features and weight of each document.

    A chunk meets its answers; the gain of an n-gram's bucket counts as often in a document as the
    n-gram does. Pieces of one text are added up.
    """

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        r = left.to_pylist()[0]
        g = Grams(r["words"], r["ids"], r["ends"], r["lead"])
        value = [np.zeros(len(c), np.int64) for c in g.counts]
        routes, gain = g.routes(parts), np.array(gains, np.int64)
        for part, buckets in zip(right["part"].to_pylist(), right["buckets"].to_pylist(), strict=True):
            got, at = gain[unzip_numbers(buckets, "<u2")], 0
            for v, route in zip(value, routes[part], strict=True):
                v[route] = got[at : at + len(route)]
                at += len(route)
        n = len(r["ends"])
        weight, features = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for v, where, which in zip(value, g.ends, g.occurrences, strict=True):
            np.add.at(weight, g.doc[where], v[which])
            features += np.bincount(g.doc[where], minlength=n)
        words = np.bincount(g.doc[g.ends[0]], minlength=n)
        return pa.table({"at": pa.array(r["at"], pa.int64()), "doc_id": pa.array(r["doc_id"], pa.int64()), "n_words": words, "n_features": features, "weight": weight})

    left = chunks.groupBy("chunk")
    right = answers.where("chunk is not null").select("chunk", "part", "buckets").groupBy("chunk")
    rows = left.cogroup(right).applyInArrow(run, "at long, doc_id long, n_words long, n_features long, weight long")
    return rows.groupBy("at").agg(F.min("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")])
