"""Operator 6: token ids in sorted-string-table shards, with binary-search lookup.

A shard is one file: data blocks, block index, Bloom filter, footer. Keys are document identifiers
as 8 big-endian bytes with the sign bit turned (so bytes sort as numbers do) behind a byte 1; a
null identifier is the single byte 0 and sorts first. In a block, a key is stored as the number of
bytes shared with the key before, the rest's length and the rest; each block starts anew. The
index holds each block's first key, place, size and CRC. The footer has a fixed size and says
where the rest is.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import materialize, scratch_path
from tapeline.llm.words import encoder

END_ID = 2
MAGIC = b"TPLSST01"
BLOCK_BYTES = 64 << 10
BLOOM_BITS, BLOOM_PROBES = 10, 7
#: A shard holds about so many bytes of text and so many documents at most.
SHARD_BYTES, SHARD_DOCUMENTS = 256 << 20, 1 << 20
#: index place and size, Bloom place and size, entries, tokens, bytes per id, CRC of index and Bloom filter, magic
FOOTER = struct.Struct("<QQQQQQII8s")


def key_of(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + ((doc_id + (1 << 63)) & (2**64 - 1)).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return None if key == b"\0" else int.from_bytes(key[1:], "big") - (1 << 63)


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(buf: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = buf[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def probes(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (2**64 - 1), h >> 64 | 1
    return [(a + k * b) % bits for k in range(BLOOM_PROBES)]


#: What pyarrow calls the object stores that Hadoop has other names for.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(docs: DataFrame, folder: str) -> str:
    """The folder as Spark takes it: without a scheme it lies in the cluster's default file system."""
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def file_system(uri: str):
    """The file system of a qualified URI and the path in it: local folders, HDFS and object stores."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if not rest or "/" in scheme:
        raise ValueError(f"{uri} has no scheme")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest.removeprefix('//')}")


class ShardWriter:
    """Writes keys in ascending order; holds one block, the index and the key hashes in memory."""

    def __init__(self, sink, id_bytes: int):
        self.sink, self.id_bytes = sink, id_bytes
        self.block, self.first, self.last = bytearray(), b"", b""
        self.index = bytearray()
        self.keys: list[bytes] = []
        self.at = self.tokens = 0

    def add(self, key: bytes, ids: bytes) -> None:
        if key < self.last:
            raise ValueError("keys out of order")
        if not self.block:
            self.first, shared = key, 0
        else:
            shared = next((i for i, (a, b) in enumerate(zip(key, self.last, strict=False)) if a != b), min(len(key), len(self.last)))
        self.block += varint(shared) + varint(len(key) - shared) + key[shared:] + varint(len(ids)) + ids
        self.last = key
        self.keys.append(key)
        self.tokens += len(ids) // self.id_bytes
        if len(self.block) >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.block:
            self.sink.write(bytes(self.block))
            self.index += varint(len(self.first)) + self.first + varint(self.at) + varint(len(self.block)) + zlib.crc32(self.block).to_bytes(4, "little")
            self.at += len(self.block)
            self.block = bytearray()

    def close(self) -> None:
        self.flush()
        bits = max(64, BLOOM_BITS * len(self.keys))
        bloom = np.zeros((bits + 7) // 8 * 8, bool)
        for key in self.keys:
            bloom[probes(key, bits)] = True
        packed = varint(bits) + np.packbits(bloom, bitorder="little").tobytes()
        self.sink.write(bytes(self.index) + packed)
        crc = zlib.crc32(packed, zlib.crc32(self.index))
        self.sink.write(FOOTER.pack(self.at, len(self.index), self.at + len(self.index), len(packed), len(self.keys), self.tokens, self.id_bytes, crc, MAGIC))


class ShardReader:
    """Reads a shard by parts: the footer, index and filter at once, blocks as they are asked for."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        foot = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        at, n, bloom_at, bloom_n, self.entries, self.tokens, self.id_bytes, crc, magic = foot
        if magic != MAGIC:
            raise ValueError(f"{uri} is no shard")
        index, bloom = self.file.read_at(n, at), self.file.read_at(bloom_n, bloom_at)
        if zlib.crc32(bloom, zlib.crc32(index)) != crc:
            raise ValueError(f"{uri}: index or filter damaged")
        self.bits, k = read_varint(bloom, 0)
        self.bloom = bloom[k:]
        self.firsts: list[bytes] = []
        self.blocks: list[tuple[int, int, int]] = []
        k = 0
        while k < len(index):
            m, k = read_varint(index, k)
            self.firsts.append(index[k : k + m])
            place, k = read_varint(index, k + m)
            length, k = read_varint(index, k)
            self.blocks.append((place, length, int.from_bytes(index[k : k + 4], "little")))
            k += 4

    def entries_of(self, block: int) -> Iterator[tuple[bytes, bytes]]:
        place, length, crc = self.blocks[block]
        buf = self.file.read_at(length, place)
        if zlib.crc32(buf) != crc:
            raise ValueError(f"block {block} damaged")
        k, key = 0, b""
        while k < len(buf):
            shared, k = read_varint(buf, k)
            rest, k = read_varint(buf, k)
            key = key[:shared] + buf[k : k + rest]
            n, k = read_varint(buf, k + rest)
            yield key, buf[k : k + n]
            k += n

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for b in range(len(self.blocks)):
            for key, ids in self.entries_of(b):
                yield id_of(key), np.frombuffer(ids, f"<u{self.id_bytes}")

    def lookup(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every document with this identifier: filter, binary search, then one block (more for repeats)."""
        key = key_of(doc_id)
        if any(not self.bloom[p >> 3] >> (p & 7) & 1 for p in probes(key, self.bits)):
            return []
        found: list[np.ndarray] = []
        b = bisect_right(self.firsts, key) - 1
        while b > 0 and self.firsts[b] == key:  # repeats may begin in a block before
            b -= 1
        while 0 <= b < len(self.blocks) and self.firsts[b] <= key:
            found += [np.frombuffer(v, f"<u{self.id_bytes}") for k, v in self.entries_of(b) if k == key]
            b += 1
        return found

    def close(self) -> None:
        self.file.close()


def write_shards(docs: DataFrame, tokenizer: str, folder: str, shards: int | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode whole texts and write them into shards of ascending, disjoint key ranges.

    Returns the manifest (shard, uri, documents, tokens), already written, one row for each shard.
    Their number follows from the bytes and rows of docs, and is no less than that of the shuffle's
    partitions. Rows without doc_id come first and have shards of their own, as many as their
    share. The bounds of the others are quantiles of doc_id alone, so texts are encoded once and
    dealt out once; equal identifiers between two equal bounds are dealt over all shards between
    them. Bounds are rough, but whole numbers that doc_ids are compared with exactly. A shard is
    written under a name of its own for each attempt and listed only by the attempt that ended
    well: lost executors and repeated attempts do no harm.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, named, size, least, most = picked.agg(F.count("*"), F.count("doc_id"), F.sum(F.octet_length("text")), F.min("doc_id"), F.max("doc_id")).first()
    if shards is None:
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((size or 0) / SHARD_BYTES), math.ceil(rows / SHARD_DOCUMENTS))
    nulls = math.ceil(shards * (rows - named) / rows) if rows > named else 0
    shards = max(1, shards - nulls) if named else 0
    cuts = [k / shards for k in range(1, shards)]
    # Quantiles are of doubles, so they are taken of the distance from the least doc_id.
    base = least if named and most - least < 2**62 else 0
    found = picked.select((F.col("doc_id") - F.lit(base)).alias("x")).stat.approxQuantile("x", cuts, 1 / (8 * shards)) if cuts else []
    bounds = np.array([min(max(int(x) + base, -(2**63)), 2**63 - 1) for x in found], np.int64)
    folder = qualified(docs, folder)
    end = int(end_id).to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        wide = enc.tokenizer.get_vocab_size() > 1 << 16
        n = 0
        for batch in batches:
            to, ids = [], []
            doc_ids = batch.column(0).to_pylist()
            for doc_id, text in zip(doc_ids, batch.column(1), strict=True):
                got = enc.encode(text.as_py() or "") + end
                ids.append(got if wide else np.frombuffer(got, "<u4").astype("<u2").tobytes())
                if doc_id is None:
                    to.append(n % nulls)
                else:
                    low, high = (int(np.searchsorted(bounds, np.int64(doc_id), side)) for side in ("left", "right"))
                    to.append(nulls + low + n % (high - low + 1))
                n += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(ids, pa.binary()), pa.array([4 if wide else 2] * len(to), pa.int32())],
                ["shard", "doc_id", "ids", "id_bytes"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            cols = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist())
            for shard, doc_id, ids, id_bytes in zip(*cols, strict=True):
                if writer is None:
                    uri, number = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.sst", shard
                    fs, path = file_system(uri)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    sink = fs.open_output_stream(path)
                    writer = ShardWriter(sink, id_bytes)
                writer.add(key_of(doc_id), ids.as_py())
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([number], pa.int32()), "uri": [uri], "documents": [len(writer.keys)], "tokens": [writer.tokens]}
            )

    dealt = picked.mapInArrow(encode, "shard int, doc_id long, ids binary, id_bytes int")
    ordered = dealt.repartitionById(max(1, nulls + shards), F.col("shard")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    return materialize(ordered.mapInArrow(write, "shard int, uri string, documents long, tokens long"), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the listed shards: doc_id, start (ids before it), n_tokens, ids_crc32.

    The crc is of the ids as little-endian unsigned 32-bit integers. One task reads one shard; the
    driver sees one row for each shard.
    """
    spark = manifest.sparkSession
    rows, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r["shard"]):
        rows.append((r["uri"], start))
        start += r["tokens"]
    listed = spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), "uri string, start long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for uri, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard, out = ShardReader(uri), []
                for doc_id, ids in shard.scan():
                    out.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                    if len(out) >= 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)
                shard.close()

    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, doc_id: int | None) -> list[np.ndarray]:
    """The ids of the documents with this identifier, from a driver: each shard's filter rules most out."""
    found: list[np.ndarray] = []
    for r in sorted(manifest.collect(), key=lambda r: r["shard"]):
        shard = ShardReader(r["uri"])
        found += shard.lookup(doc_id)
        shard.close()
    return found


def token_shards(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write documents as shards, read the shards back and describe each document from them.

    Null texts count as empty (the end id alone). Null identifiers come first; repeated
    identifiers are all kept, in any order among themselves. Further columns are not read. An
    empty table gives no shards and an empty result.
    """
    return read_shards(write_shards(docs, tokenizer, folder or scratch_path(docs.sparkSession, "sst")))
