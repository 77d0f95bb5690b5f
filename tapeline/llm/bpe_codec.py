"""Operator 4: byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts of more characters are cut before they reach the library.
CUT_CHARS = 32_768
#: Where the pattern must end a match: white space behind anything else. No alternative has white
#: space behind another character, and none looks behind.
SAFE = re.compile(r"(?<=\S)(?=\s)")


class Codec:
    """Ids of texts by a rank file, and texts of ids."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)

    def cuts(self, text: str) -> Iterator[str]:
        """Parts of about CUT_CHARS characters whose ids in turn are the text's ids."""
        at = 0
        while len(text) - at > CUT_CHARS:
            found = SAFE.search(text, at + CUT_CHARS)
            # \s of re and of the library differ on \x1c to \x1f only; such a place is not used.
            while found and "\x1c" <= text[found.start()] <= "\x1f" or found and "\x1c" <= text[found.start() - 1] <= "\x1f":
                found = SAFE.search(text, found.start() + 1)
            if not found:
                break
            yield text[at : found.start()]
            at = found.start()
        yield text[at:]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.cuts(text):
            if len(part) <= 4 * CUT_CHARS:
                out += self.encoding.encode_ordinary(part)
            else:  # no safe place for long: match by match
                for m in self.pattern.finditer(part):
                    out += self.encoding._encode_single_piece(m[0])
        return out

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)


_codecs: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    if (ranks_path, pattern) not in _codecs:
        _codecs[ranks_path, pattern] = Codec(ranks_path, pattern)
    return _codecs[ranks_path, pattern]


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of each whole text; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):  # ids of few texts at a time
                part = batch.slice(k, 256)
                ids = [c.encode(t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and raw bytes of each list of ids; a null list gives null bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            raw = [None if x.as_py() is None else c.decode(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode each whole text, decode its ids and return digests of both.

    Returns doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256,
    one row for each row of docs. A null text counts as empty; null or repeated doc_ids stay as
    they are; further columns are not read; an empty table gives an empty result. Texts and ids
    never leave the task that read them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for t in batch.column(1):
                ids = c.encode(t.as_py() or "")
                n.append(len(ids))
                of_ids.append(sha(",".join(map(str, ids)).encode()))
                of_bytes.append(sha(c.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
