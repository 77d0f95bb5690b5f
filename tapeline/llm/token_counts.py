"""Operator 8: token counts by a map-side two-tier lookup of pre-token lengths."""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The first tier: so many frequent pre-tokens at most, of all documents. Each task that counts them
#: keeps so many counters at most. These bound what is shuffled, what reaches the driver and what is
#: broadcast, and change only the speed: every other pre-token is encoded when it comes.
TABLE_SIZE, COUNTERS = 65_536, 131_072
#: The second tier: bytes that a worker's cache may take, and what an entry takes beside its
#: pre-token. Longer pre-tokens are not kept.
CACHE_BYTES, ENTRY, LONGEST = 64 << 20, 160, 64

MARK = "▁"
#: White space led by the mark or a line end starts a pre-token, and no piece runs over its start.
CUT = re.compile(r"\n[^ \n]*| +[^ \n]*|[^ \n]+")


class TokenCounter:
    """Lengths of texts in ids of a sentencepiece model or a tokenizers file."""

    def __init__(self, path: str):
        self.cache: dict[str, int] = {}
        self.held = 0
        if path.endswith(".json"):
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.of_json = Tokenizer.from_file(path)
            self.by_part = False
            return
        import sentencepiece

        self.of_json = None
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        # Parts may be counted one by one if no piece has a line end, or the mark behind another
        # character, and if texts are encoded as they are, behind one mark.
        self.by_part = (
            not any("\n" in p or MARK in p.lstrip(MARK) for p in pieces)
            and self.model.encode("a", out_type=str) == [MARK + "a"]
            and len(self.model.encode(" a  b ", out_type=str)) > len(self.model.encode("a b", out_type=str))
            and self.model.encode("Ａ a", out_type=str)[-1:] == self.model.encode("a a", out_type=str)[-1:]
        )

    def whole(self, text: str) -> int:
        if self.of_json is not None:
            return len(self.of_json.encode(text, add_special_tokens=False).ids)
        return len(self.model.encode(text, num_threads=1))

    def part(self, part: str) -> int:
        """Of a pre-token that begins with a space (which the model itself puts in front) or a line end."""
        if part[0] == " ":
            return self.whole(part[1:]) if len(part) > 1 else 1
        return self.whole(part) - 1  # less the mark in front of the line end

    def count(self, text: str, frequent: dict[str, int]) -> int:
        if not text:
            return 0
        if not self.by_part:
            return self.whole(text)
        total, cache = 0, self.cache
        for p in CUT.findall(" " + text.replace(MARK, " ")):
            n = frequent.get(p) or cache.get(p)
            if n is None:
                n = self.part(p)
                if len(p) <= LONGEST:
                    self.held += ENTRY + len(p)
                    if self.held > CACHE_BYTES:
                        cache.clear()
                        self.held = ENTRY + len(p)
                    cache[p] = n
            total += n
        return total


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent pre-tokens of a task's texts with their counts, at most TABLE_SIZE.

    Beyond COUNTERS counters all are lowered by the count that half of them do not exceed, and
    those at zero are dropped (Misra and Gries' heavy hitters): what is frequent stays.
    """
    seen: Counter[str] = Counter()
    for batch in batches:
        for t in batch.column(0):
            if text := t.as_py():
                seen.update(p for p in CUT.findall(" " + text.replace(MARK, " ")) if len(p) <= 64)
                if len(seen) > COUNTERS:
                    less = sorted(seen.values())[len(seen) // 2]
                    seen = Counter({p: n - less for p, n in seen.items() if n > less})
    top = heapq.nlargest(TABLE_SIZE, ((n, p) for p, n in seen.items()))
    yield pa.RecordBatch.from_arrays([pa.array([p for _, p in top], pa.string()), pa.array([n for n, _ in top], pa.int64())], ["part", "n"])


def frequent_lengths(docs: DataFrame, path: str) -> dict[str, int]:
    """The first tier: lengths of the most frequent pre-tokens of all texts, merged from bounded
    counts of each task."""
    c = counter(path)
    if not c.by_part:
        return {}
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(heavy, "part string, n long")
    top = counts.groupBy("part").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "part").limit(TABLE_SIZE)
    return {r["part"]: c.part(r["part"]) for r in top.collect()}


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Count the tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty: 0 bytes, 0 tokens. null or repeated doc_ids stay as they are;
    further columns are not read; an empty table gives an empty result. Nothing is shuffled but
    the bounded counts of the first tier.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, frequent = counter(path), table.value
        for batch in batches:
            n_bytes, n_tokens = [], []
            for t in batch.column(1):
                text = t.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(c.count(text, frequent))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
