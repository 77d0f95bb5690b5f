"""Operator 5: quality by importance resampling with hashed n-gram models and Gumbel top-k."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import materialize, small, unpacked, with_row

#: Runs of letters and digits, and runs of anything else that is no white space.
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
BUCKETS = 1 << 16
#: So many labelled documents at most, chosen by hash, make the target model and the calibration.
LABELLED_ROWS = 20_000
#: Pseudo-counts for each bucket, as a share of the model's mean count.
SMOOTHING = 0.05
CACHE = 200_000
#: In the calibration a lost share of the good documents costs so many times a passed share of the bad.
LOSS = 10
#: Texts are cut into tokens so many characters at a time, and so many n-grams are counted at once.
SLICE, GRAMS = 1 << 20, 1 << 20
#: The first buckets are those of what is behind itself and of tokens of capitals.
AGAIN, SHOUT, FIRST = 0, 1, 2

GAP = re.compile(r"\s")
_seen: dict[str, int] = {}


def token_hash(token: str) -> int:
    h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
    if len(token) <= 64:
        if len(_seen) >= CACHE:
            _seen.clear()
        _seen[token] = h
    return h


def slices(text: str) -> Iterator[str]:
    """The text in parts that begin and end between tokens, since no token holds white space."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + SLICE)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of a text's tokens and pairs of neighbouring tokens, a bounded part at a time.

    Tokens of two or more capitals also count as one shared token, as does any token right behind
    itself: what makes shouting and repetition shows whatever the words.
    """
    last: list[int] = []
    room = np.uint64(BUCKETS - FIRST)
    for part in slices(text):
        tokens = TOKEN.findall(part)
        if not tokens:
            continue
        get = _seen.get
        h = np.array(last + [get(t) or token_hash(t) for t in tokens], np.uint64)
        pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(40)
        pair = pair % room + np.uint64(FIRST)
        pair[h[:-1] == h[1:]] = AGAIN
        shout = sum(len(t) > 1 and t.isupper() for t in tokens)
        yield np.concatenate((h[len(last) :] % room + np.uint64(FIRST), pair, np.full(shout, SHOUT, np.uint64))).astype(np.int64)
        last = [int(h[-1])]


def labelled_sample(labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """doc_id and quality of at most rows labelled documents, chosen by hash; the least quality of repeats."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def models(docs: DataFrame, sample: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket over the target documents (sampled, quality 1) and over all documents.

    Each task adds its documents up into two arrays and hands on at most BUCKETS rows, so frequent
    n-grams and large sources gather nowhere; the driver gets BUCKETS rows.
    """
    good = docs.sparkSession.sparkContext.broadcast(np.array(sorted(d for d, q in sample.items() if q == 1), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {True: np.zeros(BUCKETS, np.int64), False: np.zeros(BUCKETS, np.int64)}  # by whether a text is of the target
        held: dict[bool, list[np.ndarray]] = {True: [], False: []}
        size = {True: 0, False: 0}
        ids = good.value

        def add(to: bool) -> None:
            if held[to]:
                counts[to] += np.bincount(np.concatenate(held[to]), minlength=BUCKETS)
                held[to], size[to] = [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                to = doc_id is not None and (k := np.searchsorted(ids, doc_id)) < len(ids) and bool(ids[k] == doc_id)
                for part in grams(text.as_py() or ""):
                    held[to].append(part)
                    size[to] += len(part)
                    if size[to] >= GRAMS:
                        add(to)
        add(True)
        add(False)
        raw, target = counts[True] + counts[False], counts[True]
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = picked.mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = rows["bucket"].to_numpy()
    raw[at], target[at] = rows["raw"].to_numpy(), rows["target"].to_numpy()
    return target, raw


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of target to raw probability by bucket; zeros if either has no n-grams."""
    if not target.sum() or not raw.sum():
        return np.zeros(len(raw))
    p, q = (c + SMOOTHING * max(c.sum() / len(c), 1e-9) for c in (target, raw))
    return np.log(p / p.sum()) - np.log(q / q.sum())


def row_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("text").cast("string"))


def weigh(docs: DataFrame, weights: np.ndarray, seed: int) -> DataFrame:
    """docs' doc_id with log_weight (sum over its n-grams), key (log_weight plus Gumbel noise) and
    row, the hash of seed, doc_id and text that the noise comes from.

    All is a function of doc_id, text and seed alone, so repeats and retries agree.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            got = np.array([sum(float(w[part].sum()) for part in grams(t.as_py() or "")) for t in batch.column(1)], np.float64)
            u = (batch.column(2).to_numpy().view(np.uint64) >> np.uint64(11)).astype(np.float64) + 0.5
            key = got - np.log(-np.log(u / 2.0**53))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64()), pa.array(key, pa.float64()), batch.column(2)], ["doc_id", "log_weight", "key", "row"])

    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_hash(seed).alias("row")
    )
    return picked.mapInArrow(run, "doc_id long, log_weight double, key double, row long")


def calibrate(scored: DataFrame, sample: dict[int, int]) -> float:
    """The log weight that best divides the sampled documents of quality 1 from those of 0.

    Least LOSS times the share lost plus the share passed, in the middle of the widest gap among
    equals. Without either class nothing is cut off.
    """
    ids = docs_frame(scored, sample)
    # One row for each sampled doc_id, however many rows carry it.
    got = scored.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "quality").agg(F.min("log_weight").alias("log_weight")).toPandas()
    good, bad = (np.sort(got.log_weight[got.quality == q].to_numpy()) for q in (1, 0))
    if not len(good) or not len(bad):
        return -np.inf
    at = np.concatenate(([min(good[0], bad[0]) - 1], np.sort(np.concatenate((good, bad))), [max(good[-1], bad[-1]) + 1]))
    mid = (at[1:] + at[:-1]) / 2
    lost = np.searchsorted(good, mid) / len(good)
    passed = 1 - np.searchsorted(bad, mid) / len(bad)
    errors = LOSS * lost + passed
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(mid[best[np.argmax((at[1:] - at[:-1])[best])]])


def docs_frame(like: DataFrame, sample: dict[int, int]) -> DataFrame:
    return like.sparkSession.createDataFrame(list(sample.items()), "doc_id long, quality int")


def kth_key(scored: DataFrame, k: int) -> float:
    """The k-th largest key, exactly, by histograms of ever narrower ranges; no sort, no collect of rows."""
    low, high = scored.agg(F.min("key"), F.max("key")).first()
    above = 0
    for _ in range(12):
        if low == high:
            return low
        width = (high - low) / 4096
        if width <= 0 or low + width == low:
            break
        spot = F.least(F.floor((F.col("key") - low) / width), F.lit(4095)).cast("int")
        bins = {
            r["spot"]: r
            for r in scored.where((F.col("key") >= low) & (F.col("key") <= high)).groupBy(spot.alias("spot")).agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b")).collect()
        }
        for s in sorted(bins, reverse=True):
            if above + bins[s]["n"] >= k:
                low, high = bins[s]["a"], bins[s]["b"]
                break
            above += bins[s]["n"]
    return low


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 5) -> DataFrame:
    """Importance resampling: doc_id, log_weight, key, row, kept of every document.

    The target model counts the n-grams of the sampled documents of quality 1 (LABELLED_ROWS at
    most), the raw model those of all documents; a document's log weight is the sum of its
    n-grams' log ratios, and the k largest of log weight plus Gumbel noise are kept, which samples
    k documents without replacement in proportion to their weights. By default k is the number of
    documents at or above the log weight that best divides the sample's two classes; documents
    with a key equal to the k-th are kept too. Null texts count as empty (weight 0). Null doc_ids
    and repeated rows each take part as rows. Without both labels, or with an empty table, all
    rows are kept.
    """
    sample = {r["doc_id"]: r["quality"] for r in labelled_sample(labels).collect()}
    target, raw = models(docs, sample)
    scored = materialize(weigh(docs, log_ratio(target, raw), seed), "weights")
    if k is None:
        cut = calibrate(scored, sample)
        k = scored.where(F.col("log_weight") >= cut).count()
    least = kth_key(scored, k) if k else np.inf
    if scored.isEmpty():
        least = 0.0
    return scored.withColumn("kept", F.col("key") >= F.lit(float(least)))


def keep_sampled(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 5) -> DataFrame:
    """The rows of docs that resample() keeps, with the columns of docs."""
    packed = with_row(docs)
    judged = resample(packed.select("doc_id", "text"), labels, k, seed)
    gone = materialize(judged.where(~F.col("kept")).select(F.col("row").alias("gone"), F.col("doc_id").alias("of")).distinct(), "rejected")
    same = (row_hash(seed) == F.col("gone")) & F.col("doc_id").eqNullSafe(F.col("of"))
    return unpacked(packed.join(small(gone), same, "left_anti"), docs)
