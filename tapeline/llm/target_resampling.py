"""Operator 12: importance resampling towards a target distribution, over a dictionary of distinct n-grams."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import materialize
from tapeline.llm.ngram_dictionary import BUCKETS, bucket_sums, chunked, dictionary, part_count, weighed
from tapeline.operators.numbering import numbered

#: Documents of fewer words are not drawn; the share that is, in hundredths.
LEAST_WORDS, PERCENT = 20, 5
#: What the noise of a document is made of beside its doc_id.
SEED = 42


def texts(table: DataFrame, key: str) -> DataFrame:
    return table.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def log_gains(target: list[int], raw: list[int]) -> list[int]:
    """Thousandths of the log ratio of a bucket's smoothed shares in the target and in all texts."""
    t_all, s_all = float(sum(target) + BUCKETS), float(sum(raw) + BUCKETS)
    return [math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for t, s in zip(target, raw, strict=True)]


def noise(doc_id: Column) -> Column:
    """Gumbel noise in thousandths from a hash of the doc_id; a null one counts as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def target_resample(docs: DataFrame, target: DataFrame, key: str = "item_id", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score and rank of each document.

    n-grams of one to three words are counted by distinct string, each string is hashed to its
    bucket once, buckets are summed, and their gains (log ratios of target to docs) come back to
    the documents' own counts. Of the N documents with at least least_words words the
    N * percent // 100 highest scores are drawn, ties by the smaller doc_id (null last), and ranked
    from 1; rank is null for the others. Repeated rows count, and may be drawn, once each; their
    order among themselves is any. Null texts have no words: no features, weight 0. With an empty
    target all gains compare with even shares. Further columns are not read; an empty table gives
    an empty result.
    """
    chunks = chunked(texts(docs, "doc_id"))
    wanted = chunked(texts(target, key))
    parts = part_count(chunks)
    answers = dictionary(chunks, parts)
    gains = log_gains(bucket_sums(dictionary(wanted, part_count(wanted))), bucket_sums(answers))
    rows = weighed(chunks, answers, parts, gains).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    rows = materialize(rows, "weights")
    fit = rows.where(F.col("n_words") >= least_words)
    n, bound = fit.agg(F.count("*"), F.percentile_approx("score", max(0.0, 1 - 1.2 * percent / 100), 1000)).first()
    drawn = n * percent // 100
    # Only what can be drawn is sorted: the rows from an approximate cut on, if it leaves enough.
    if bound is not None and fit.where(F.col("score") >= bound).count() < drawn:
        bound = None
    able = (F.col("n_words") >= least_words) & (F.col("score") >= bound if bound is not None else F.lit(True))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = numbered(rows.where(able).select(*out, "at"), order, "place")
    ranked = ranked.select(*out, F.when(F.col("place") < drawn, F.col("place") + 1).cast("long").alias("rank"))
    return ranked.unionByName(rows.where(~able).select(*out, F.lit(None).cast("long").alias("rank")))
