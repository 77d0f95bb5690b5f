"""Operator 9: quality rules, DataFrame functions only: base counts and a hashed n-gram likelihood ratio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import SPACE_CLASS, let, materialize, unpacked

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
#: Buckets of the hashed n-grams (words, the last three characters of each word and, with pairs,
#: neighbouring words); the size of all that is sent to tasks.
BUCKETS = 1 << 14
#: So many trusted documents at most make the target model.
TRUSTED_ROWS = 20_000
#: Added to every bucket's count, as a share of the model's mean count.
SMOOTHING = 0.05
#: With so many different repeated windows at most, their places are looked up one by one.
FEW = 12
#: A document is kept if its mean log-likelihood ratio for each n-gram is at least this.
CUT = -0.25


def words_of(text: Column) -> Column:
    """The words of a text in order; an empty array without any."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS))


def bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def ending(word: Column) -> Column:
    """The hash of a word's last three characters, apart from those of words."""
    return F.xxhash64(F.substring(word, -3, 3), F.lit(3))


def neighbours(hashes: Column) -> Column:
    """The hashes of all pairs of neighbouring words, from the words' hashes."""
    return F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(hashes, i + 1)))


def trusted_sample(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """doc_id of at most rows labelled documents of quality 1, chosen by hash: a bounded sample."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def model(docs: DataFrame, trusted: DataFrame, pairs: bool = False) -> DataFrame:
    """One row with the array `weights`: each bucket's log ratio of trusted to raw probability.

    The raw model counts the n-grams of every document, the trusted model those of the documents
    in trusted (doc_id, at most TRUSTED_ROWS rows, broadcast). Counts are combined before the
    shuffle, at most BUCKETS rows from each task, so neither frequent words nor large sources
    gather anywhere.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mark = F.broadcast(trusted.withColumn("trusted", F.lit(1)))
    # One row for each word and bucket, made and counted in one compiled stage.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(mark, "doc_id", "left").select(words_of(F.col("text")).alias("words"), F.coalesce("trusted", F.lit(0)).alias("trusted"))
    words = texts.select(F.explode("words").alias("w"), "trusted")
    found = words.select(F.explode(F.array(bucket(F.xxhash64("w")), bucket(ending(F.col("w"))))).alias("bucket"), "trusted")
    if pairs:
        hashed = texts.select(F.transform("words", lambda w: F.xxhash64(w)).alias("h"), "trusted")
        found = found.union(hashed.select(F.explode(neighbours(F.col("h"))).alias("h"), "trusted").select(bucket(F.col("h")).alias("bucket"), "trusted"))
    counts = found.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("good"))
    spark = docs.sparkSession
    full = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0, ["raw", "good"])
    listed = full.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("c"), F.sum("raw").alias("raws"), F.sum("good").alias("goods"))
    log_p = lambda n, total: F.log((n + SMOOTHING * total / BUCKETS + 1e-9) / (total * (1 + SMOOTHING) + 1e-9 * BUCKETS))
    weights = F.transform("c", lambda x: log_p(x["good"], F.col("goods")) - log_p(x["raw"], F.col("raws")))
    # Without trusted or raw n-grams there is nothing to tell documents apart by.
    flat = F.transform("c", lambda x: F.lit(0.0))
    return materialize(listed.select(F.when((F.col("goods") > 0) & (F.col("raws") > 0), weights).otherwise(flat).alias("weights")), "weights")


def covered(places: Column) -> Column:
    """Words in the union of three-word windows at ascending places."""
    step = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
    return F.aggregate(step, F.lit(0), lambda a, x: a + x)


def sorted_places(windows: Column) -> Column:
    """Places of the windows whose hash comes more than once, by sorting them all."""

    def again(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        hit = F.filter(s, lambda x, k: F.when(k > 0, same(x, k - 1)).otherwise(F.lit(False)) | same(x, k + 1))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    return let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), again)


def judged(docs: DataFrame, labels: DataFrame, cut: float = CUT, pairs: bool = False) -> DataFrame:
    """own, a struct of all columns of docs, and rules, one of the counts, ratio, base_failed and kept.

    Three-word windows are told apart by 64-bit hashes of their words' hashes. The columns are made
    step by step, each used more than once by the next, so none is computed again within another.
    """
    weights = model(docs, trusted_sample(labels), pairs).scalar()
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    df = docs.select(own.alias("own"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), weights.alias("weights"))
    df = df.select("*", words_of(F.col("text")).alias("words"))
    df = df.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    n, h = F.size("words"), F.col("hashes")
    windows = F.transform(F.slice(h, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
    df = df.select("*", windows.alias("windows"))
    df = df.select("*", F.sort_array("windows").alias("sorted"))
    before = lambda k: F.get(F.col("sorted"), F.greatest(k - 1, F.lit(0)))
    df = df.select("*", F.array_distinct(F.filter("sorted", lambda x, k: (x == before(k)) & (k > 0))).alias("twice")).drop("sorted")
    each = F.filter(F.sequence(F.lit(0), n - 3), lambda i: F.array_contains(F.col("twice"), F.get(F.col("windows"), i)))
    places = F.when(F.size("twice") == 0, F.array().cast("array<int>")).when(F.size("twice") <= FEW, each).otherwise(sorted_places(F.col("windows")))
    worded = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    w = F.col("weights")
    sums = F.aggregate(h, F.lit(0.0), lambda a, x: a + F.get(w, bucket(x))) + F.aggregate("words", F.lit(0.0), lambda a, x: a + F.get(w, bucket(ending(x))))
    grams = 2 * n
    if pairs:
        sums = sums + F.aggregate(neighbours(h), F.lit(0.0), lambda a, x: a + F.get(w, bucket(x)))
        grams = 3 * n - 1
    df = df.select(
        "own",
        F.struct(
            n.cast("long").alias("n_words"),
            F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            let(places, covered).cast("long").alias("n_repeat_words"),
            F.when(n == 0, F.lit(0.0)).otherwise(sums / grams).alias("ratio"),
        ).alias("r"),
    )
    failed = (F.col("r.n_words") < 50) | (100 * F.col("r.n_repeat_words") > 50 * F.col("r.n_words"))
    # The last term is always true. As it is not deterministic, no filter on kept moves below this
    # projection, where it would compute every column again inside another's lambda.
    kept = ~failed & (F.col("r.ratio") >= cut) & (F.monotonically_increasing_id() >= 0)
    return df.select("own", F.struct("r.*", failed.alias("base_failed"), kept.alias("kept")).alias("rules"))


def quality_rules(docs: DataFrame, labels: DataFrame, cut: float = CUT, pairs: bool = False) -> DataFrame:
    """Base counts, base_failed and kept of every document, one row for each row of docs.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
    and ratio. Null texts count as empty: no words, base_failed. Null and repeated doc_ids stay; a
    null one is never trusted. Further columns are not read; empty tables give an empty result,
    and without trusted documents all ratios are 0, so the base rules decide. With pairs the ratio
    also counts pairs of neighbouring words, so it depends on their order. Whole texts are
    scored where they lie: nothing is shuffled but bucket counts.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = judged(picked, labels, cut, pairs).select("own.doc_id", "rules.*")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


def keep_by_rules(docs: DataFrame, labels: DataFrame, cut: float = CUT, pairs: bool = False) -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs."""
    return unpacked(judged(docs, labels, cut, pairs).where("rules.kept"), docs)
