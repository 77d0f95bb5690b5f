"""Each operator against a plain version on small tables with nulls, empty and long texts, ties and clashing columns."""

import collections
import hashlib
import itertools
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import bpe_codec, importance, license_scan, ngram_rules, packing, simhash, sstable, token_counts, topk
from tapeline.llm.queries import ORACLES, QUERIES, pattern, tokenizer_file

WORD_BPE, PIECES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("piece_bpe_32k.model")
RANKS = tokenizer_file("byte_bpe_multi_50k.tiktoken")
#: Beside the documents' own columns some that operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, length int, row long, kept string, shard int, `a b` string, class int, word string"
TEXTS = [
    None, "", " \n\t ", "one", "Aé ñ ß “x” 中文 🙂 ́x", "<|endoftext|> <s> </s> ▁▁x", "it's I'LL we've 12345 a1b2\r\n\x00\x1c", "same text here and again",
    "same text here and again", "word " * 30_000, "x" * 20_000, " " * 5_000 + "end", "the quick brown fox jumps over the lazy dog " * 40, "l1\nl1\n\nl2\nl1",
]


def table(spark, texts=TEXTS, ids=None):
    ids = ids or [*range(len(texts))]
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, 2, "k", 3, "z", 4, "w") for i, t in zip(ids, texts, strict=True)], DOCS)


def docs(spark):
    """Texts under negative, repeated, very large and null identifiers."""
    ids = [5, -3, 2**40, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, None]
    return table(spark, [*TEXTS, "same text here and again", "again null"], [*ids, 11, None])


@pytest.fixture(scope="module")
def word_bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD_BPE)


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_packing(spark, word_bpe):
    df = docs(spark)
    got = packing.best_fit_packing(df, WORD_BPE, capacity=64).collect()
    want = collections.Counter()
    for r in df.collect():
        ids = [*word_bpe.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 64)):
            want[r.doc_id, k, at, len(ids[at : at + 64]), crc(ids[at : at + 64])] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert len(sequences) <= math.ceil(sum(r.length for r in got) / 64) + 1
    assert packing.best_fit_packing(table(spark, []), WORD_BPE).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_all_and_fill_well(seed):
    r = random.Random(seed)
    counts = collections.Counter(r.choice((r.randint(1, 100), r.randint(1, 20), 37)) for _ in range(500))
    plan = packing.fill(dict(counts), 100)
    ends = collections.Counter()
    for n, first, repeat, sequence, offset in zip(plan.length, plan.first, plan.repeat, plan.sequence, plan.offset, strict=True):
        later = [f for m, f in zip(plan.length, plan.first, strict=True) if m == n and f > first]
        for k in range(min([*later, counts[n]]) - first):
            ends[int(sequence + k // repeat)] += int(n)
    assert sum(ends.values()) == sum(n * c for n, c in counts.items()) and max(ends.values()) <= 100
    gaps: list[int] = []  # of best-fit decreasing, for comparison
    for n in sorted(counts.elements(), reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((100 if fit is None else fit) - n)
    assert math.ceil(sum(ends.values()) / 100) <= len(ends) == plan.sequences <= len(gaps)


def test_packing_exact_fits():
    """No single or pair of these fills a gap; triples do."""
    assert packing.fill({50: 4, 30: 4, 15: 4, 5: 4}, 100).sequences == 4
    assert packing.fill({1: 1000}, 100).sequences == 10


def test_codec(spark):
    df = docs(spark)
    c = bpe_codec.Codec(RANKS, pattern())
    plain = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=c.encoding._mergeable_ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = collections.Counter()
    for r in df.collect():
        ids = plain.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())] += 1
    assert collections.Counter(map(tuple, bpe_codec.round_trip(df, RANKS, pattern()).collect())) == want
    back = bpe_codec.decode(bpe_codec.encode(df, RANKS, pattern()), RANKS, pattern())
    assert collections.Counter((r.doc_id, bytes(r.bytes)) for r in back.collect()) == collections.Counter((r.doc_id, (r.text or "").encode()) for r in df.collect())
    assert bpe_codec.round_trip(table(spark, []), RANKS, pattern()).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_index_of_sums(seed):
    """The plan finds an exact fill by up to three lengths wherever there is one for the first gap."""
    r = random.Random(seed)
    for _ in range(60):
        lengths = r.sample(range(1, 40), r.randint(3, 9))
        top, rest = max(lengths), [n for n in lengths if n != max(lengths)]
        gap = 60 - top
        exact = any(sum(c) == gap for n in (1, 2, 3) for c in itertools.combinations(rest, n))
        plan = packing.fill({n: 1 for n in lengths}, 60)
        first = int(plan.sequence[plan.length == top][0])
        filled = sum(int(n) for n, s in zip(plan.length, plan.sequence, strict=True) if s == first)
        assert filled == 60 if exact else filled <= 60


@pytest.mark.parametrize("size", [3, 20])
def test_codec_cuts_are_safe(size, monkeypatch):
    monkeypatch.setattr(bpe_codec, "CUT_CHARS", size)
    c, r = bpe_codec.Codec(RANKS, pattern()), random.Random(size)
    for _ in range(500):
        text = "".join(r.choice(["a", "b", " ", "  ", "\n", "'s", "'", "1", "!", "é", "\x1c", "\x85", "\xa0", "中", "'ll"]) for _ in range(60))
        assert c.encode(text) == c.encoding.encode_ordinary(text)


def test_shards(spark, word_bpe, tmp_path):
    df = docs(spark)
    folder = f"file://{tmp_path}/sst"
    manifest = sstable.write_shards(df, WORD_BPE, folder, shards=3)
    got = sstable.read_shards(manifest).collect()
    encoded = [(r.doc_id, [*word_bpe.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in df.collect()]
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter((d, len(i), crc(i)) for d, i in encoded)
    at, last = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (last is None or r.doc_id is not None and r.doc_id >= last)
        at, last = at + r.n_tokens, r.doc_id
    for d in {d for d, _ in encoded}:
        assert sorted(map(list, sstable.lookup(manifest, d))) == sorted(i for k, i in encoded if k == d)
    assert sstable.lookup(manifest, 123456789) == []
    assert sstable.token_shards(table(spark, []), WORD_BPE).count() == 0


@pytest.mark.parametrize("nulls", [0, 120])
@pytest.mark.parametrize("base", [0, 2**53 - 150, 2**60, 2**63 - 400, -(2**63)])
def test_shards_of_large_identifiers(spark, word_bpe, tmp_path, base, nulls):
    """start ascends with doc_id whatever its size, and rows without doc_id come first, dealt over shards."""
    ids = [base + k for k in range(280)] + [base + 200] * 20 + [None] * nulls
    random.Random(1).shuffle(ids)
    df = table(spark, [f"word {i}" for i in ids], ids).repartition(3)
    manifest = sstable.write_shards(df, WORD_BPE, f"file://{tmp_path}/sst", shards=6)
    got = sorted(sstable.read_shards(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(ids, key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert max(r.documents for r in manifest.collect()) <= 110


def test_folders_without_a_scheme(spark, tmp_path):
    """A bare path lies in the cluster's default file system."""
    df = table(spark, ["some text", None])
    assert sstable.qualified(df, str(tmp_path)) == f"file:{tmp_path}"
    manifest = sstable.write_shards(df, WORD_BPE, f"{tmp_path}/bare", shards=1)
    assert all(r.uri.startswith("file:/") for r in manifest.collect()) and sstable.read_shards(manifest).count() == 2
    with pytest.raises(ValueError):
        sstable.file_system("/no/scheme")


def test_shard_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(sstable, "BLOCK_BYTES", 40)
    uri = f"file://{tmp_path}/x.sst"
    keys = sorted([None, -5, -5, -1, 0, 1, 1, 1, 255, 256, 2**40, -(2**63), 2**63 - 1], key=sstable.key_of)
    with open(f"{tmp_path}/x.sst", "wb") as f:
        w = sstable.ShardWriter(f, 2)
        for n, k in enumerate(keys):
            w.add(sstable.key_of(k), np.arange(n, dtype="<u2").tobytes())
        w.close()
    s = sstable.ShardReader(uri)
    assert [k for k, _ in s.scan()] == keys and len(s.blocks) > 3
    for k in keys:
        assert [len(v) for v in s.lookup(k)] == [n for n, x in enumerate(keys) if x == k]
    assert s.lookup(7) == [] and sum(not s.lookup(k) for k in range(1000, 2000)) == 1000


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(spark):
    df = docs(spark)
    r = random.Random(1)
    base = [" ".join(r.choice(["alpha", "Beta", "gamma", "delta", "eta", "IOTA"]) for _ in range(60)) for _ in range(8)]
    more = [" ".join(w if r.random() > 0.02 else "new" for w in r.choice(base).split()) for _ in range(150)]
    df = df.unionByName(table(spark, more, [100 + k for k in range(len(more))]))
    rows = df.collect()
    fps = [brute_fingerprint(x.text) for x in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                up[root(a)] = root(b)
    least = {}
    for k, x in enumerate(rows):
        if x.doc_id is not None:
            least[root(k)] = min(least.get(root(k), x.doc_id), x.doc_id)
    want = collections.Counter((x.doc_id, f"{f:016x}", least.get(root(k))) for k, (x, f) in enumerate(zip(rows, fps, strict=True)))
    assert collections.Counter(map(tuple, simhash.near_duplicates(df).collect())) == want
    kept = collections.Counter((x.doc_id, x.text) for x in simhash.keep_first(df).collect())
    groups = collections.defaultdict(set)
    for k, x in enumerate(rows):
        groups[root(k)].add((x.doc_id, x.text))
    assert set(kept) <= {(x.doc_id, x.text) for x in rows} and all(len(g & set(kept)) == 1 for g in groups.values())
    assert {d for d, _ in kept} == set(least.values()) | {None for k in groups if k not in least}
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def test_first_of_a_group_by_row(spark):
    """A copy under the number of a text of its own goes; that text stays."""
    copy, own = "the same words here as in another document of this table", "a text of its own that nobody else in this table has"
    kept = simhash.keep_first(table(spark, [copy, copy, own, own, "copies of nothing at all here", copy], [1, 7, 7, 7, 9, None])).collect()
    assert collections.Counter((r.doc_id, r.text) for r in kept) == {(1, copy): 1, (7, own): 2, (9, "copies of nothing at all here"): 1}


@pytest.mark.parametrize("limit", [2048, 2])
def test_links_lose_no_pair(spark, limit):
    """With a limit of 2 all buckets go through the second family of masks."""
    r = random.Random(limit)
    fps = {r.getrandbits(64) for _ in range(100)}
    for f in list(fps)[:60]:
        for _ in range(4):
            g = f
            for b in r.sample(range(64), r.randint(1, 6)):
                g ^= 1 << b
            fps.add(g)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    up = {simhash.signed(f): simhash.signed(f) for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for e in simhash.links(df, 4, limit).collect():
        assert ((e.a ^ e.b) & (2**64 - 1)).bit_count() > 0
        up[root(e.a)] = root(e.b)
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                assert root(simhash.signed(a)) == root(simhash.signed(b))


def test_masks_cover():
    r = random.Random(0)
    masks = simhash.covering_masks(list(range(64)), 4, 1)
    assert len(masks) == 31
    for _ in range(20_000):
        d = sum(1 << b for b in r.sample(range(64), 4))
        assert any(not d & m for m in masks)


def test_token_counts(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = docs(spark)
    want = collections.Counter((r.doc_id, len((r.text or "").encode()), len(sp.encode(r.text or "")), len(sp.encode(r.text or "")) > 4096) for r in df.collect())
    assert collections.Counter(map(tuple, token_counts.token_counts(df, PIECES).collect())) == want
    assert token_counts.token_counts(table(spark, []), PIECES).count() == 0
    few = token_counts.token_counts(table(spark, ["It's  a", None]), WORD_BPE).collect()
    assert [r.n_tokens for r in sorted(few, key=lambda r: r.doc_id)] == [3, 0]


def test_frequent_pre_tokens_are_of_all_documents(spark, monkeypatch):
    """The first rows and short texts hold none of what is frequent behind them."""
    df = table(spark, ["rare words here"] * 2_100 + ["common " * 20_000] * 2).coalesce(1)
    monkeypatch.setattr(token_counts, "TABLE_SIZE", 2)
    found = token_counts.frequent_lengths(df, PIECES)
    assert len(found) <= 2 and " common" in found


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def corpus(spark, seed=2, n=120):
    """Good texts, and junk of symbols behind every word; labels of both."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(300)]
    texts, quality = [], []
    for k in range(n):
        own = [r.choice(words) for _ in range(r.randint(55, 120))]
        bad = k % 4 == 0
        texts.append(" ".join(w + r.choice(("***", "$$$")) if bad else w for w in own))
        quality.append(0 if bad else 1)
    labels = spark.createDataFrame([(k, q, 0, "x") for k, q in enumerate(quality)] + [(None, 1, 0, "x"), (10**6, None, 0, "x"), (0, 0, 0, "x")], "doc_id long, quality int, toxic int, kept string")
    return table(spark, texts), labels, quality


def test_quality_rules(spark):
    df, labels, quality = corpus(spark)
    both = df.unionByName(docs(spark).withColumn("doc_id", F.col("doc_id") + 1000))
    got = ngram_rules.quality_rules(both, labels).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert collections.Counter((r.doc_id, *[r[c] for c in names]) for r in got) == collections.Counter((r.doc_id, *brute_rules(r.text)) for r in both.collect())
    for r in got:
        assert not (r.base_failed and r.kept)
        if r.doc_id is not None and r.doc_id < len(quality):
            assert r.kept == bool(quality[r.doc_id])
    kept = ngram_rules.keep_by_rules(both, labels)
    assert kept.columns == both.columns and kept.count() == sum(r.kept for r in got)
    assert ngram_rules.quality_rules(table(spark, []), labels).count() == 0
    none = ngram_rules.quality_rules(df, labels.where("quality = 7")).collect()
    assert {r.ratio for r in none} == {0.0} and all(r.kept == (not r.base_failed) for r in none)


def test_quality_ratio_by_hand(spark):
    """The ratio from the definition, with Spark's own hash of single n-grams."""
    df, labels, quality = corpus(spark, n=24)
    texts = {r.doc_id: r.text for r in df.collect()}
    w = F.col("w")
    seen = {w for t in texts.values() for w in t.split()}
    hashed = {r.w: (r.a, r.b) for r in spark.createDataFrame([(x,) for x in seen], "w string").select("w", ngram_rules.bucket(F.xxhash64(w)).alias("a"), ngram_rules.bucket(F.xxhash64(F.substring(w, -3, 3), F.lit(3))).alias("b")).collect()}
    raw, good = collections.Counter(), collections.Counter()
    for d, t in texts.items():
        for x in t.split():
            raw.update(hashed[x])
            good.update(hashed[x] if quality[d] else ())
    size, s = ngram_rules.BUCKETS, ngram_rules.SMOOTHING
    log_p = lambda c, k: math.log((c[k] + s * c.total() / size + 1e-9) / (c.total() * (1 + s) + 1e-9 * size))
    for r in ngram_rules.quality_rules(df, labels).collect():
        each = [log_p(good, k) - log_p(raw, k) for x in texts[r.doc_id].split() for k in hashed[x]]
        assert abs(r.ratio - sum(each) / len(each)) < 1e-9


def test_quality_ratio_depends_on_word_order(spark, tmp_path):
    """The registered query tells a text from its words in another order."""
    r = random.Random(3)
    words = [f"w{k:02d}" for k in range(60)]
    texts = [" ".join(words)] * 3 + [" ".join(r.sample(words, 60)) for _ in range(3)]
    labels = spark.createDataFrame([(k, int(k < 2), 0) for k in range(6)], "doc_id long, quality int, toxic int")
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    ratio = {x.doc_id: x.ratio for x in QUERIES["op9_ngram_quality_rules"](spark, f"file://{tmp_path}").collect()}
    assert min(ratio[k] for k in range(3)) > max(ratio[k] for k in range(3, 6)) + 0.1


def test_importance_resampling(spark):
    df, labels, quality = corpus(spark)
    got = {r.doc_id: r for r in importance.resample(df, labels).collect()}
    assert [got[k].kept for k in range(len(quality))] == [bool(q) for q in quality]
    again = {r.doc_id: r.key for r in importance.resample(df.repartition(7), labels).collect()}
    assert again == {k: r.key for k, r in got.items()}
    some = importance.resample(df, labels, k=10).collect()
    assert sorted(r.key for r in some if r.kept) == sorted(r.key for r in some)[-10:]
    both = df.unionByName(docs(spark).withColumn("doc_id", F.col("doc_id") + 1000))
    assert importance.resample(both, labels).count() == both.count()
    kept = importance.keep_sampled(both, labels)
    assert kept.columns == both.columns and kept.count() == importance.resample(both, labels).where("kept").count()
    assert importance.resample(table(spark, []), labels).count() == 0
    assert importance.resample(df, labels.where("quality = 7")).where("kept").count() == len(quality)


def test_importance_weights_by_hand(spark):
    df, labels, quality = corpus(spark, n=24)
    texts = {r.doc_id: r.text for r in df.collect()}
    counts = {d: sum(np.bincount(p, minlength=importance.BUCKETS) for p in importance.grams(t)) for d, t in texts.items()}
    raw, good = sum(counts.values()), sum(c for d, c in counts.items() if quality[d])
    w = importance.log_ratio(good.astype(float), raw.astype(float))
    for r in importance.resample(df, labels).collect():
        assert abs(r.log_weight - (w * counts[r.doc_id]).sum()) < 1e-6


@pytest.mark.parametrize("size", [1, 7, 50])
def test_grams_of_slices(size, monkeypatch):
    """A long text in slices has the n-grams of the whole."""
    text = "One two  TWO two,, two\n\n" * 9 + "x" * 80 + " end-of it ALL ALL"
    whole = np.sort(np.concatenate([*importance.grams(text)]))
    monkeypatch.setattr(importance, "SLICE", size)
    parts = [*importance.grams(text)]
    assert len(parts) > 1 and (np.sort(np.concatenate(parts)) == whole).all()
    assert list(importance.grams("")) == list(importance.grams(" \n ")) == []


def test_kth_key(spark):
    r = random.Random(0)
    keys = [r.choice((r.gauss(0, 1e6), 5.0, r.random())) for _ in range(400)]
    df = spark.createDataFrame([(k,) for k in keys], "key double")
    for k in (1, 7, 200, 400):
        assert importance.kth_key(df, k) == sorted(keys)[-k]


def test_licences(spark):
    texts = [
        None, "", "nothing here", "a b\nReleased under the MIT License.", "LICENSED under the apache license; version 2.0!", "Released under the MIT License. " * 4,
        "x " * 3000 + "This work is licensed under the GNU General Public License, version 3. " + "y " * 3000, "Released under the licence", "license " * 2000,
        "Licensed under CC BY-NC 4.0.",
    ]
    got = {r.doc_id: r for r in license_scan.license_scan(table(spark, texts)).collect()}
    assert [got[k].best for k in range(len(texts))] == [None, None, None, "MIT", "Apache-2.0", "MIT", "GPL-3.0", None, None, "CC-BY-NC-4.0"]
    m = got[6].matches[0]
    assert (m.start, m.stop, m.coverage) == (3000, 3012, 1.0)
    assert license_scan.license_scan(docs(spark)).count() == docs(spark).count()
    assert license_scan.license_scan(table(spark, [])).count() == 0


def test_licences_repeated_and_mixed(spark):
    """Every occurrence counts, side by side, far apart, and where a better notice takes another place."""
    mit, gpl = "Released under the MIT License. ", "This work is licensed under the GNU General Public License, version 3. "
    texts = [mit * 4, mit + "x " * 500 + mit, (mit + gpl) * 3, gpl + "y " * 9 + mit + mit]
    got = {r.doc_id: r for r in license_scan.license_scan(table(spark, texts)).collect()}
    found = [[(m.license, m.start, m.stop) for m in sorted(got[k].matches, key=lambda m: m.start)] for k in range(len(texts))]
    assert found == [
        [("MIT", 5 * k, 5 * k + 5) for k in range(4)],
        [("MIT", 0, 5), ("MIT", 505, 510)],
        [m for k in range(0, 51, 17) for m in (("MIT", k, k + 5), ("GPL-3.0", k + 5, k + 17))],
        [("GPL-3.0", 0, 12), ("MIT", 21, 26), ("MIT", 26, 31)],
    ]
    assert [got[k].n_matches for k in range(len(texts))] == [4, 2, 6, 3]
    # Of two templates that overlap the longer stays; the other is found where it stands alone.
    two = license_scan.Scanner({"a": "one two three four five", "b": "three four five six seven eight"}, 1.0)
    assert [m[0] for m in two.scan("one two three four five six seven eight x one two three four five")] == ["b", "a"]


def test_licence_families(spark):
    """Relatives are told apart, full texts are found under their names."""
    full = {k: t for k, t in license_scan.default_templates().items() if k.endswith("-full")}
    lead = "This work is licensed under the GNU "
    texts = [
        lead + "Affero General Public License, version 3.", lead + "Lesser General Public License, version 3.", lead + "Library Public License, version 3.", "Released under the BSD License.",
        "Licensed under CC BY 3.0.", "Licensed under CC BY 2.0.", "Released under the Some License.", "This program is licensed under the GNU General Public License, version 3.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", "Licensed under CC0 1.0.",
    ]
    best = ["AGPL-3.0", "LGPL-3.0", None, "BSD", "CC-BY-3.0", None, None, "GPL-3.0", "EPL-2.0-header", "CC0-1.0"]
    got = {r.doc_id: r for r in license_scan.license_scan(table(spark, texts + ["some words before " + t.replace("{", "").replace("}", "") + " and some behind" for t in full.values()])).collect()}
    assert [got[k].best for k in range(len(texts))] == best
    assert [[(m.license, m.coverage) for m in got[len(texts) + k].matches] for k in range(len(full))] == [[(name, 1.0)] for name in full]
    assert all("{" in full[f"{name}-full"] for name in license_scan.TITLES)
    assert {x.split("-")[0] for x in full} == {"Apache", "BSD", "CC0", "EPL", "GPL", "ISC", "LGPL", "MIT", "MPL", "Unlicense"}
    # A template of few words has to be there whole.
    few = license_scan.Scanner({"a": "one two three four five"}, 0.8)
    assert few.scan("one two three four x") == few.scan("one two x three four five") == [] and len(few.scan("x one two three four five x")) == 1


def scanned_plainly(words, template, core, coverage):
    """The best coverage in any window of at most twice the template's length."""
    best, n = 0.0, len(template)
    for low in range(len(words)):
        for high in range(low + math.ceil(coverage * n), min(len(words), low + license_scan.SPREAD * n) + 1):
            pairs = license_scan.align(words[low:high], template)
            if len(pairs) >= coverage * n:
                a, b = low + pairs[0][0], low + pairs[-1][0] + 1
                if not core or any(words[p : p + len(core)] == core for p in range(a, b - len(core) + 1)):
                    best = max(best, len(pairs) / n)
    return best


@pytest.mark.parametrize("seed", range(60))
def test_licences_against_every_window(seed, monkeypatch):
    """Templates planted with words changed, dropped and put between, some with words that must be there."""
    monkeypatch.setattr(license_scan, "FEW", 0)
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(r.choice((25, 60)))]
    t = [r.choice(vocab) for _ in range(r.randint(5, 14))]
    core = t[2:4] if r.random() < 0.4 else []
    text = [r.choice(vocab) for _ in range(r.randint(0, 15))]
    for _ in range(r.randint(0, 2)):
        c = list(t)
        for _ in range(r.randint(0, 3)):
            k, kind = r.randrange(len(c)), r.random()
            c = c[:k] + [r.choice([*vocab, "x"])] + c[k:] if kind < 0.4 else c[:k] + c[k + 1 :] if kind < 0.7 and len(c) > 2 else c[:k] + ["y"] + c[k + 1 :]
        text += c + [r.choice(vocab) for _ in range(r.randint(0, 10))]
    marked = " ".join([*t[:2], "{" + " ".join(core) + "}" if core else " ".join(t[2:4]), *t[4:]])
    found = license_scan.Scanner({"t": marked}, 0.8).scan(" ".join(text))
    assert bool(found) == (scanned_plainly(text, t, core, 0.8) > 0)


def test_alignment():
    r = random.Random(0)
    for _ in range(300):
        a, b = ([r.choice("abcdefghij") for _ in range(r.randrange(12))] for _ in range(2))
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        seq = r.sample(range(50), 12)
        best = [1] * 12
        for i in range(12):
            best[i] += max([best[j] for j in range(i) if seq[j] < seq[i]], default=0)
        found = license_scan.increasing(seq)
        assert len(found) == max(best) and [seq[i] for i in found] == sorted(seq[i] for i in found)
    assert len(license_scan.align(list("xabcy"), list("abc"))) == 3


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("v", T.StringType()), T.StructField("shard", T.IntegerType())])


@pytest.mark.parametrize("sizes", [(65_536, 2048, 4096), (3, 2, 5)])
def test_top_k(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "QUERY_BLOCK", sizes[0])
    monkeypatch.setattr(topk, "QUERY_TILE", sizes[1])
    monkeypatch.setattr(topk, "TILE", sizes[2])
    monkeypatch.setattr(topk, "FAN_IN", 2)
    r = random.Random(1)
    vecs = [(k, [r.choice((-0.5, 0.0, 0.25, 0.5)) for _ in range(4)]) for k in range(90)]
    vecs += [(100, None), (101, [None, 0.0, 0.0, 0.0]), (120, [float("nan"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (140, [float("inf")] * 4), (160, [1.0, 2.0]), (161, [0.5, 0.5]), (180, []), (60, vecs[60][1]), (7, vecs[7][1])]
    vecs += [(200, [1e30, 0.0, 0.0]), (201, [1.0, 1.0, 1.0]), (220, [2.0**58, 3.0, 1.0]), (221, [2.0**-20, -7.0, 2.0])]
    got = [tuple(x) for x in topk.exact_top_k(spark.createDataFrame([(i, v, 0, "x", 1) for i, v in vecs], VECTORS), k=5).collect()]
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in vecs if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, q in {i: q for i, q in ok if i % 20 == 0}.items():
        scored = sorted((-max(min(sum(a * b for a, b in zip(q, c, strict=True)), 2**63 - 1), -(2**63) + 1), j) for j, c in ok if j != i and len(c) == len(q))
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:5])]
    assert sorted(got) == sorted(want)


def test_top_k_of_nothing(spark):
    assert topk.exact_top_k(spark.createDataFrame([], VECTORS)).count() == 0


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got, want = QUERIES[name](spark, sf).toPandas(), db.execute(ORACLES[name]).fetchdf()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(got[cols].itertuples(index=False, name=None)) == sorted(want[cols].itertuples(index=False, name=None))
