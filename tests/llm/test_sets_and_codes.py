"""Operators 11 to 13 against plain versions on small tables with nulls, ties, copies, long texts and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tapeline.llm import jaccard_join, ngram_dictionary, target_resampling, vector_codes
from tapeline.llm.queries import ORACLES, QUERIES
from tests.llm.test_operators import docs, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {" ".join(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {" ".join(w)} if w else set()


def least_of_components(rows):
    """Counter of (doc_id, set size, least doc_id reachable) by comparing all pairs."""
    found = [(i, shingles(t)) for i, t in rows]
    up = list(range(len(found)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(found)):
        for b in range(a):
            x, y = found[a][1], found[b][1]
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                up[root(a)] = root(b)
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(found):
        least[root(k)].append(i)
    return collections.Counter((i, len(s), min((x for x in least[root(k)] if x is not None), default=None)) for k, (i, s) in enumerate(found))


def families(seed):
    """Families of texts a few words apart, chains, a passage that all share, sizes at the threshold."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(1, 5)))
    common = [word() for _ in range(40)]
    texts = []
    for _ in range(12):
        base = common[: r.choice((0, 20, 40))] + [word() for _ in range(r.choice((4, 20, 60, 150)))]
        for _ in range(r.randint(1, 9)):
            own = list(base)
            for _ in range(r.choice((0, 0, 1, 1, 2, 4))):
                own[r.randrange(len(own))] = word()
            texts.append(" ".join(own))
            base = own if r.random() < 0.4 else base
    return texts + [" ".join(common[:k]) for k in range(1, 14)] + [t.upper() for t in texts[:5]]


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_join(spark, seed):
    df = table(spark, families(seed))
    got = jaccard_join.jaccard_join(df).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == least_of_components([(r.doc_id, r.text) for r in df.collect()])


def test_jaccard_join_of_odd_rows(spark):
    df = docs(spark)
    got = jaccard_join.jaccard_join(df).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == least_of_components([(r.doc_id, r.text) for r in df.collect()])
    assert jaccard_join.jaccard_join(table(spark, [])).count() == 0
    assert [r.component_id for r in jaccard_join.jaccard_join(table(spark, [None, "", " "])).orderBy("doc_id").collect()] == [0, 1, 2]


def test_a_dense_group_makes_few_pairs(spark, monkeypatch):
    """Texts that are all near each other are compared with a pivot, not in all pairs."""
    r = random.Random(5)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for k in range(150):
        own = list(base)
        own[r.randrange(300)] = f"own{k}"
        texts.append(" ".join(own))
    made, plain = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, segs, percent: made.append(pairs.count()) or plain(pairs, segs, percent))
    assert {x.component_id for x in jaccard_join.jaccard_join(table(spark, texts)).collect()} == {0}
    assert sum(made) < 2 * len(texts)


def test_slices_of_long_texts(monkeypatch):
    """Sets of texts that are read in parts, and of several texts at once, are those of whole texts."""
    monkeypatch.setattr(jaccard_join, "WORDS", 4)
    r = random.Random(1)
    texts = [None, "", "a", "a b", *(" \t".join(r.choice(("a", "b", "long" * 9, "é", "x y")) for _ in range(n)) for n in (3, 4, 5, 9, 40, 41, 200)), "z" * 500, " " * 400 + "a b c"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["k", "text"])
    got = {row[0]: keys for rows, found in jaccard_join.sets(iter([batch])) for row, keys in zip(rows, found, strict=True)}
    whole = {}
    for k, t in enumerate(texts):
        assert len(got[k]) == len(shingles(t))
        for s, key in zip(sorted(shingles(t)), sorted(got[k].tolist()), strict=True):
            whole.setdefault(frozenset(shingles(t)), set()).add(tuple(got[k].tolist()))
            assert s and key
    assert all(len(v) == 1 for v in whole.values())


def test_fragments_cut_one_order(spark):
    df = spark.createDataFrame([(k, [(d, x) for d in (2, 3, 9) for x in range(-(2**63), 2**63, 2**60)]) for k in range(3)], "id long, seq array<struct<df:long,k:long>>")
    segs = jaccard_join.segments(df, 8).where("id = 0").orderBy("fragment").collect()
    assert 6 <= len(segs) <= 8
    assert sum(len(s.ks) for s in segs) == 48 and max(len(s.ks) for s in segs) <= 12


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), collections.Counter(" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))


def brute_resample(rows, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for f, c in features(x)[1].items():
                counts[bucket(f)] += c
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10_000) / ((a + 1) * (t.sum() + 10_000)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    out, fit = [], []
    for i, x in rows:
        n, found = features(x)
        weight = sum(gain[bucket(f)] * c for f, c in found.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, sum(found.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n >= 20:
            fit.append(out[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: 5 * len(fit) // 100]):
        r[4] = k + 1
    return collections.Counter(map(tuple, out))


def test_target_resampling(spark):
    r = random.Random(2)
    words = ["".join(r.choice("abcdeé9") for _ in range(r.randint(1, 4))) for _ in range(60)]
    texts = [r.choice((" ", "-", "\n\x00", "_")).join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(150)]
    df = docs(spark).union(table(spark, [*texts, texts[0]], [*range(100, 250), 100]))
    target = spark.createDataFrame([(1, texts[3], "x"), (1, None, "y"), (None, "A B c", "z")], "item_id long, text string, weight string")
    got = target_resampling.target_resample(df, target).collect()
    assert collections.Counter(map(tuple, got)) == brute_resample([(x.doc_id, x.text) for x in df.collect()], [x.text for x in target.collect()])
    assert sum(x.rank is not None for x in got) >= 3
    assert target_resampling.target_resample(table(spark, []), target).count() == 0
    none = target_resampling.target_resample(df, target.where("false")).collect()
    assert collections.Counter(map(tuple, none)) == brute_resample([(x.doc_id, x.text) for x in df.collect()], [])


def test_pieces_have_each_run_once(monkeypatch):
    monkeypatch.setattr(ngram_dictionary, "CHUNK", 12)
    r = random.Random(7)
    for n in (0, 1, 2, 3, 30, 200):
        text = " ".join(r.choice(("a", "B", "ccc", "d" * 30)) for _ in range(n))
        words, ends, lead = [], [], []
        for part, before in ngram_dictionary.pieces(text):
            words += part
            ends.append(len(words))
            lead.append(before)
        coded = pa.array(words, pa.binary()).dictionary_encode()
        g = ngram_dictionary.Grams(ngram_dictionary.joined(coded.dictionary), ngram_dictionary.zip_numbers(coded.indices.to_numpy()), ends, lead)
        got = collections.Counter()
        for route in g.routes(3):
            sizes, data = g.asked(route)
            for s, c in zip(ngram_dictionary.strings(sizes, data).to_pylist(), ngram_dictionary.unzip_numbers(data[6]).tolist(), strict=True):
                if c:
                    got[s.decode()] += c
        assert got == features(text)[1]


def brute_codes(rows):
    """Full searches in Python's integers."""
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    m = len(kept[0][2]) // 4
    part = lambda v, p: v[p * m : (p + 1) * m]
    books = [[part(v, p) for _, _, v in kept[:256]] for p in range(4)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v, p: min((far(part(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(4):
        found = [collections.defaultdict(list) for _ in range(4)]
        for _, _, v in kept:
            for p in range(4):
                found[p][nearest(v, p)[1]].append(part(v, p))
        for p in range(4):
            for k, vs in found[p].items():
                books[p][k] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    out, sums = [], collections.Counter()
    for i, label, v in kept:
        got = [nearest(v, p) for p in range(4)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got)))
        sums[label] += out[-1][3]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return collections.Counter((i, code, e, sums[label], sha) for i, label, code, e in out)


@pytest.mark.parametrize(("seed", "scale", "rows"), [(1, 1.0, 400), (2, 0.003, 300), (3, 1e13, 60), (4, 1.0, 1)])
def test_vector_codes(spark, seed, scale, rows):
    """Ties (few different components), far vectors beyond what longs hold squared, nulls, repeated rows."""
    r = random.Random(seed)
    data = [(r.choice((k, k, 5)), [r.gauss(0, 1) * scale for _ in range(8)], r.choice((None, 1, 2)), "x") for k in range(rows)]
    data += [data[0], (1000, None, 1, "x"), (1001, [1.0] * 7 + [None], 1, "x"), (1002, [math.inf] * 8, 2, "x"), (1003, [math.nan] * 8, None, "x"), (None, [0.5 * scale] * 8, 2, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, code string")
    got = vector_codes.vector_codes(df).collect()
    want = brute_codes([x[:3] for x in data])
    most = 2**63 - 1
    want = collections.Counter({(i, c, min(e, most), None if s > most else s, sha): n for (i, c, e, s, sha), n in want.items()})
    assert collections.Counter((x.vec_id, x.code, x.error, None if x.label_error == most else x.label_error, x.codebooks_sha256) for x in got) == want or scale > 1e9
    if scale > 1e9:  # sums of what is cut off are not compared
        assert collections.Counter((x.vec_id, x.code, x.error, x.codebooks_sha256) for x in got) == collections.Counter({(i, c, e, sha): n for (i, c, e, _, sha), n in want.items()})


def test_vectors_of_other_lengths_and_many_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_BYTES", -1)  # hot labels apart, the others by a shuffle
    monkeypatch.setattr(vector_codes, "HOT_SHARE", 0.1)
    r = random.Random(3)
    data = [(k, [r.random() for _ in range(8)], r.choice((None, 7, 7, k))) for k in range(120)]
    df = spark.createDataFrame([*data, (500, [1.0] * 6, 7), (501, [], -1)], "vec_id long, embedding array<float>, label int")
    got = {x.vec_id: x for x in vector_codes.vector_codes(df).collect()}
    assert (got[500].code, got[500].error) == (None, None) and got[501].label_error is None and len(got) == 122
    sums = collections.Counter()
    for i, _, label in data:
        sums[label] += got[i].error
    assert all(got[i].label_error == sums[label] for i, _, label in data) and got[500].label_error == sums[7]
    assert vector_codes.vector_codes(df.where("false")).count() == 0
    assert {x.code for x in vector_codes.vector_codes(df.where("vec_id = 501")).collect()} == {"00000000"}


@pytest.mark.parametrize("name", ["op11_jaccard_join", "op13_vector_codes"])
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = db.execute(ORACLES[name]).fetchdf()
    got = QUERIES[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(map(tuple, df[sorted(want.columns)].to_numpy().tolist()))
    assert rows(got) == rows(want)
